"""URLs and page texts against plain forms."""

import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from klaxon.llm import html_text, url_rules

URLS = [
    "http://a.example.net/en/1",
    "http://example.net/en/x?y#z",
    "https://EXAMPLE.net/EN/",
    "http://net/",
    "http://x.net",
    "http://notnet/",
    "http://www.example.com/de/5.html",
    "http://example.com/fr/5",
    "http://a.b.org/fr/x",
    "http://a.b.org/de/x",
    "http://org/fr",
    "http://a.org?x=/fr/",
    "a://b://c.net/p",
    "://example.net/en/",
    "no scheme.net/",
    "",
    None,
    "http://É.net/ü?a=1&b=2",
    "http://x.net:80/",
    "http://ex\nample.net/a\nb",
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def plain_rule(host, path):
    fits = [
        (len(name), name, verdict)
        for name, verdict in url_rules.RULES
        for at in [name.index("/")]
        if (host == name[:at] or host.endswith("." + name[:at])) and path.startswith(name[at:])
    ]
    return max(fits)[1:] if fits else (None, None)


def pages(spark, urls):
    return spark.createDataFrame(
        [(i, u, "<p>x</p>", "t") for i, u in enumerate(urls)],
        "page_id bigint, url string, html string, tokens string",
    )


def test_parts_and_rules(spark):
    found = url_rules.filter_urls(pages(spark, URLS * 2)).collect()
    assert len(found) == 2 * len(URLS)
    for row in found:
        url = URLS[row["page_id"] % len(URLS)]
        assert (row["host"], row["path"]) == plain_parts(url)
        name, verdict = plain_rule(row["host"], row["path"])
        assert row["rule"] == name
        if name:
            assert row["verdict"] == verdict and row["confidence"] is None
        if not url or "://" not in url:
            assert row["verdict"] == "allow"


def plain_rules(rows, support, confidence):
    """(tokens, verdict) -> confidence of all rules that no part of their tokens makes needless."""
    every = sorted({token for tokens, _ in rows for token in tokens})
    plain = {}
    for size in range(1, len(every) + 1):
        for tokens in itertools.combinations(every, size):
            total = Counter(v for t, v in rows if set(tokens) <= set(t))
            for verdict, hits in total.items():
                if hits >= support * len(rows) and hits / total.total() >= confidence:
                    plain[tokens, verdict] = hits / total.total()
    return {
        (t, v): c
        for (t, v), c in plain.items()
        if not any(set(s) < set(t) and w == v and b >= c for (s, w), b in plain.items() if len(s) == len(t) - 1)
    }


@pytest.mark.parametrize("seed", range(4))
def test_mined_rules_are_those_of_all_token_sets(spark, seed):
    """Items stand for each of their tokens: "f" and "g" come with "a", "h" for one verdict only."""
    rng = random.Random(seed)
    rows = []
    for _ in range(200):
        tokens = rng.sample(["a", "b", "c", "d", "e"], rng.randint(1, 4))
        verdict = "block" if "a" in tokens and rng.random() < 0.9 else rng.choice(["allow", "block"])
        if "a" in tokens and seed:
            tokens += ["f", "g"]
        if verdict == "block" and rng.random() < 0.3:
            tokens.append("h")
        rows.append((sorted(tokens), verdict))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    members = {}
    for row in url_rules.items_of(labelled, 0.05).collect():
        members.setdefault(row["item"], []).append(row["token"])
    assert (members.get("a") == ["a", "f", "g"] or sorted(members["a"]) == ["a", "f", "g"]) == bool(seed)
    found = {}
    for row in url_rules.mine_rules(labelled, 0.05, 0.6).collect():
        for tokens in itertools.product(*[members[item] for item in row["tokens"]]):
            found[tuple(sorted(tokens)), row["verdict"]] = row["confidence"]
    assert found == pytest.approx(plain_rules(rows, 0.05, 0.6))


def test_long_urls_of_one_site_take_no_time(spark):
    """Thirty parts of a path: sets of them are not listed one by one."""
    parts = "/".join(f"part{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30))
    urls = [f"http://www.example.net/{'en' if i % 2 else 'fr'}/{parts}/{i}" for i in range(200)]
    urls += [f"http://other.info/{parts}", "http://other.info/en/x", "http://none.info/fr/x"]
    began = time.time()
    found = url_rules.filter_urls(pages(spark, urls)).orderBy("page_id").collect()
    assert time.time() - began < 60
    assert [row["verdict"] for row in found[:4]] == ["block", "allow"] * 2
    assert [row["verdict"] for row in found[-2:]] == ["allow", "block"]


def plain_judged(urls, support, confidence):
    """Verdicts by trying all rules on every URL."""
    tokens, labelled, found = {}, [], []
    for url in urls:
        host, path = plain_parts(url)
        name, verdict = plain_rule(host, path)
        scheme = url.split("://")[0]
        some = {f"host={p}" for p in host.split(".") if p} | {f"path={p}" for p in re.split("[/.]", path) if p}
        tokens[url] = {re.sub("[0-9]+", "0", one) for one in some | {f"scheme={scheme}"}}
        if verdict:
            labelled.append((sorted(tokens[url]), verdict))
    rules = plain_rules(labelled, support, confidence)
    hits = {
        rule: sum(set(rule[0]) <= set(t) and v == rule[1] for t, v in labelled) for rule in rules
    }
    for url in urls:
        verdict = plain_rule(*plain_parts(url))[1]
        fits = [(c, hits[t, v], len(t), t, v) for (t, v), c in rules.items() if set(t) <= tokens[url]]
        best = [one for one in fits if one[:3] == max(fits)[:3]] if fits else []
        found.append({verdict} if verdict else {one[4] for one in best} or {"allow"})
    return found


@pytest.mark.parametrize("seed", range(3))
def test_verdicts_are_those_of_all_rules(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.example.net", "b.example.net", "c.example.com", "d.org", "e.info", "f.info"]
    urls = [
        f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice('xyz')}/{rng.randint(1, 99)}"
        for _ in range(150)
    ]
    found = url_rules.filter_urls(pages(spark, urls), support=0.03).orderBy("page_id").collect()
    # Of rules that are equal in all but their names any may decide.
    for row, plain in zip(found, plain_judged(urls, 0.03, url_rules.MIN_CONFIDENCE)):
        assert row["verdict"] in plain
    assert any(row["confidence"] is not None for row in found)


def test_the_most_confident_fitting_rule_decides(spark):
    rules = [(["a"], "block", 9, 0.8), (["a", "b"], "allow", 5, 0.9), (["c"], "allow", 9, 0.8)]
    rules = spark.createDataFrame(rules, "tokens array<string>, verdict string, hits bigint, confidence double")
    sets = [["a"], ["a", "b"], ["a", "c"], ["b"], ["c", "d"]]
    frequencies = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1)], "token string, n bigint")
    found = url_rules.judge(spark.createDataFrame([(s,) for s in sets], "tokens array<string>"), rules, frequencies)
    judged = {tuple(r["tokens"]): r["judged"] for r in found.collect()}
    assert judged == {("a",): "block", ("a", "b"): "allow", ("a", "c"): "allow", ("c", "d"): "allow"}


def test_urls_without_rule_follow_their_tokens(spark):
    urls = [f"http://h{i}.example.net/{p}/{i}" for i in range(60) for p in ("en", "fr")]
    urls += ["http://x.example.com/en/5", "http://x.example.com/fr/5"]
    found = url_rules.filter_urls(pages(spark, urls)).orderBy("page_id").collect()
    assert [row["verdict"] for row in found[-2:]] == ["allow", "block"]


def test_no_labelled_url_and_empty_table(spark):
    found = url_rules.filter_urls(pages(spark, ["http://a.com/", None])).collect()
    assert [row["verdict"] for row in found] == ["allow", "allow"]
    assert url_rules.filter_urls(pages(spark, [])).isEmpty()


ARTICLE = "<h1>A title</h1><p>One  <b>bold</b>\n word&nbsp;&amp; more &lt;text&gt; here.<p>Second<br>line of it.</p>"
ARTICLE_TEXT = "A title One bold word & more <text> here. Second line of it."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<html><body><nav><a href=/>Home</a></nav></body></html>", ""),
        ("Only words", "Only words"),
        (f"<article>{ARTICLE}</article>", ARTICLE_TEXT),
        (f"<body><nav><ul><li>x</ul></nav><main>{ARTICLE}</main><footer>f</footer>", ARTICLE_TEXT),
        (f"<header>Site name</header><div class='ad'>Buy this now, it is cheap</div><article>{ARTICLE}", ARTICLE_TEXT),
        (f"<div id=content>{ARTICLE}</div><div id=sidebar><p>{'long words ' * 50}</p></div>", ARTICLE_TEXT),
        (f"<div>{ARTICLE}</div><section class='user-comments'><p>{'I say ' * 90}</p></section>", ARTICLE_TEXT),
        (f"<div class=cookieNotice>We use cookies</div><article>{ARTICLE}</article>", ARTICLE_TEXT),
        (f"<article><header>{ARTICLE}</header><form>Name <input></form><aside>See also</aside></article>", ARTICLE_TEXT),
        (f"<script>var t='</p><p>no';</script><style>p{{}}</style><article>{ARTICLE}<!-- no --></article>", ARTICLE_TEXT),
        ("<article><h1>x</h1><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "x a b c d"),
        (f"<div class=ad>never closed<article>{ARTICLE}</article>", ARTICLE_TEXT),
        ("<article>unfinished &amp", "unfinished &"),
        ("<article><p>a</b></i></div>b</p></article>", "ab"),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_long_pages_are_whole():
    words = [f"word{i}" for i in range(60_000)]
    page = "<nav>menu</nav><article>" + "".join(f"<p>{' '.join(words[i : i + 50])}</p>" for i in range(0, 60_000, 50))
    assert html_text.main_text(page) == " ".join(words)


def test_extract_text(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (1, "u", None, "x"), (None, None, "<p>é</p>", None)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = html_text.extract_text(table).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in found) == [
        (0, "é", 1), (1, "", 0), (1, ARTICLE_TEXT, len(ARTICLE_TEXT))
    ]
    assert html_text.extract_text(table.filter(F.lit(False))).isEmpty()


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<html><head><title>T</title><body><article>{ARTICLE}</article>", ARTICLE_TEXT),
        (f"<html><head><title>T</title><noscript><link><body>{ARTICLE}", ARTICLE_TEXT),
        (f"<head><meta charset=utf-8><title>T</title><article>{ARTICLE}</article>", ARTICLE_TEXT),
        ("<head><title>T</title>Only words", "Only words"),
        (f"<head><title>T</title><noscript><img src=x>no</noscript><script>p</script></head>{ARTICLE}", ARTICLE_TEXT),
    ],
)
def test_a_head_ends_without_its_end_tag(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize("name", ["layout with-sidebar", "content social", "page-has-menu", "hasSidebar", "social"])
def test_a_name_of_what_holds_the_page_marks_nothing(name):
    page = f"<div class='{name}'><div><div>{ARTICLE}</div></div><div class=sidebar><a href=/>x</a></div></div>"
    assert html_text.main_text(page) == ARTICLE_TEXT
    assert html_text.main_text(f"<nav>Home</nav><div class='{name}'><p>{ARTICLE}</div>") == ARTICLE_TEXT


def test_names_that_leave_no_line_mark_nothing():
    page = f"<div class='social'>{ARTICLE}</div><div id=widgets><p>{'long words ' * 8}</p></div>"
    assert ARTICLE_TEXT in html_text.main_text(page)


WORDY = "Many words that say something about it here. "


@pytest.mark.parametrize(
    "html, parts",
    [
        ("<body><nav>Home</nav><div class=lead><p>{}</p></div><div class=body><p>{}</p></div>", (1, 9)),
        ("<div><div><h2>Long</h2><p>{}</p></div><div><h2>Short</h2><p>{}</p></div></div><footer>f</footer>", (9, 1)),
        ("<main><p>{}</p><article><p>{}</p></article></main>", (1, 9)),
        ("<div><article><p>{}</p></article><div class=ad>Buy</div><article><p>{}</p></article></div>", (8, 2)),
    ],
)
def test_short_parts_of_the_content_stay(html, parts):
    one, other = [(WORDY * n).strip() for n in parts]
    found = html_text.main_text(html.format(one, other))
    headings = ("Long ", "Short ") if "h2" in html else ("", "")
    assert found == f"{headings[0]}{one} {headings[1]}{other}"


COMMENT = "<p>I read this with care and I agree with every word of it, all of them. </p>" * 3


@pytest.mark.parametrize(
    "html, text",
    [
        # A form around the whole page, with and without an article.
        (f"<body><form action=/><div><nav>Home</nav><article>{ARTICLE}</article></div></form>", ARTICLE_TEXT),
        (f"<body><form><div class=head><a href=/>Home</a></div><div><p>{WORDY * 4}</p></div></form>", None),
        # A form of its own.
        (f"<article>{ARTICLE}</article><form><p>{WORDY * 3}<input></form>", ARTICLE_TEXT),
        (f"<div>{ARTICLE}<form><label>Your name <input></label><button>Send</button></form></div>", ARTICLE_TEXT),
        ("<body><form>Name <input><button>Send</button></form>", ""),
        # Readers' comments as articles.
        (f"<article>{ARTICLE}</article><div id=disqus_thread><article>{COMMENT}</article></div>", ARTICLE_TEXT),
        (f"<article>{ARTICLE}<section class=comments><article>{COMMENT}</article></section></article>", ARTICLE_TEXT),
        # What is never closed hides nothing, what is closed hides what is in it.
        (f"<body><button>Menu<article>{ARTICLE}</article>", ARTICLE_TEXT),
        (f"<body><video src=x><article>{ARTICLE}</article>", ARTICLE_TEXT),
        (f"<body><svg><path d=m><article>{ARTICLE}</article>", ARTICLE_TEXT),
        (f"<article>{ARTICLE}<object>old player</object><canvas>no canvas</canvas></article>", ARTICLE_TEXT),
        (f"<article>{ARTICLE}<select><option>one<option>two</select></article>", ARTICLE_TEXT),
        # A comment without an end.
        (f"<article>{ARTICLE}</article><!-- <p>{WORDY}</p> <b>more", ARTICLE_TEXT),
        (f"<!-- a --><article>{ARTICLE}<!-- <p>{WORDY}</p>", ARTICLE_TEXT),
    ],
)
def test_frames_comments_and_elements_without_end(html, text):
    found = html_text.main_text(html)
    assert found == (text if text is not None else (WORDY * 4).strip())


@pytest.mark.parametrize("tag", ["div class=comment", "div", "section class=ad", "b", "article", "form", "ul", "svg"])
def test_deep_pages(tag):
    """Depth costs neither time nor memory in proportion to its square."""
    page = f"<p>{WORDY * 5}</p>" + f"<{tag}>x " * 50_000
    assert html_text.main_text(page).startswith("x x" if tag == "article" else WORDY.strip())


def plain_clusters(ratios):
    """The threshold and its clusters by hand, for lines without headings."""
    smooth = []
    for i in range(len(ratios)):
        near = range(max(0, i - 3), min(len(ratios), i + 4))
        weight = {j: 2.718281828459045 ** (-((i - j) ** 2) / 2) for j in near}
        smooth.append(sum(ratios[j] * weight[j] for j in near) / sum(weight.values()))
    mean = sum(smooth) / len(smooth)
    threshold = min((sum((x - mean) ** 2 for x in smooth) / len(smooth)) ** 0.5, max(smooth))
    chosen, run = set(), []
    for i, x in enumerate([*smooth, -1]):
        if x >= threshold:
            run.append(i)
            continue
        firm = [j for j in run if ratios[j] >= min(threshold, 10)]
        chosen.update(range(firm[0], firm[-1] + 1) if firm else ())
        run = []
    return [i in chosen for i in range(len(ratios))]


@pytest.mark.parametrize("seed", range(20))
def test_ratios_decide_without_names(seed):
    """Pages of bare blocks: neither article nor class says where the text is."""
    rng = random.Random(seed)

    def links():
        return "".join(f"<li><a href=/{i}>Go {i}</a></li>" for i in range(rng.randint(5, 20)))

    paragraphs = [(WORDY * rng.randint(2, 9)).strip() for _ in range(rng.randint(2, 9))]
    body = "<h1>A title</h1>" + "".join(f"<p>{text}</p>" for text in paragraphs)
    if seed % 2:
        # The title stands beside the text.
        body = body.replace("</h1>", "</h1><div>") + "</div>"
    page = f"<body><div><ul>{links()}</ul></div><div>{body}</div><div><ul>{links()}</ul></div></body>"
    assert html_text.main_text(page) == " ".join(["A title", *paragraphs])


@pytest.mark.parametrize("seed", range(20))
def test_clusters(seed):
    rng = random.Random(seed)
    ratios = [rng.choice([0, 1, 2, 40, 100]) * rng.random() for _ in range(rng.randint(1, 60))]
    if not any(ratios):
        return
    found = html_text.clusters(np.array(ratios), np.zeros(len(ratios), bool))
    plain = plain_clusters(ratios)
    assert found.tolist() == plain or not any(plain)
