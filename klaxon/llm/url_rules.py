"""URL filtering by given rules and by association rules mined from what they decide.

URLs that a given rule decides are the labelled ones. Their tokens, together with the
verdict, are the baskets of Spark's FP-growth; token sets that go with a verdict often
enough become association rules and judge the other URLs. A rule is found by the rarest of
its tokens in an inverted index. Tokens that occur in the same labelled URLs are one item, so
that FP-growth does not list all sets of them; sets that merely almost always occur
together it does list, each of them once.
"""

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klaxon.operators.joins import left_join_measured
from klaxon.session import store

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.7
# Association rules sent to all tasks, at most; more are joined by a shuffle.
MOST_SENT = 50_000
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``name`` is ``host/`` or ``host/path/``; a rule covers subdomains and longer paths."""

    name: str
    verdict: str

    @property
    def host(self):
        return self.name.partition("/")[0]

    @property
    def path(self):
        return "/" + self.name.partition("/")[2]


RULES = (
    Rule("net/", BLOCK),
    Rule("example.net/en/", ALLOW),
    Rule("example.com/de/", BLOCK),
    Rule("org/fr/", ALLOW),
)


def _lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: str = "url") -> Column:
    """From the first ``://`` to a slash, question mark, hash or the end; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(_lowered(host), F.lit(""))


def path_of(url: str = "url") -> Column:
    """From the end of the host to a question mark, hash or the end; else empty."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def rule_of(rules=RULES) -> Column:
    """Struct of the longest rule that covers ``host`` and ``path``, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
        host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        fits = host & F.startswith(F.col("path"), F.lit(rule.path))
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def tokens_of(url: str = "url") -> Column:
    """Distinct tokens of a URL: labels of its host, parts of its path, names of its query's
    parameters and its fragment, numbers in them as ``0``."""

    def named(prefix, parts):
        full = F.filter(parts, lambda part: part != "")
        return F.transform(full, lambda part: F.concat(F.lit(prefix), part))

    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(?s)#(.*)$", 1)
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    everything = F.concat(
        named("scheme=", F.array(scheme)),
        named("host=", F.split("host", r"\.")),
        named("path=", F.split("path", r"[/.]")),
        named("query=", F.transform(F.split(query, "&"), lambda p: F.split_part(p, F.lit("="), F.lit(1)))),
        named("fragment=", F.array(fragment)),
    )
    plain = F.transform(everything, lambda token: F.regexp_replace(token, "[0-9]+", "0"))
    return F.coalesce(F.array_sort(F.array_distinct(plain)), F.array().cast("array<string>"))


def items_of(labelled: DataFrame, support: float) -> DataFrame:
    """(token, item, n, verdict) of the tokens that occur often enough in (tokens, verdict).

    Tokens that occur in exactly the same rows are one item, named by the first of them: a
    rule on one of them is a rule on each. ``verdict`` is that of all rows with the token if it
    is one verdict; a rule on the token alone then says all that a rule on more could say.
    """
    sets = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    least = F.lit(support) * labelled.count()
    row = F.xxhash64("tokens", "verdict")
    tokens = sets.select(F.explode("tokens").alias("token"), row.alias("row"), "n", "verdict")
    tokens = tokens.groupBy("token").agg(
        F.sum("n").alias("n"),
        F.bit_xor("row").alias("x"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y"),
        F.when(F.min("verdict") == F.max("verdict"), F.min("verdict")).alias("verdict"),
    ).filter(F.col("n") >= least)
    same = ["n", "x", "y"]
    names = tokens.groupBy(*same).agg(F.min("token").alias("item"))
    return store(tokens.join(names, same).select("token", "item", "n", "verdict"), "items")


def as_items(sets: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, items) of distinct token sets: the items that their tokens stand for, in order."""
    names = items.select("token", "item")
    held = sets.select("tokens", F.explode("tokens").alias("token"))
    held = left_join_measured(held, names, ["token"]).filter("item IS NOT NULL")
    held = held.groupBy("tokens").agg(F.array_sort(F.collect_set("item")).alias("items"))
    nothing = F.array().cast("array<string>")
    joined = left_join_measured(sets, held, ["tokens"])
    return joined.select(*sets.columns, F.coalesce("items", nothing).alias("items"))


def mine_rules(
    labelled: DataFrame, support: float, confidence: float, items: DataFrame | None = None
) -> DataFrame:
    """(tokens, verdict, hits, confidence) mined from (tokens, verdict); the tokens are items.

    A rule is left out if a part of its tokens gives the same verdict with at least its
    confidence. Supports are counted over all rows.

    FP-growth lists every frequent set, and n tokens that always occur together would have 2**n
    of them. Here they are one item; and tokens that always go with one verdict, whose own
    rules nothing longer can better, are left out of its baskets.
    """
    items = items_of(labelled, support) if items is None else items
    single = items.filter("verdict IS NOT NULL AND token = item").select(
        F.array("item").alias("tokens"),
        "verdict",
        F.col("n").alias("hits"),
        F.lit(1.0).alias("confidence"),
    )
    mixed = items.filter("verdict IS NULL")
    sets = store(as_items(labelled.select("tokens").distinct(), mixed), "baskets")
    rows = left_join_measured(labelled, sets, ["tokens"])
    # A token of a URL cannot begin with a space.
    baskets = rows.select(F.concat("items", F.array(F.concat(F.lit(" "), "verdict"))).alias("items"))
    return store(_mined(baskets, support, confidence).unionByName(single), "kept")


def _mined(baskets: DataFrame, support: float, confidence: float) -> DataFrame:
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    sets = store(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    verdicts = F.filter("items", lambda item: F.startswith(item, F.lit(" ")))
    split = sets.select(
        verdicts.alias("verdicts"),
        F.array_except("items", verdicts).alias("tokens"),
        F.col("freq").alias("hits"),
    )
    # Token sets with one verdict against the same sets with any.
    whole = split.filter("size(verdicts) = 0").select("tokens", F.col("hits").alias("total"))
    rules = split.filter("size(verdicts) = 1 AND size(tokens) > 0").join(whole, "tokens")
    rules = rules.select(
        "tokens",
        F.ltrim(F.col("verdicts")[0]).alias("verdict"),
        "hits",
        (F.col("hits") / F.col("total")).alias("confidence"),
    ).filter(F.col("confidence") >= confidence)
    rules = store(rules, "rules")
    # Each rule meets those that lack one of its tokens; with these, all smaller ones.
    parts = rules.select(
        "tokens", "verdict", "confidence", F.explode("tokens").alias("left_out")
    ).select(
        F.array_remove("tokens", F.col("left_out")).alias("part"), "tokens", "verdict", "confidence"
    )
    smaller = rules.select(
        F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("before")
    )
    needless = parts.join(smaller, ["part", "verdict"]).filter("before >= confidence")
    needless = needless.select("tokens", "verdict")
    return rules.join(needless, ["tokens", "verdict"], "left_anti")


def judge(sets: DataFrame, rules: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(tokens, judged, confidence) of the token sets that a rule fits; the most confident
    one decides, then the one with more hits, then the longer one, then the first by name.

    ``frequencies``: (token, n). Rules wait under the rarest of their tokens.
    """
    indexed = rules.select("*", F.explode("tokens").alias("token")).join(frequencies, "token")
    indexed = indexed.groupBy("tokens", "verdict", "hits", "confidence").agg(
        F.min_by("token", F.struct("n", "token")).alias("key")
    )
    indexed = indexed.withColumnRenamed("tokens", "needed")
    if rules.count() <= MOST_SENT:
        indexed = F.broadcast(indexed)
    met = sets.select("tokens", F.explode("tokens").alias("key")).join(indexed, "key")
    met = met.filter(F.size(F.array_except("needed", "tokens")) == 0)
    rank = F.struct("confidence", "hits", F.size("needed"), "needed", "verdict")
    return met.groupBy("tokens").agg(
        F.max_by("verdict", rank).alias("judged"), F.max("confidence").alias("confidence")
    )


def filter_urls(
    pages: DataFrame,
    rules=RULES,
    support: float = MIN_SUPPORT,
    confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages``; ``confidence`` is that
    of the association rule that decided, null where none did.

    A URL without given and association rule is allowed; so is a null one or one without
    ``://``, whose host and path are empty. Other columns play no part; repeated rows come
    back as often as they occur.
    """
    rows = pages.select("page_id", "url").select(
        "*", host_of().alias("host"), path_of().alias("path")
    )
    rows = rows.select("page_id", "host", "path", tokens_of().alias("tokens"), rule_of(rules).alias("r"))
    rows = store(rows.select("page_id", "host", "path", "tokens", "r.rule", "r.verdict"), "urls")
    # Few token sets stand for many URLs, as numbers are left out of them.
    sets = rows.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    sets = store(sets, "token_sets")
    labelled = rows.filter("verdict IS NOT NULL AND size(tokens) > 0").select("tokens", "verdict")
    if labelled.isEmpty():
        judged = rows.select("tokens", F.lit(None).cast("string").alias("judged")).limit(0)
        judged = judged.withColumn("confidence", F.lit(None).cast("double"))
    else:
        items = items_of(labelled, support)
        mined = mine_rules(labelled, support, confidence, items)
        open_sets = sets.filter("verdict IS NULL").select("tokens", "n")
        open_sets = store(as_items(open_sets, items), "open_sets")
        held = open_sets.groupBy(F.col("items").alias("tokens")).agg(F.sum("n").alias("n"))
        held = store(held, "item_sets")
        frequencies = held.select("n", F.explode("tokens").alias("token"))
        frequencies = frequencies.groupBy("token").agg(F.sum("n").alias("n"))
        decided = judge(held.select("tokens"), mined, frequencies)
        decided = store(decided.withColumnRenamed("tokens", "items"), "decided")
        judged = left_join_measured(open_sets, decided, ["items"])
        judged = store(judged.filter("judged IS NOT NULL").select("tokens", "judged", "confidence"), "judged")
    # Many URLs may have the same tokens.
    found = left_join_measured(rows, judged, ["tokens"])
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "judged", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.col("confidence")).alias("confidence"),
    )
