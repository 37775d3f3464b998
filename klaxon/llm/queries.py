"""Queries of this package, with the parameters meant for production."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klaxon.llm import (
    anchors,
    decontamination,
    grammar,
    html_text,
    importance,
    minhash,
    packing,
    sharding,
    spelling,
    toxicity,
    url_rules,
    vectors,
    warc,
)
from klaxon.session import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_superminhash_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, width=3, percent=85, bands=24, rows=5)


def op2_merkle_fixity(spark, sf_dir):
    """All pages as an archive, and a replica with damage: one page in 211 is lost, one in 101
    has another first byte."""
    path, copy = new_folder(spark, "archive"), new_folder(spark, "replica")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    archive = spark.read.parquet(path)
    bad = F.concat(F.lit(b"w"), F.substring("record", 2, 1 << 30))
    record = F.when(F.col("page_id") % 101 == 7, bad).otherwise(F.col("record"))
    damaged = archive.filter(F.coalesce(F.col("page_id") % 211 != 5, F.lit(True)))
    damaged.withColumn("record", record).write.parquet(copy)
    found = warc.audit(archive, spark.read.parquet(copy))
    # Which file a record is in depends on how Spark divides the table.
    return found.drop("shard", "offset")


def op3_kneser_ney_toxicity(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), labels)


def op4_token_ids(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return grammar.token_table(_table(spark, sf_dir, "documents"), path)


def op5_product_quantisation(spark, sf_dir):
    return vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op6_association_rules(spark, sf_dir):
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"))


def op7_text_to_tag_ratio(spark, sf_dir):
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op8_hash_tree_sharding(spark, sf_dir):
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op9_greedy_string_tiling(spark, sf_dir):
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), benchmark)


def op10_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), path)


def op11_importance_resampling(spark, sf_dir):
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.importance_sample(docs, target)


def op12_spelling_variants(spark, sf_dir):
    """One occurrence of about 199 has lost a letter."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), every=199)


def op13_fixed_block_anchors(spark, sf_dir):
    found = anchors.without_repeats(_table(spark, sf_dir, "documents"))
    total = lambda name: F.aggregate(name, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return found.select(
        "doc_id",
        "n_words",
        (total("ends") - total("starts")).alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def queries():
    return {
        "op1_superminhash_dedup": op1_superminhash_dedup,
        "op2_merkle_fixity": op2_merkle_fixity,
        "op3_kneser_ney_toxicity": op3_kneser_ney_toxicity,
        "op4_token_ids": op4_token_ids,
        "op5_product_quantisation": op5_product_quantisation,
        "op6_association_rules": op6_association_rules,
        "op7_text_to_tag_ratio": op7_text_to_tag_ratio,
        "op8_hash_tree_sharding": op8_hash_tree_sharding,
        "op9_greedy_string_tiling": op9_greedy_string_tiling,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_fixed_block_anchors": op13_fixed_block_anchors,
    }


_WARC_SQL = r"""
WITH records AS (
  SELECT page_id, array_to_string([
    'WARC/1.1', 'WARC-Type: resource', 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'None') || '>',
    CASE WHEN url IS NOT NULL THEN 'WARC-Target-URI: '
      || replace(replace(url, chr(13), '%0D'), chr(10), '%0A') END,
    'WARC-Date: 2024-01-01T00:00:00Z', 'Content-Type: text/html',
    'Content-Length: ' || octet_length(encode(coalesce(html, ''))), '', coalesce(html, ''), '', ''],
    chr(13) || chr(10)) AS record
  FROM pages)
SELECT page_id, CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS finding,
  octet_length(encode(record)) AS length, sha256(record) AS digest,
  CASE WHEN page_id % 211 != 5 THEN octet_length(encode(record)) END AS found_length,
  CASE WHEN page_id % 211 != 5 THEN sha256('w' || substr(record, 2)) END AS found_digest
FROM records WHERE page_id % 211 = 5 OR page_id % 101 = 7"""

_REPEATS_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (SELECT doc_id, words, unnest(range(0, len(words) - 19)) AS place FROM texts),
ordered AS (
  SELECT doc_id, place, row_number() OVER (
    PARTITION BY words[place + 1 : place + 20] ORDER BY doc_id, place) AS nth
  FROM places),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM ordered WHERE nth > 1),
single AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS place FROM texts),
marked AS (
  SELECT s.doc_id, s.word, s.place, r.place IS NOT NULL AS gone
  FROM single s LEFT JOIN removed r ON r.doc_id = s.doc_id AND r.place = s.place),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words,
  coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id"""


def _crc32_table():
    """What a crc32's lowest byte turns into when a byte moves out, by its polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def _crc32_sql(text):
    """SQL for the unsigned crc32 of a text's UTF-8 bytes."""
    byte = "CAST('0x' || substr(hex({0}), 2 * i + 1, 2) AS BIGINT)".format(text)
    listed = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    step = f"xor(c >> 8, {_crc32_table()}[xor(c & 255, b) + 1])"
    all_bytes = f"list_prepend(CAST(4294967295 AS BIGINT), {listed})"
    return f"xor(list_reduce({all_bytes}, lambda c, b: {step}), 4294967295)"


_CAPITALS = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_IMPORTANCE_SQL = f"""
WITH texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, doc_id, regexp_extract_all({_CAPITALS.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
places AS (
  SELECT side, doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS place
  FROM words, (VALUES (1), (2), (3)) AS sizes (size)),
features AS (
  SELECT side, doc_id, array_to_string(w[place : place + size - 1], ' ') AS feature, count(*) AS n
  FROM places GROUP BY ALL),
distinct_features AS (SELECT DISTINCT feature FROM features),
buckets AS (SELECT feature, {_crc32_sql("feature")} % 10000 AS bucket FROM distinct_features),
placed AS (SELECT f.side, f.doc_id, f.n, b.bucket FROM features f JOIN buckets b USING (feature)),
totals AS (
  SELECT CAST(sum(n) FILTER (side = 'd') AS DOUBLE) AS s_all,
    CAST(sum(n) FILTER (side = 't') AS DOUBLE) AS t_all FROM placed),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s,
    coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000)
    / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS gain FROM counts, totals),
sums AS (
  SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight, len(w.w) >= 20 AS eligible,
    CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x'
      || substr(sha256('42:' || w.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words w LEFT JOIN sums USING (doc_id) WHERE w.side = 'd'),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (eligible) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN eligible AND place <= 5 * n // 100 THEN place END AS rank FROM ordered"""

# Of letters beyond ASCII each becomes one ASCII letter, as the edit distance counts bytes.
_BEYOND = "".join(map(chr, range(0xC0, 0x100)))
_ONE_BYTE = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c not in "'\\")[:64]

_SPELLING_SQL = f"""
WITH runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_CAPITALS.format("coalesce(text, '')")},
    '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (SELECT *, doc_id || ':' || run AS key FROM counted),
hashed AS (SELECT run, n, {_crc32_sql("key")} AS h FROM keyed),
changed AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run))
    || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS size,
    translate(word, '{_BEYOND}', '{_ONE_BYTE}') AS plain
  FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM words a JOIN words b
    ON b.size BETWEEN a.size - 1 AND a.size + 1 AND a.word != b.word
    AND levenshtein(a.plain, b.plain) = 1),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n,
    arg_min(other, (-other_n, encode(other))) AS best FROM near GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN best_n >= 5 * w.n THEN best END AS form,
    CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
paths AS (
  WITH RECURSIVE up AS (
    SELECT word, word AS root, 0 AS steps FROM found
    UNION ALL SELECT u.word, f.form, steps + 1 FROM up u JOIN found f ON f.word = u.root
    WHERE f.form IS NOT NULL)
  SELECT word, arg_max(root, steps) AS root FROM up GROUP BY word)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n FROM found f JOIN paths p USING (word)"""


def oracle_sql():
    """Of the others, models, hashes and tokenizers are not within reach of SQL."""
    return {
        "op2_merkle_fixity": _WARC_SQL,
        "op11_importance_resampling": _IMPORTANCE_SQL,
        "op12_spelling_variants": _SPELLING_SQL,
        "op13_fixed_block_anchors": _REPEATS_SQL,
    }
