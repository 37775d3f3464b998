"""Web archives and their fixity audit by Merkle trees.

An archive is a table with a row per WARC record: its file (``shard``), its place there and
its bytes, which put together by ``offset`` are the file. An audit hashes each record, then
the records of each range of ``RANGE`` bytes of a file in the order of their offsets, then
``FANOUT`` ranges at a time, up to one root per file. Replicas with equal roots are equal.
Where roots differ, only the branches that differ are descended, down to the records.
"""

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import to_batch
from klaxon.session import settle, store

RANGE = 1 << 16
FANOUT = 16
# Nodes that differ and are sent to all tasks, of 12 bytes each; more are joined by a shuffle.
MOST_SENT = 500_000

ARCHIVE = "shard int, offset bigint, length bigint, page_id bigint, record binary"
CHANGED, MISSING, EXTRA = "changed", "missing", "extra"


def warc_record(page_id, url, html, date: str) -> bytes:
    """A resource record; a null url has no target line, a null html no payload."""
    payload = (html or "").encode()
    lines = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:page:{page_id}>"]
    if url is not None:
        # A line break would end the line.
        target = url.replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {target}")
    lines += [f"WARC-Date: {date}", "Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join([*lines, "", ""]).encode() + payload + b"\r\n\r\n"


def write_archive(pages: DataFrame, out: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write every row of ``pages`` as a record, a file per task, in the order of the input.

    Nothing is shuffled. Rows without page_id are records like any other, repeated rows one
    each; other columns play no part.
    """

    def records(batches):
        shard, offset = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for page, url, html in zip(*[column.to_pylist() for column in batch.columns]):
                record = warc_record(page, url, html, date)
                rows.append((shard, offset, len(record), page, record))
                offset += len(record)
            yield to_batch(rows, ARCHIVE)

    chosen = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    chosen.mapInArrow(records, ARCHIVE).write.parquet(out)


def leaves(archive: DataFrame) -> DataFrame:
    """Place and digest of every record, from the bytes that are there."""
    return archive.select(
        "shard", "offset", F.length("record").cast("bigint").alias("length"), "page_id",
        F.sha2("record", 256).alias("digest"),
    )


def _node_digest(*place: str) -> Column:
    """Digest of children in the order of their places, which it covers too."""
    children = F.array_sort(F.collect_list(F.struct(*place, "digest")))
    texts = F.transform(children, lambda child: F.concat_ws(":", *[child[p] for p in place], child["digest"]))
    return F.sha2(F.array_join(texts, "|").cast("binary"), 256).alias("digest")


def merkle_levels(records: DataFrame, levels: int) -> list[DataFrame]:
    """(shard, node, digest) of each level, ranges first, roots last.

    A node has the records of a range of bytes or ``FANOUT`` nodes as children, so none
    gathers more.
    """
    node = F.floor(F.col("offset") / RANGE).alias("node")
    level = records.groupBy("shard", node).agg(_node_digest("offset", "length"))
    found = [store(level, "merkle")]
    for _ in range(levels):
        parent = F.floor(F.col("node") / FANOUT).alias("parent")
        level = found[-1].groupBy("shard", parent).agg(_node_digest("node"))
        found.append(store(level.withColumnRenamed("parent", "node"), "merkle"))
    return found


def _sent(nodes: DataFrame) -> DataFrame:
    return F.broadcast(nodes) if nodes.count() <= MOST_SENT else nodes


def _below(level: DataFrame, parents: DataFrame, place: str, width: int) -> DataFrame:
    """Rows of a level whose parents are among those that differ."""
    parents = parents.select(F.col("shard").alias("_shard"), F.col("node").alias("_node"))
    same = [F.col("shard") == F.col("_shard"), F.floor(F.col(place) / width) == F.col("_node")]
    return level.join(_sent(parents), same, "left_semi")


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes that only one side has, or with another digest."""
    other = right.withColumnRenamed("digest", "other")
    both = left.join(other, ["shard", "node"], "full")
    return settle(both.filter(~F.col("digest").eqNullSafe(F.col("other"))).select("shard", "node"))


def audit(archive: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which two replicas differ.

    Returns shard, offset, page_id, finding (``changed``, ``missing`` from the replica or
    ``extra`` in it), length and digest in the archive, found_length and found_digest in
    the replica. Equal replicas, empty ones among them, give no rows.
    """
    left, right = store(leaves(archive), "leaves"), store(leaves(replica), "leaves")
    ends = left.unionByName(right).agg(F.max("offset")).first()[0] or 0
    levels, ranges = 0, ends // RANGE + 1
    while ranges > 1:
        levels, ranges = levels + 1, -(-ranges // FANOUT)
    trees = merkle_levels(left, levels), merkle_levels(right, levels)
    differing = _differing(trees[0][-1], trees[1][-1])
    for one, other in zip(trees[0][-2::-1], trees[1][-2::-1]):
        differing = _differing(
            _below(one, differing, "node", FANOUT), _below(other, differing, "node", FANOUT)
        )
    one = _below(left, differing, "offset", RANGE)
    other = _below(right, differing, "offset", RANGE).select(
        "shard", "offset", F.col("page_id").alias("_page"),
        F.col("length").alias("found_length"), F.col("digest").alias("found_digest"),
    )
    both = one.join(other, ["shard", "offset"], "full")
    finding = (
        F.when(F.col("found_digest").isNull(), MISSING)
        .when(F.col("digest").isNull(), EXTRA)
        .otherwise(CHANGED)
    )
    differs = ~F.col("digest").eqNullSafe(F.col("found_digest"))
    return both.filter(differs).select(
        "shard", "offset", F.coalesce("page_id", "_page").alias("page_id"),
        finding.alias("finding"), "length", "digest", "found_length", "found_digest",
    )
