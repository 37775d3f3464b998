"""Near-duplicate documents by SuperMinHash bands, exact verification and union-find.

Documents with equal shingle sets are one node. Nodes that share a band meet in a bucket.
A bucket of up to ``TILE`` nodes is compared as a whole. A larger one is first compared
with its hub, the node that meets most others, and large buckets with the same hub count
as one: that joins most of a group of near copies at a cost that grows with its size. Only
nodes that are then still apart from the hub are compared further, in tiles of ``TILE``
times ``TILE`` nodes, and tiles are left out where their distances to the hub rule out a
link (Jaccard distance is a metric). So every pair
that shares a bucket is compared, known to be joined, or proven too far apart; no task
holds more than two tiles' sides, and no pair becomes a row.

Links are confirmed on full shingle sets. A pair at the threshold misses all bands with
probability (1 - threshold**rows)**bands: 8e-7 at 0.85 with 24 bands of 5, 1e-7 at 0.8 with
30 bands of 4.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from klaxon.llm.batches import schema_of, slices, to_batch
from klaxon.llm.components import connected_components
from klaxon.llm.numbering import partitions_of, ranked
from klaxon.llm.superminhash import band_numbers, signatures
from klaxon.llm.words import mixed, shingle_set
from klaxon.operators.joins import left_join_measured
from klaxon.session import settle, store

TILE = 128
# Distances to a hub are sorted into this many steps.
STEPS = 20
# Rows of tiles sent to all tasks, of 32 bytes each.
MOST_SENT = 500_000
# Bytes of labels sent to all tasks.
LABEL_BYTES = 16 << 20

PRINTS = "doc_id bigint, key bigint, n_shingles bigint, digest bigint, check bigint, bands array<bigint>"
LINKS = "bucket bigint, a bigint, b bigint, similarity double"


def _keyed(docs: DataFrame) -> DataFrame:
    number = F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(number, F.xxhash64("text").alias("key"), "text")


def fingerprints(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Size, digest and bands of the shingle set of every text; no bands for an empty set. The key
    tells texts of one doc_id apart."""
    salt = np.uint64(0xD6E8FEB86659FD93)

    def prints(batches):
        for some in slices(batches):
            sets = [shingle_set(text, width) for text in some.column(2).to_pylist()]
            numbers = band_numbers(signatures(sets, bands * rows), bands, rows)
            digests = [int(mixed(one).sum(dtype=np.uint64).view(np.int64)) for one in sets]
            checks = [int(mixed(one ^ salt).sum(dtype=np.uint64).view(np.int64)) for one in sets]
            sizes = [len(one) for one in sets]
            offsets = np.concatenate([[0], np.cumsum([bands * (n > 0) for n in sizes])])
            filled = np.array(sizes) > 0
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    some.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.int64()),
                    pa.array(checks, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(numbers[filled].ravel())
                    ),
                ],
                schema=schema_of(PRINTS),
            )

    return _keyed(docs).mapInArrow(prints, PRINTS)


# -- comparing the nodes of a tile ------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets, from products of 0/1 matrices."""
    found = np.zeros((len(sets), len(sets)), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    values, column, count = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = 8192
    edges = np.searchsorted(column, np.arange(0, len(values) + step, step))
    for block, (start, end) in enumerate(zip(edges[:-1], edges[1:])):
        if start < end:
            matrix = np.zeros((len(sets), step), np.float32)
            matrix[owner[start:end], column[start:end] - block * step] = 1
            found += matrix @ matrix.T
    np.fill_diagonal(found, [len(one) for one in sets])
    return found.astype(np.int64)


def _compared(nodes, texts, left, right, hub, width, percent):
    """(node, smallest node it is joined to, similarity to the hub) for the nodes of a tile;
    ``left`` and ``right`` say which sides a node is on, pairs go from left to right."""
    sets = [shingle_set(text, width) for text in texts]
    both = overlaps(sets)
    sizes = np.diag(both)
    union = sizes[:, None] + sizes[None, :] - both
    linked = (100 * both >= percent * union) & (left[:, None] & right[None, :])
    linked |= linked.T
    # Labels spread along links until nothing changes.
    label = np.array(nodes)
    while True:
        spread = np.where(linked, label[None, :], label[:, None]).min(axis=1)
        if (spread == label).all():
            break
        label = spread
    near = both[hub] / union[hub] if hub is not None else np.full(len(nodes), np.nan)
    return [(node, int(to), float(s)) for node, to, s in zip(nodes, label, near)]


def _tiles(batches: Iterator[pa.RecordBatch]):
    """Rows of one tile after another from rows sorted by tile."""
    key, rows = None, []
    for batch in slices(batches):
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if row[:3] != key:
                if rows:
                    yield key, rows
                key, rows = row[:3], []
            rows.append(row[3:])
    if rows:
        yield key, rows


def _compare(tiles: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """LINKS of tiles (bucket, i, j, side, node): side 0 meets all of its tile, 1 meets 2,
    3 is a hub that meets 2."""

    def links(batches):
        for (bucket, _, _), rows in _tiles(batches):
            # A node on both sides of a tile comes twice, which changes nothing.
            sides, nodes, words = zip(*rows)
            side = np.array(sides)
            hub = int(np.flatnonzero(side == 3)[0]) if (side == 3).any() else None
            left, right = (side != 2), (side == 0) | (side == 2)
            found = _compared(nodes, words, left, right, hub, width, percent)
            rows = [(bucket, a, b, s) for a, b, s in found if a != b or hub is not None]
            yield to_batch(rows, LINKS)

    if tiles.count() <= MOST_SENT:
        tiles = F.broadcast(tiles)
    matched = texts.join(tiles, texts["doc_id"] == tiles["node"])
    placed = matched.select("bucket", "i", "j", "side", "node", "text")
    ordered = placed.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return ordered.mapInArrow(links, LINKS)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, size, node) of buckets with several nodes; of buckets with the same nodes, as
    most bands of two near copies give, one."""
    pairs = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = pairs.groupBy("bucket").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    kept = sizes.filter("size > 1").groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket"))
    return store(pairs.join(kept.select("bucket", "size"), "bucket"), "buckets")


def _parts(size):
    """Number of tile sides for so many nodes."""
    return F.ceil(size / TILE).cast("int")


def _star_tiles(members: DataFrame) -> DataFrame:
    """Tiles that compare small buckets as a whole and large ones with their hub."""
    small = members.filter(F.col("size") <= TILE).select(
        "bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "node"
    )
    large = members.filter(F.col("size") > TILE)
    # The node that meets most others stands closest to what its group has in common. The
    # bands of a group of near copies share it, so their buckets become one: with them
    # apart, two nodes would meet in as many tiles as they share bands.
    met = large.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = large.join(met, "node").groupBy("bucket").agg(
        F.max_by("node", F.struct("met", -F.col("node"))).alias("hub")
    )
    stars = large.join(hubs, "bucket").select(F.col("hub").alias("bucket"), "node").distinct()
    stars = store(stars, "stars")
    sizes = stars.groupBy("bucket").agg(F.count("*").alias("size"))
    hub_rows = sizes.select(
        "bucket", F.explode(F.sequence(F.lit(0), _parts(F.col("size")) - 1)).alias("i")
    ).select("bucket", "i", F.lit(0).alias("j"), F.lit(3).alias("side"), F.col("bucket").alias("node"))
    chunk = F.pmod(F.xxhash64("node"), _parts(F.col("size"))).cast("int")
    others = stars.join(sizes, "bucket").select(
        "bucket", chunk.alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"), "node"
    )
    return small.unionByName(hub_rows).unionByName(others)


def _rest_tiles(seen: DataFrame, joined: DataFrame, reach: float) -> DataFrame:
    """Tiles for nodes of large buckets that are still apart from their hub.

    ``seen``: (bucket, a, similarity) of the nodes of large buckets; ``joined``: (id, component).
    """
    step = F.least(F.floor((1 - F.col("similarity")) * STEPS), F.lit(STEPS - 1)).cast("int")
    nodes = seen.select("bucket", F.col("a").alias("node"), step.alias("step"), "similarity")
    nodes = nodes.join(joined.withColumnRenamed("id", "node"), "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    hubs = nodes.groupBy("bucket").agg(F.max_by("component", "similarity").alias("main"))
    nodes = nodes.join(hubs, "bucket").withColumn("apart", F.col("component") != F.col("main"))
    # A bucket without such nodes is done.
    counts = nodes.groupBy("bucket", "step").agg(
        F.count("*").alias("n"), F.count_if("apart").alias("n_apart")
    )
    counts = settle(counts)
    rights = counts.select("bucket", F.col("step").alias("to"), "n")
    lefts = counts.filter("n_apart > 0").select("bucket", "step", "n_apart")
    # Nodes whose distances to the hub differ by more than the reach cannot be linked.
    pairs = lefts.join(rights, "bucket").filter(
        F.abs(F.col("step") - F.col("to")) - 1 <= reach * STEPS
    )
    every = lambda number: F.explode(F.sequence(F.lit(0), _parts(F.col(number)) - 1))
    pairs = pairs.select("*", every("n_apart").alias("l")).select("*", every("n").alias("r"))
    side = lambda step, part: F.col(step) * 1_000_000 + F.col(part)
    pairs = settle(pairs.select("bucket", "step", "l", "to", "r"))
    left = nodes.filter("apart").join(
        counts.select("bucket", "step", "n_apart"), ["bucket", "step"]
    )
    left = left.withColumn("l", F.pmod(F.xxhash64("node"), _parts(F.col("n_apart"))).cast("int"))
    left = left.join(pairs, ["bucket", "step", "l"])
    right = nodes.join(counts.select("bucket", "step", "n"), ["bucket", "step"])
    right = right.withColumn("r", F.pmod(F.xxhash64("node"), _parts(F.col("n"))).cast("int"))
    right = right.withColumnRenamed("step", "to").join(pairs, ["bucket", "to", "r"])
    place = [
        "bucket",
        side("step", "l").cast("int").alias("i"),
        side("to", "r").cast("int").alias("j"),
    ]
    return left.select(*place, F.lit(1).alias("side"), "node").unionByName(
        right.select(*place, F.lit(2).alias("side"), "node")
    )


def _linked(docs, prints, width, percent) -> DataFrame:
    """(doc_id, key, n_shingles, component) for every row; each doc_id has one text."""
    same = ["n_shingles", "digest", "check"]
    filled = prints.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = filled.groupBy(*same).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    nodes = store(nodes, "nodes")
    members = _buckets(nodes)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    links = store(_compare(store(_star_tiles(members), "tiles"), texts, width, percent), "links")
    joined = connected_components(links)
    seen = links.filter(~F.isnan("similarity")).select("bucket", "a", "similarity")
    rest = store(_rest_tiles(seen, joined, 1 - percent / 100), "tiles")
    if not rest.isEmpty():
        more = _compare(rest, texts, width, percent).select("a", "b")
        joined = connected_components(links.select("a", "b").unionByName(more))
    labels = nodes.join(joined, nodes["node"] == joined["id"], "left").select(
        *same, F.coalesce("component", "node").alias("component")
    )
    # Equal texts of any number have one label.
    found = left_join_measured(prints.drop("bands"), labels, same, max_bytes=LABEL_BYTES)
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return found.select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component"),
    )


def _judged(docs, width, percent, bands, rows) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept) for every row of ``docs``."""
    prints = store(fingerprints(docs, width, bands, rows), "fingerprints")
    keys = prints.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("key").alias("least"), F.max("key").alias("most")
    )
    if keys.filter("least != most").isEmpty():
        found = _linked(docs, prints, width, percent)
        return found.select(
            "doc_id",
            "key",
            "n_shingles",
            F.col("component").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    # Different texts of one doc_id take numbers of their own, in the order of their ids.
    order = ["doc_id", "key"]
    numbers = prints.filter("doc_id IS NOT NULL").select(*order).distinct()
    parts = partitions_of(docs.sparkSession)
    placed = settle(numbers.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    numbers = store(ranked(placed, [], "number"), "numbers")

    def numbered(some: DataFrame) -> DataFrame:
        with_number = left_join_measured(some, numbers, order)
        return with_number.drop("doc_id").withColumnRenamed("number", "doc_id")

    found = _linked(numbered(_keyed(docs)), store(numbered(prints), "fingerprints"), width, percent)
    own = numbers.select(F.col("number").alias("doc_id"), F.col("doc_id").alias("own_id"))
    to = numbers.select(F.col("number").alias("component"), F.col("doc_id").alias("component_id"))
    found = left_join_measured(left_join_measured(found, own, ["doc_id"]), to, ["component"])
    return found.select(
        F.col("own_id").alias("doc_id"),
        "key",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 30, rows: int = 4
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of ``percent`` of their shingles.

    Returns doc_id, n_shingles, component_id (smallest doc_id that links reach) and kept
    (the row stands for its group) for every row of ``docs``; other columns play no part.
    Documents without words are linked with nothing, rows without doc_id too: their
    component is null and they are kept. Rows of one doc_id with different texts are
    judged each by its text: kept is then the first of its group in the order of ids, of one
    id in that of a hash of its text. Equal rows come back as often as they occur.
    """
    return _judged(docs, width, percent, bands, rows).drop("key")


def without_near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 30, rows: int = 4
) -> DataFrame:
    """One row of each group of ``docs``, all columns as they are: that of the smallest doc_id.

    Rows are judged by doc_id and text, so a text never goes because another one has its
    doc_id. Of rows with the same doc_id and text one stays, the first by its other columns.
    Rows without doc_id stay, as they cannot be told apart.
    """
    groups = _judged(docs, width, percent, bands, rows).filter("doc_id IS NOT NULL")
    judged = groups.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.count("*").alias("_n"), F.bool_and("kept").alias("_kept")
    )
    marked = store(judged.filter("_n > 1 OR NOT _kept"), "marked")
    match = [docs["doc_id"] == F.col("_id"), F.xxhash64(docs["text"]) == F.col("_key")]
    gone = _sendable(marked.filter("NOT _kept").select("_id", "_key"))
    repeated = marked.filter("_kept").select("_id", "_key")
    if repeated.isEmpty():
        return docs.join(gone, match, "left_anti")
    repeated = _sendable(repeated)
    others = docs.join(_sendable(marked.select("_id", "_key")), match, "left_anti")
    # The first of each task first, so that no task takes all copies of a row.
    some = docs.join(repeated, match).withColumn("_part", F.spark_partition_id())
    by = [F.col(name) for name, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    in_part, in_all = Window.partitionBy("_id", "_key", "_part"), Window.partitionBy("_id", "_key")
    for window in (in_part, in_all):
        some = some.withColumn("_n", F.row_number().over(window.orderBy(*by))).filter("_n = 1")
    return others.unionByName(some.select(*docs.columns))


def _sendable(ids: DataFrame) -> DataFrame:
    """Ids with a broadcast hint if they are few, so that texts need not be shuffled."""
    return F.broadcast(ids) if ids.count() <= MOST_SENT else ids
