"""Near-duplicate vectors by product quantisation.

A coarse quantiser deals vectors to inverted lists; what is left of a vector beside its
list's centre is coded in subspaces. A vector looks into its own list and every earlier one
whose border it may cross, so that two vectors meet once: ``y`` near ``x`` lies in list
``c`` instead of ``x``'s only if moving from ``x`` to ``y`` gains on ``c`` what ``x`` is
short of, and the reach of that move toward ``c`` is at most the link radius, so that no link
is lost whatever the vectors look like. A caller who knows that vectors vary in all dimensions
alike may shorten it: the part of a move in no special direction toward a given centre is near
1 / sqrt(dimension) of its length, and ``aim`` is a multiple of that. In a list, distances to the coded vectors are sums of table entries. A
vector's own coding error bounds how far that is from the truth, so none within the radius
is dismissed, and what remains is compared exactly in double precision.

A vector is sent once to TOGETHER lists of which it looks into any. They are cut into blocks, and so are the vectors that look into one, so that a list may
hold all vectors. Only numbers of links and the smallest partner leave a block, no pairs.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klaxon.llm.batches import to_batch
from klaxon.llm.components import connected_components
from klaxon.llm.numbering import partitions_of, ranked
from klaxon.operators.joins import left_join_measured
from klaxon.session import settle, store

# Vectors that the quantisers are fitted to, at most.
SAMPLE = 20_000
LISTS = 256
SUBSPACES = 8
CODES = 64
# Rows of a block, and of the vectors that look into it.
BLOCK = 2048
LOOKING = 8192
# Lists that a vector is sent to at once.
TOGETHER = 16
# Multiple of 1 / sqrt(dimension) for vectors known to vary in all dimensions alike; others
# lose links by it.
AIM = 3.5

# Vectors travel in the type they came in and are brought to length 1 where they are used.
ENTRIES = (
    "list int, node bigint, copies bigint, vector binary, codes binary, error double, "
    "probes array<bigint>"
)
FOUND = "node bigint, links bigint, to bigint"


def _nearest(points, centres):
    """Squared distances to all centres."""
    return (
        (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    )


def k_means(points: np.ndarray, number: int, rounds: int = 12) -> np.ndarray:
    """Centres after Lloyd's rounds, begun at points picked by a fixed seed."""
    kinds = np.unique(points, axis=0)
    number = min(number, len(kinds))
    centres = kinds[np.random.default_rng(7).permutation(len(kinds))[:number]].copy()
    for _ in range(rounds):
        owner = _nearest(points, centres).argmin(1)
        size = np.bincount(owner, minlength=number)
        order = np.argsort(owner, kind="stable")
        filled = np.flatnonzero(size)
        starts = (np.cumsum(size) - size)[filled]
        centres[filled] = np.add.reduceat(points[order], starts) / size[filled][:, None]
    return centres


def fit_quantiser(sample, lists, subspaces, codes):
    """Coarse centres and a code book for each subspace of the residuals."""
    centres = k_means(sample, lists)
    rest = sample - centres[_nearest(sample, centres).argmin(1)]
    parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
    return centres, [k_means(rest[:, part], codes) for part in parts]


class Quantiser:
    """Lists and codes of vectors by centres and code books."""

    def __init__(self, centres, books):
        self.centres, self.books = centres, books
        ends = np.cumsum([book.shape[1] for book in books]).tolist()
        self.spans = list(zip([0, *ends], ends))
        self.apart = np.sqrt(np.maximum(_nearest(centres, centres), 0))

    def lists_of(self, points, reach):
        """Own list, and a mask of the lists to look into, of which it is the last."""
        far = _nearest(points, self.centres)
        own = far.argmin(1)
        short = far - far[np.arange(len(points)), own][:, None]
        near = short <= 2 * reach * self.apart[own] + 1e-9
        return own, near & (np.arange(len(self.centres)) <= own[:, None])

    def encode(self, rest):
        codes = [
            _nearest(rest[:, a:b], book).argmin(1).astype(np.uint8)
            for (a, b), book in zip(self.spans, self.books)
        ]
        coded = np.concatenate([book[code] for code, book in zip(codes, self.books)], 1)
        return np.stack(codes, 1), np.sqrt(((rest - coded) ** 2).sum(1))

    def distances(self, rest, codes):
        """Squared distances of some residuals to coded ones."""
        # A row per code, as whole rows are picked faster than columns.
        total = np.zeros((len(codes), len(rest)))
        for at, ((a, b), book) in enumerate(zip(self.spans, self.books)):
            total += _nearest(book, rest[:, a:b])[codes[:, at]]
        return total.T


def _unit_rows(points):
    """Vectors in double precision and of length 1."""
    points = points.astype(np.float64)
    # Scaled first, so that no square overflows or vanishes.
    points /= np.abs(points).max(1, keepdims=True)
    return points / np.sqrt((points**2).sum(1))[:, None]


def _matrix(column):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vector="embedding"):
    """Whether a vector may be linked: not null, all components finite, one of them not 0."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _entries(nodes: DataFrame, sent, reach: float) -> DataFrame:
    def assign(batches):
        quantiser = Quantiser(*sent.value)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                some = batch.slice(at, BLOCK)
                given = _matrix(some.column(2))
                points = _unit_rows(given)
                own, mask = quantiser.lists_of(points, reach)
                codes, error = quantiser.encode(points - quantiser.centres[own])
                starts = np.arange(0, mask.shape[1], TOGETHER)
                places = np.logical_or.reduceat(mask, starts, axis=1)
                rows = [
                    (int(l), node, copies, p.tobytes(), c.tobytes(), float(e), np.flatnonzero(m).tolist())
                    for l, node, copies, p, c, e, m in zip(
                        own,
                        some.column(0).to_pylist(),
                        some.column(1).to_pylist(),
                        given,
                        codes,
                        error,
                        places,
                    )
                ]
                yield to_batch(rows, ENTRIES)

    return nodes.select("node", "copies", "embedding").mapInArrow(assign, ENTRIES)


def _block_links(quantiser, place, entries, looking, cosine):
    """FOUND rows of a block of list ``place``: (node, copies, vector, ...) on both sides."""
    entry_ids, entry_copies = entries["node"], entries["copies"]
    centre, radius = quantiser.centres[place], math.sqrt(2 - 2 * cosine)
    points = entries["vector"]
    within = (radius + entries["error"] + 1e-6) ** 2
    entry_links = np.zeros(len(points), np.int64)
    ids, links, ones, others = [], [], [], []
    for start in range(0, len(looking["node"]), 512):
        cut = slice(start, start + 512)
        x, x_ids = looking["vector"][cut], looking["node"][cut]
        near = quantiser.distances(x - centre, entries["codes"]) <= within[None, :]
        rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(rows):
            continue
        exact = x[rows] @ points[columns].T
        linked = (exact >= cosine) & near[np.ix_(rows, columns)]
        # Two of the same list look at each other: the larger id's look counts.
        inside = (looking["list"][cut][rows] == place)[:, None]
        linked &= ~inside | (x_ids[rows][:, None] > entry_ids[columns][None, :])
        r, c = np.nonzero(linked)
        if not len(r):
            continue
        r, c = rows[r], columns[c]
        entry_links += np.bincount(c, looking["copies"][cut][r], len(points)).astype(np.int64)
        count = np.bincount(r, entry_copies[c], len(x)).astype(np.int64)
        ids.append(x_ids[count > 0])
        links.append(count[count > 0])
        ones.append(x_ids[r])
        others.append(entry_ids[c])
    ids.append(entry_ids[entry_links > 0])
    links.append(entry_links[entry_links > 0])
    ids, links = np.concatenate(ids), np.concatenate(links)
    if not len(ids):
        return []
    # Smallest id that each node reaches inside the block.
    ones, others = np.concatenate(ones), np.concatenate(others)
    kinds, place = np.unique(np.concatenate([ones, others]), return_inverse=True)
    a, b = place[: len(ones)], place[len(ones) :]
    label = np.arange(len(kinds))
    while True:
        least = np.minimum(label[a], label[b])
        spread = label.copy()
        np.minimum.at(spread, a, least)
        np.minimum.at(spread, b, least)
        spread = spread[spread]
        if (spread == label).all():
            break
        label = spread
    to = kinds[label[np.searchsorted(kinds, ids)]]
    return list(zip(ids.tolist(), links.tolist(), to.tolist()))


def _links(entries: DataFrame, sent, cosine: float, reach: float, kind) -> DataFrame:
    """FOUND rows of all blocks; ``kind`` is the numpy type of the vectors."""
    together = (F.col("list") / TOGETHER).cast("int")
    # One row per place, which is TOGETHER lists.
    sizes = entries.groupBy(together.alias("place")).agg(F.count("*").alias("n"))
    sizes = {row["place"]: row["n"] for row in sizes.collect()}
    looks = entries.select(F.explode("probes").alias("place")).groupBy("place").agg(F.count("*").alias("n"))
    looks = {row["place"]: row["n"] for row in looks.collect()}
    parts = [
        (place, -(-size // BLOCK), -(-looks.get(place, 0) // LOOKING))
        for place, size in sizes.items()
    ]
    parts = F.broadcast(
        entries.sparkSession.createDataFrame(parts, "place int, blocks int, groups int")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    salt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    own = entries.withColumn("place", together).join(parts, "place")
    own = own.filter("groups > 0").select("*", salt("blocks").alias("block"), every("groups").alias("group"))
    looking = entries.select(
        F.explode("probes").alias("place"), "list", "node", "copies", "vector"
    )
    looking = looking.withColumn("place", F.col("place").cast("int")).join(parts, "place")
    looking = looking.select("*", every("blocks").alias("block"), salt("groups").alias("group"))
    columns = ["place", "block", "group", "side", "list", "node", "copies", "vector"]
    none = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error")]
    sides = own.withColumn("side", F.lit(0)).select(*columns, "codes", "error")
    sides = sides.unionByName(looking.withColumn("side", F.lit(1)).select(*columns, *none))
    tile = ["place", "block", "group"]
    ordered = sides.repartition(*tile).sortWithinPartitions(*tile, "side")

    def compare(batches):
        quantiser = Quantiser(*sent.value)

        def found(table):
            ids = table.column("side").to_numpy()
            ends = int((ids == 0).sum())

            def numbers(part, name):
                return part.column(name).to_numpy()

            def matrix(part, name, kind, width):
                data = b"".join(part.column(name).to_pylist())
                return np.frombuffer(data, kind).reshape(-1, width)

            width = quantiser.centres.shape[1]
            one, other = table.slice(0, ends), table.slice(ends)
            entries = {name: numbers(one, name) for name in ("list", "node", "copies", "error")}
            entries["vector"] = _unit_rows(matrix(one, "vector", kind, width))
            entries["codes"] = matrix(one, "codes", np.uint8, len(quantiser.spans))
            looking = {name: numbers(other, name) for name in ("list", "node", "copies")}
            looking["vector"] = _unit_rows(matrix(other, "vector", kind, width))
            _, mask = quantiser.lists_of(looking["vector"], reach)
            # A vector looks into its own list and earlier ones, whatever rounding says now.
            at = np.arange(mask.shape[1])
            mask = (mask | (at == looking["list"][:, None])) & (at <= looking["list"][:, None])
            rows = []
            for place in np.unique(entries["list"]).tolist():
                held, looks = entries["list"] == place, mask[:, place]
                if looks.any():
                    some = {name: column[held] for name, column in entries.items()}
                    others = {name: column[looks] for name, column in looking.items()}
                    rows += _block_links(quantiser, place, some, others, cosine)
            return to_batch(rows, FOUND)

        key, held = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            changes = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            cuts = [0, *changes.tolist(), len(batch)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if start == end:
                    continue
                now = tuple(keys[start])
                if held and now != key:
                    yield found(pa.concat_tables(held))
                    held = []
                key = now
                held.append(table.slice(start, end - start))
        if held:
            yield found(pa.concat_tables(held))

    return ordered.mapInArrow(compare, FOUND)


def _linked(nodes: DataFrame, dimension: int, cosine: float, lists: int, aim: float | None):
    """FOUND rows of nodes of one dimension."""
    spark = nodes.sparkSession
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()
    given = _matrix(sample.column(0).combine_chunks())
    points = _unit_rows(given)
    sent = spark.sparkContext.broadcast(fit_quantiser(points, lists, SUBSPACES, CODES))
    reach = math.sqrt(2 - 2 * cosine)
    if aim is not None:
        reach *= min(1.0, aim / math.sqrt(dimension))
    entries = store(_entries(nodes, sent, reach), "entries")
    return _links(entries, sent, cosine, reach, given.dtype)


def _numbered(nodes: DataFrame) -> DataFrame:
    """Nodes with numbers of their own as ``node``, in the order of their smallest ``id``; one id
    may name several vectors."""
    nodes = nodes.withColumn("id", F.col("node"))
    if nodes.groupBy("node").count().filter("count > 1").isEmpty():
        return nodes
    order = ["node", "h1", "h2"]
    parts = partitions_of(nodes.sparkSession)
    placed = nodes.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbers = ranked(settle(placed), [], "number").select("h1", "h2", "number")
    joined = nodes.drop("node").join(numbers, ["h1", "h2"])
    return store(joined.withColumnRenamed("number", "node"), "vectors")


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = 0.9, lists: int = LISTS, aim: float | None = None
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``.

    Vectors are linked by a cosine of at least ``cosine``, all of them unless ``aim`` shortens
    the reach of the search; those of different dimensions, and
    null, zero or not finite ones, are linked with nothing. Equal vectors are one node while
    lists are searched and count as so many links. Rows without vec_id are linked with
    nothing, their component is null and they are kept. Rows of one vec_id with different
    vectors are searched each by its vector, and each counts as kept or not by itself. Other
    columns play no part.
    """
    vector = F.col("embedding")
    if vectors.schema["embedding"].dataType != T.ArrayType(T.FloatType()):
        vector = vector.cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("embedding")
    )
    rows = rows.withColumn("usable", usable() & F.col("vec_id").isNotNull())
    rows = rows.withColumns(
        {
            "h1": F.when(F.col("usable"), F.xxhash64("embedding")),
            "h2": F.when(F.col("usable"), F.xxhash64(F.lit(1), "embedding")),
        }
    )
    nodes = rows.filter("usable").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("node"),
        F.count("*").alias("copies"),
        F.first("embedding").alias("embedding"),
    )
    nodes = _numbered(store(nodes, "vectors"))
    # One row per dimension.
    dimensions = [row[0] for row in nodes.select(F.size("embedding")).distinct().collect()]
    found = vectors.sparkSession.createDataFrame([], FOUND)
    for dimension in sorted(dimensions):
        same = nodes.filter(F.size("embedding") == dimension)
        found = found.unionByName(_linked(same, dimension, cosine, lists, aim))
    found = store(found, "links")
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = nodes.select("h1", "h2", "node", "id", "copies").join(links, "node", "left")
    labels = labels.join(joined.withColumnRenamed("id", "node"), "node", "left")
    to = nodes.select(F.col("node").alias("component"), F.col("id").alias("component_id"))
    labels = labels.withColumn("component", F.coalesce("component", "node"))
    labels = labels.join(to, "component").select(
        "h1",
        "h2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
        # The smallest id of the component's first vector stands for it.
        (F.col("node") == F.col("component")).alias("first"),
    )
    # A vector may have a third of all rows, and unusable ones have no key at all.
    found = left_join_measured(rows.select("vec_id", "h1", "h2"), labels, ["h1", "h2"])
    component = F.coalesce("component_id", "vec_id")
    kept = F.coalesce("first", F.lit(True)) & (F.col("vec_id") == component)
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(kept, F.lit(True)).alias("kept"),
    )
