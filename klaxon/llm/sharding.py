"""Shards by a hierarchical weighted hash tree, in DataFrame functions alone.

A document descends region, rack and shard. At each level every child draws the
exponential number -ln(u) / weight, u from a hash of the document and the child's name, and
the smallest draw wins: a child is taken with a probability in proportion to its weight,
and a change of one weight moves documents only to or from that child. A subtree whose
weights stay keeps its documents in place.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klaxon.llm.numbering import ranked
from klaxon.session import store


class Node(NamedTuple):
    """A subtree with its weight, or a shard with its number."""

    name: str
    weight: float
    children: tuple = ()
    shard: int | None = None


def subtree(name: str, children: list[Node]) -> Node:
    """A node as heavy as its children together."""
    return Node(name, sum(child.weight for child in children), tuple(children))


def tree_of(shards: int, per_rack: int = 2, racks: int = 2, founding: int = 8) -> Node:
    """The tree for a number of shards of weight 1.

    The first ``founding`` shards fill regions of ``racks`` racks of ``per_rack`` shards. Each
    further one opens a region of its own, so that the root is the only node whose choice
    changes: it takes documents from all regions and none moves between the others.
    """

    def leaf(number):
        return Node(f"shard{number}", 1.0, shard=number)

    regions, number = [], 0
    while number < min(shards, founding):
        inner = []
        while number < min(shards, founding) and len(inner) < racks:
            numbers = range(number, min(number + per_rack, shards, founding))
            inner.append(subtree(f"rack{number}", [leaf(n) for n in numbers]))
            number += len(numbers)
        regions.append(subtree(f"region{len(regions)}", inner))
    for number in range(founding, shards):
        rack = subtree(f"rack{number}", [leaf(number)])
        regions.append(subtree(f"region{len(regions)}", [rack]))
    return subtree("root", regions)


def _draw(key: Column, child: Node) -> Column:
    # The upper 53 bits as a number between 0 and 1, neither included.
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(child.name), key), 11)
    return -F.ln((bits + 0.5) / float(1 << 53)) / child.weight


def shard_of(key: Column, node: Node) -> Column:
    """The shard to which a key descends from a node; a null key descends like any other."""
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0])
    draws = [
        F.struct(_draw(key, child).alias("draw"), F.lit(at).alias("at"))
        for at, child in enumerate(node.children)
    ]
    taken = F.array_min(F.array(*draws))["at"]
    return F.element_at(
        F.array(*[shard_of(key, child) for child in node.children]), taken + 1
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of ``docs``.

    The law is ``key``: ``doc_id`` and the number of shards decide, so repeated ids share a
    shard. ``slot`` numbers the rows of a shard from 0 without gaps. A null text has the
    size 1 and the crc32 of an empty one. Other columns play no part.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = placed.select(
        "*",
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree_of(shards)).alias("shard"),
        shard_of(F.col("doc_id"), tree_of(shards + 1)).alias("grown_shard"),
    )
    numbered = ranked(store(placed, "shards"), ["shard"], "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint"), "grown_shard"
    )
