"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a key draws one number per child, ``-ln(u) / weight`` with ``u`` from a hash of
key and child, and descends into the child with the smallest. A child whose weight grows can
only gain keys from its siblings, so a change moves keys within the subtrees it touches and
nowhere else. A shard added beyond the tree becomes a region of its own: keys move into it
and between no others. Key and tree alone decide, so no row has to know of any other.

All of it is column expressions: no shuffle for the placement, one for the slots.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import bucket_count, hash52, prefix_sums

SCALE = float(2**52)


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. Leaves carry the shard number and a weight."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        if self.children:
            return math.fsum(c.weight for c in self.children)
        return self.leaf_weight


def even_tree(regions: int, racks: int, shards: int) -> Node:
    """A tree of equal weights; shards are numbered in order."""
    return Node(
        "root",
        tuple(
            Node(
                f"r{a}",
                tuple(
                    Node(
                        f"r{a}/k{b}",
                        tuple(
                            Node(f"r{a}/k{b}/s{n}", shard=n)
                            for c in range(shards)
                            for n in [(a * racks + b) * shards + c]
                        ),
                    )
                    for b in range(racks)
                ),
            )
            for a in range(regions)
        ),
    )


def leaves(tree: Node) -> int:
    return sum(leaves(c) for c in tree.children) if tree.children else 1


def grow(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, as a region of its own."""
    n = leaves(tree)
    region = f"r{len(tree.children)}"
    leaf = Node(f"{region}/k0/s{n}", shard=n, leaf_weight=weight)
    return Node(
        tree.name, (*tree.children, Node(region, (Node(f"{region}/k0", (leaf,)),))), None
    )


def shard_of(key: Column, tree: Node) -> Column:
    """The shard number of a key. A null key is a key like any other."""
    if not tree.children:
        return F.lit(tree.shard)
    live = [c for c in tree.children if c.weight > 0]
    if not live:
        raise ValueError(f"{tree.name} has no weight")
    if len(live) == 1:
        return shard_of(key, live[0])
    draws = [
        F.struct(
            (-F.ln((hash52(c.name, key) + 0.5) / SCALE) / c.weight).alias("draw"),
            F.lit(i).alias("child"),
        )
        for i, c in enumerate(live)
    ]
    if all(not c.children for c in live):
        numbers = F.array(*[F.lit(c.shard) for c in live])
        return F.element_at(numbers, F.array_min(F.array(*draws))["child"] + 1)
    # The chosen child is computed once and handed to the branches.
    return F.element_at(
        F.transform(
            F.array(F.array_min(F.array(*draws))["child"]),
            lambda chosen: F.coalesce(
                *[F.when(chosen == i, shard_of(key, c)) for i, c in enumerate(live)]
            ),
        ),
        1,
    )


def shard_documents(docs: DataFrame, tree: Node) -> DataFrame:
    """Place every document by its ``doc_id``.

    Adds ``size`` (UTF-8 bytes of the text plus 1; a null text has none), ``text_crc32`` (null
    for a null text), ``law`` (``key``), ``shard``, ``slot`` (gapless from 0 in each shard) and
    ``grown_shard``, the shard after one more is added. Columns of these names are replaced.
    Repeated rows share a shard and take neighbouring slots; an empty table stays empty.
    """
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    key = F.col("doc_id")
    placed = docs.drop(*added).withColumns(
        {
            "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
            "text_crc32": F.crc32(F.encode("text", "UTF-8")),
            "law": F.lit("key"),
            "shard": shard_of(key, tree),
            "grown_shard": shard_of(key, grow(tree)),
        }
    )
    buckets = bucket_count(docs)
    return prefix_sums(
        placed,
        "shard",
        F.pmod(hash52("slot", key), F.lit(buckets)),
        [key.asc_nulls_last(), F.col("size"), F.col("text_crc32").asc_nulls_last()],
        F.lit(1),
        "slot",
    )
