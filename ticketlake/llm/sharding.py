"""Sharding by a hierarchical weighted hash tree.

A tree has regions, a region racks, a rack shards; every shard has a weight
and an inner node weighs as much as what is below it. A document descends the
tree: at each level every child draws an exponential clock ``-ln(u) / weight``
from a hash of (document key, child's path) and the smallest clock wins. A
child is therefore taken in proportion to its weight, and when weights change
a document can only move into a child whose weight grew or out of one whose
weight shrank: the other subtrees exchange nothing.

``grow`` adds a shard as a region of its own. The only new clock is then the
new region's, so a document either keeps its shard or moves into the new one
(law ``key``: the key and the tree decide, nothing else).

Slots: the place of a row in its shard. No shard is sorted in one task: rows
are spread over hash buckets, equal rows are counted before the shuffle, and a
slot is the rows of the earlier buckets plus the place inside the bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard are numbered bucket by bucket.
SLOT_BUCKETS = 4096


@dataclass(frozen=True)
class Shard:
    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class HashTree:
    """``regions``: region -> rack -> shards, each a tuple of tuples."""

    regions: tuple[tuple[tuple[Shard, ...], ...], ...]
    seed: int = 0

    @staticmethod
    def uniform(regions: int = 2, racks: int = 3, shards: int = 4, seed: int = 0) -> HashTree:
        per = racks * shards
        return HashTree(tuple(
            tuple(tuple(Shard(r * per + k * shards + s) for s in range(shards)) for k in range(racks))
            for r in range(regions)), seed)

    @property
    def count(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grow(self, weight: float = 1.0) -> HashTree:
        """One more shard, in a region and rack of its own."""
        return HashTree((*self.regions, ((Shard(self.count, weight),),)), self.seed)

    def reweigh(self, number: int, weight: float) -> HashTree:
        """The same tree with another weight for one shard."""
        return HashTree(tuple(tuple(tuple(Shard(s.number, weight) if s.number == number else s for s in rack)
                                    for rack in region) for region in self.regions), self.seed)


def _clock(key: Column, path: str, weight: float, seed: int) -> Column:
    h = F.xxhash64(F.concat_ws("|", key, F.lit(f"{seed}/{path}")))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(weight)


def _draw(key: Column, children: list[tuple[str, float]], seed: int) -> Column:
    """Index of the child with the smallest clock (ties: the first)."""
    alive = [(i, p, w) for i, (p, w) in enumerate(children) if w > 0]
    if len(alive) == 1:
        return F.lit(alive[0][0])
    return F.array_min(F.array(*[F.struct(_clock(key, p, w, seed).alias("t"), F.lit(i).alias("i"))
                                 for i, p, w in alive]))["i"]


def shard_of(key: Column, tree: HashTree) -> Column:
    """Shard number for a key (text). Built-in functions only; each level is
    drawn only for the branch taken."""
    weigh_rack = lambda rack: math.fsum(s.weight for s in rack)
    weigh = lambda region: math.fsum(weigh_rack(k) for k in region)

    def pick(at: Column, options: list[Column]) -> Column:
        out = options[-1]
        for i in range(len(options) - 2, -1, -1):
            out = F.when(at == i, options[i]).otherwise(out)
        return out

    def in_rack(path: str, rack) -> Column:
        at = _draw(key, [(f"{path}/{s.number}", s.weight) for s in rack], tree.seed)
        return F.array(*[F.lit(s.number) for s in rack])[at]

    def in_region(path: str, region) -> Column:
        at = _draw(key, [(f"{path}/{k}", weigh_rack(rack)) for k, rack in enumerate(region)], tree.seed)
        return pick(at, [in_rack(f"{path}/{k}", rack) for k, rack in enumerate(region)])

    top = _draw(key, [(str(r), weigh(region)) for r, region in enumerate(tree.regions)], tree.seed)
    return pick(top, [in_region(str(r), region) for r, region in enumerate(tree.regions)])


def numbered(rows: DataFrame, shard: str, by: list[str], buckets: int = SLOT_BUCKETS) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... without gaps inside each shard. ``by``
    names the columns that tell rows apart; rows equal in all of them are
    counted before the shuffle and take neighbouring slots."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")
    told = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__b", bucket)
    sizes = told.groupBy(shard, "__b").agg(F.sum("__n").alias("__size"))
    before = Window.partitionBy(shard).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each shard and bucket: bounded by shards x buckets
    starts = sizes.select(shard, "__b", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard, "__b").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    placed = (told.withColumn("__in", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
              .join(starts, [shard, "__b"])            # the rows lie by these columns already
              .withColumn("__first", F.col("__start") + F.col("__in")))
    copies = F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__n") - 1))
    return placed.select(*rows.columns, copies.alias("slot"))


def shard_documents(docs: DataFrame, tree: HashTree | None = None) -> DataFrame:
    """Every row of ``docs`` placed: ``doc_id, size, text_crc32, law, shard,
    slot, grown_shard``.

    NULL text counts as empty (size 8, crc 0). A NULL doc_id is a key of its
    own (the empty key). Repeated rows share a shard and take separate slots.
    Extra columns of ``docs`` are not read. An empty table gives no rows.
    """
    tree = tree or HashTree.uniform()
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, tree.grow()).cast("int").alias("grown_shard"))
    out = numbered(rows, "shard", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), "grown_shard")
