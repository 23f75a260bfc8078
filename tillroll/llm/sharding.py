"""Operator 1: shards of near equal bytes by best-fit-decreasing bin packing."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.ranks import hashed_key, hex_digits, place, running_sum
from tillroll.llm.tables import table
from tillroll.scratch import materialise

SHARDS = 16
PRECISION_BITS = 12  # sizes of a class differ by less than 1 part in 2 ** 11
_WHOLE_CLASS = 1 << 44


class RemainingCapacities:
    """Bins by remaining capacity: a balanced tree of two levels, whose full leaves split in half."""

    def __init__(self, leaf: int = 512):
        self._leaf, self._leaves, self._tops = leaf, [], []

    def add(self, remaining: int, bin_: int) -> None:
        entry = (remaining, bin_)
        if not self._leaves:
            self._leaves, self._tops = [[entry]], [entry]
            return
        at = min(bisect_left(self._tops, entry), len(self._tops) - 1)
        leaf = self._leaves[at]
        insort(leaf, entry)
        if len(leaf) > self._leaf:
            half = len(leaf) // 2
            self._leaves[at:at + 1] = [leaf[:half], leaf[half:]]
            self._tops[at:at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self._tops[at] = leaf[-1]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity of at least ``size``."""
        at = bisect_left(self._tops, (size, -1))
        if at == len(self._tops):
            return None
        leaf = self._leaves[at]
        entry = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self._tops[at] = leaf[-1]
        else:
            del self._leaves[at], self._tops[at]
        return entry


def best_fit_decreasing(
    classes: list[tuple[int, int]], capacity: int, bins: int | None = None
) -> list[tuple[int, int, int]] | None:
    """Pack ``classes`` (size, count), largest first, each item into the tightest bin that holds it.

    Gives runs (size, first rank, bin): a bin that takes an item is the tightest one for the next of equal
    size, so it takes as many as it holds. Items over ``capacity`` get bins of their own. None if more than
    ``bins`` are needed.
    """
    tree, runs, used = RemainingCapacities(), [], 0
    for size, count in sorted(classes, reverse=True):
        placed = 0
        while placed < count:
            found = tree.take_tightest(size)
            if found is None:
                if used == bins:
                    return None
                found = (max(capacity, size), used)
                used += 1
            remaining, bin_ = found
            taken = min(count - placed, remaining // size)
            runs.append((size, placed, bin_))
            placed += taken
            if remaining > taken * size:
                tree.add(remaining - taken * size, bin_)
    return runs


def even_shards(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Best-fit-decreasing runs at the least capacity that ``shards`` bins need.

    A group above the mean of what is left cannot be divided: it fills a shard of its own, and the others
    share the rest.
    """
    rest, alone, runs = dict(classes), 0, []
    taken: dict[int, int] = {}
    for size in sorted(rest, reverse=True):
        while rest[size] and alone < shards - 1 and size * (shards - alone) > sum(s * n for s, n in rest.items()):
            runs.append((size, taken.get(size, 0), alone))
            taken[size] = taken.get(size, 0) + 1
            rest[size] -= 1
            alone += 1
        if rest[size]:
            break
    left = [(size, count) for size, count in rest.items() if count]
    if not left:
        return runs
    total, bins = sum(size * count for size, count in left), shards - alone
    low = max(-(-total // bins), max(size for size, _ in left))
    high = low
    while (best := best_fit_decreasing(left, high, bins)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(left, middle, bins)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return runs + [(size, first + taken.get(size, 0), alone + bin_) for size, first, bin_ in best]


def size_class(size: Column) -> Column:
    """``size`` rounded up to ``PRECISION_BITS`` binary digits: a bounded number of classes at any scale."""
    spare = F.greatest(F.length(F.bin(size)) - PRECISION_BITS, F.lit(0))
    unit = F.pow(F.lit(2.0), spare).cast("long")
    return F.expr("0L") + F.floor((size + unit - 1) / unit).cast("long") * unit


def shard_groups(groups: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """Add ``shard`` to ``groups`` (key, bytes), a written table with one row per indivisible group.

    With ``capacity`` instead of ``shards``: as few shards of at most that many bytes as best fit decreasing
    needs. The driver sees one row per size class, at most 2,048 for each power of two, and one per shard.
    """
    rows = materialise(groups.withColumn("size_class", size_class(F.col("bytes"))))
    classes = [tuple(row) for row in rows.groupBy("size_class").count().collect()]
    if not classes:
        return rows.drop("size_class").withColumn("shard", F.lit(0))
    runs = even_shards(classes, shards) if capacity is None else best_fit_decreasing(classes, capacity)
    plan = pd.DataFrame(runs, columns=["size", "first", "bin"]).assign(per_bin=_WHOLE_CLASS, offset=0)
    digits = hex_digits(sum(count for _, count in classes))
    ranked = running_sum(rows, ["size_class"], "key", digits, name="__rank")
    return ranked.withColumn("shard", place("size_class", "__rank", plan)["bin"].cast("int")).drop("size_class", "__rank")


def shard_documents(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot) for each row of ``docs`` (doc_id, text).

    Equal texts are one group; so are null texts, of size 1 each. Slots are gapless from 0 in each shard. Rows
    equal in all columns get slots in any order. No rows: no rows. Only hashes and sizes are shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.when(F.col("text").isNull(), F.lit("0" * 32)).otherwise(F.md5("text"))
    rows = materialise(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        key.alias("key")))
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    sharded = materialise(shard_groups(groups, shards, capacity).select("key", "shard"))
    joined = rows.join(sharded.hint("merge"), "key").withColumn("row_key", hashed_key(F.col("doc_id"), F.col("key")))
    placed = materialise(joined.drop("key"))
    digits = hex_digits(placed.count())
    slotted = running_sum(placed, ["shard"], "row_key", digits, name="slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))
