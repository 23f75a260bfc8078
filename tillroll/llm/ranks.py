"""Positions and running sums within groups of any size.

No task ever holds a group: its rows are dealt into bins by the first hex digits of their key, numbered
within each bin, and shifted by the sums of the bins before. As the bins follow the order of the keys, the
result does not depend on how many there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BIN = 200_000


def hex_digits(rows: int) -> int:
    """How many hex digits part ``rows`` rows into bins of at most about ``ROWS_PER_BIN``, 256 bins at least."""
    return max(2, math.ceil(math.log(max(rows, 1) / ROWS_PER_BIN, 16)) if rows > ROWS_PER_BIN else 2)


def hashed_key(*columns: Column) -> Column:
    """A hex key spread evenly over rows, the same at each run. Nulls differ from empty texts."""
    return F.md5(F.concat_ws("|", *[F.coalesce(column.cast("string"), F.lit("\u0000")) for column in columns]))


def running_sum(
    df: DataFrame, groups: Sequence[str], key: str, digits: int, value: Column | None = None,
    name: str = "before", tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: the sum of ``value`` (default 1: the position, from 0) over the earlier rows of the group.

    ``key`` is a hex text such as ``hashed_key``; equal keys are ordered by ``tie``. ``groups`` and ``key``
    hold no nulls. ``df`` is read twice, so it should be a written table.
    """
    value = F.lit(1).cast("long") if value is None else value
    rows = df.withColumns({"__bin": F.substring(key, 1, digits), "__value": value})
    earlier = Window.partitionBy(*groups, "__bin").orderBy(key, *tie).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("__inner", F.coalesce(F.sum("__value").over(earlier), F.lit(0)))
    # One row per group and bin: the window over them is bounded by the number of bins.
    bins = rows.groupBy(*groups, "__bin").agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(*groups).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select(
        *groups, "__bin", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    return inner.join(offsets, [*groups, "__bin"]).withColumn(
        name, F.col("__offset") + F.col("__inner")).drop("__bin", "__value", "__inner", "__offset")


def place(size: str, rank: str, runs: pd.DataFrame) -> Column:
    """The ``bin`` and ``offset`` of the item of rank ``rank`` among the items of size class ``size``.

    ``runs`` has rows (size, first, bin, per_bin, offset): from rank ``first`` on, ``per_bin`` items at a
    time go to one bin, beginning with ``bin``, one after the other from ``offset`` on. Its length is bounded
    by the number of size classes and bins, not by that of the items.
    """
    runs = runs.sort_values(["size", "first"], kind="stable")
    sizes = np.unique(runs["size"].to_numpy(np.int64))
    starts = (np.searchsorted(sizes, runs["size"]) << 44) + runs["first"].to_numpy(np.int64)
    bins, per_bin, offsets, firsts = (
        runs[name].to_numpy(np.int64) for name in ("bin", "per_bin", "offset", "first"))

    @F.pandas_udf("bin long, offset long")
    def placed(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted = (np.searchsorted(sizes, size.to_numpy(np.int64)) << 44) + rank.to_numpy(np.int64)
        run = np.searchsorted(starts, wanted, side="right") - 1
        past = rank.to_numpy(np.int64) - firsts[run]
        return pd.DataFrame({
            "bin": bins[run] + past // per_bin[run],
            "offset": offsets[run] + past % per_bin[run] * size.to_numpy(np.int64)})

    return placed(F.col(size), F.col(rank))
