"""Join against a lookup table, broadcast only when its measured size allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import materialise

BROADCAST_BYTES = 64 << 20
ROUND_BYTES = 8 << 20  # of each of the many tables of a job that goes in rounds


def measured_bytes(df: DataFrame) -> int:
    """About the bytes that ``df`` takes in a hash table: text lengths and a fixed part per field."""
    row = sum(
        (F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 16 for name in df.columns),
        F.lit(16))
    return df.agg(F.sum(row.cast("long")).alias("bytes")).first()["bytes"] or 0


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup``; a condition names its columns by text, not by frame.

    A small lookup (measured here unless ``size`` is given) is broadcast and ``rows`` stay where they are. A larger one is joined by a shuffle;
    adaptive execution then splits the partitions of keys that hold much of ``rows``. It does so only
    where the join reads both shuffles directly, hence the lookup is written first: otherwise a grouping
    or window within it could take the place of its shuffle.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} cannot split a hot key of the left side")
    if (measured_bytes(lookup) if size is None else size) <= max_bytes:
        return rows.join(F.broadcast(lookup), on, how)
    return rows.join(materialise(lookup).hint("merge"), on, how)


def join_written(
    rows: DataFrame, written: DataFrame, on, how: str = "inner", max_bytes: int = ROUND_BYTES, size: int | None = None
) -> DataFrame:
    """``join_lookup`` with a table that is written already, and so is not written again where it is large."""
    small = (measured_bytes(written) if size is None else size) <= max_bytes
    return rows.join(F.broadcast(written) if small else written.hint("merge"), on, how)
