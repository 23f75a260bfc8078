"""Row numbers within each file, also for files too large to sort in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.receipts import quoted
from tillroll.operators.lookup import join_lookup
from tillroll.scratch import materialise

ROWS_PER_TASK = 1_000_000
PLACES_BYTES = 16 << 20  # of the array that every task gets
_POSITION_BITS = 33  # monotonically_increasing_id() keeps the row's position in its low bits


def with_row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    largest: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    written: bool = False,
) -> DataFrame:
    """Add ``__index``, the 1-based position of the row by ``order`` among the rows of its ``keys``.

    Groups of up to ``rows_per_task`` rows are numbered by a window. If the largest group (counted
    here unless given) has more, all rows are sorted across tasks instead and no task holds a group.
    They are written for that, so that they come out the same when read again, unless they are ``written``
    already. Rows of equal keys and order are exchangeable; all others get the same numbers either way.
    """
    if largest is None:
        largest = df.groupBy(*keys).count().agg(F.max("count").alias("rows")).first()["rows"] or 0
    if largest <= rows_per_task:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("__index", number.cast("long"))
    return _sorted_across_tasks(df if written else materialise(df), list(keys), list(order))


def rank_by_counting(
    df: DataFrame, chosen: str, keys: Sequence[str], order: Sequence[str], max_bytes: int = PLACES_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame | None:
    """The rows of ``df`` where ``chosen`` holds, with the ``__index`` that ``with_row_index`` gives them among all rows.

    No other row is sorted or moved. The distinct places of the chosen rows become a sorted array that every task
    gets; each row finds by halving, a batch at a time, which of them it stands before, and only the numbers of
    rows between two places travel. The array is measured, and beyond ``max_bytes`` the result is None.

    ``keys`` and ``order`` are texts, bytes or dates, and rows equal in them are equal in every column. Such copies are
    counted, not moved, and come out again by at most ``rows_per_task`` a task. ``df`` is read twice, so it
    should be a written table.
    """
    group, rest = _place_text(df, keys), _place_text(df, order)
    picked = materialise(
        df.filter(F.col(chosen)).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__own"))
        .withColumns({"__group": group, "__place": F.concat(group, rest)}))
    size = picked.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("__place")).alias("longest"),
        F.max(F.octet_length("__group")).alias("longest_group"), F.max("__own").alias("own")).first()
    # Each place takes as many bytes as the longest one.
    if size["n"] and size["n"] * (size["longest"] + size["longest_group"]) > max_bytes:
        return None
    listed = picked.select("__group", "__place").toArrow()
    places = np.array([place.encode() for place in listed.column("__place").to_pylist()], f"S{size['longest'] or 1}")
    groups = np.array([place.encode() for place in listed.column("__group").to_pylist()], f"S{size['longest_group'] or 1}")
    by_place = np.argsort(places, kind="stable")
    sent = df.sparkSession.sparkContext.broadcast((places[by_place], groups[by_place]))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, groups = sent.value
        for batch in batches:
            if not len(places):
                continue
            own, row = (np.array([text.encode() for text in batch.column(i).to_pylist()], like.dtype)
                        for i, like in enumerate((groups, places)))
            # No place is the beginning of another, so those cut to the longest one compare as the whole ones.
            at = np.searchsorted(places, row)
            before = np.minimum(at, len(places) - 1)
            # Rows after the last place of their group count for none.
            found, number = np.unique(at[(at < len(places)) & (groups[before] == own)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(places[found].astype(object), pa.binary()), pa.array(number, pa.int64())], ["place", "rows"])

    # Per place, the rows that are not after it but after the place before; then all that are not after it.
    between = df.select(group.alias("group"), F.concat(group, rest).alias("place")).mapInArrow(counted, "place binary, rows long")
    between = between.groupBy("place").agg(F.sum("rows").alias("__rows"))
    numbered = picked.join(between.hint("merge"), _unpadded(F.col("__place")) == _unpadded(F.col("place")))
    upto = F.sum("__rows").over(Window.partitionBy("__group").orderBy("__place"))
    last = F.col("__last")
    first = numbered.withColumn("__last", upto).withColumn("__first", last - F.col("__own") + 1)
    if (size["own"] or 0) > rows_per_task:
        start = F.explode(F.sequence("__first", last, F.lit(rows_per_task).cast("long")))
        first = first.withColumn("__start", start).repartition("__place", "__start")
        numbers = F.sequence("__start", F.least(F.col("__start") + rows_per_task - 1, last))
    else:
        numbers = F.sequence("__first", last)
    return first.select(*map(quoted, df.columns), F.explode(numbers).alias("__index"))


def _unpadded(place: Column) -> Column:
    """A place in the array has lost the zeros at its end."""
    return F.rtrim(place.cast("string"), F.lit("\0"))


def _place_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """A text that sorts as the columns do, nulls first; a value's end sorts before whatever may follow in it."""
    parts = []
    for name in columns:
        kind, value = df.schema[name].dataType.typeName(), F.col(name)
        if kind not in ("string", "binary", "date"):
            raise ValueError(f"rows cannot be ranked by {name}, a {kind}")
        text = F.hex(value) if kind == "binary" else value.cast("string")
        ended = F.concat(F.lit("\x02"), F.replace(text, F.lit("\0"), F.lit("\0\x01")), F.lit("\0\0"))
        parts.append(F.when(value.isNull(), F.lit("\x01")).otherwise(ended))
    return F.concat(*parts)


def _sorted_across_tasks(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    placed = _placed(df, [*keys, *order])
    # One row per task and group that meet: at most the number of tasks plus the number of groups.
    pieces = materialise(
        placed.groupBy(*keys, "__part").agg(
            F.min("__position").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    )
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(name).alias(f"{name}__piece") for name in [*keys, "__part"]], "__first",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    same_piece = [F.col(name).eqNullSafe(F.col(f"{name}__piece")) for name in [*keys, "__part"]]
    return join_lookup(placed, offsets, same_piece, "inner").select(
        *map(quoted, df.columns),
        (F.col("__before") + F.col("__position") - F.col("__first") + 1).alias("__index"))


def _placed(df: DataFrame, sort: list[str]) -> DataFrame:
    """``df`` sorted across tasks, with the task ``__part`` and the ``__position`` within it.

    ``df`` reads a table: the range bounds are sampled from it in a pass of its own, and the salt must
    come out the same if a task is run again. The salt only parts equal rows, which would otherwise
    all meet in one task. The result is written, as it is read for the counts of the tasks and again
    for the rows, and both must see the same bounds.
    """
    rows = df.withColumn("__salt", F.monotonically_increasing_id())
    ordinal = F.col("__ordinal")
    return materialise(
        rows.repartitionByRange(*sort, "__salt")
        .sortWithinPartitions(*sort, "__salt")
        .drop("__salt")
        .withColumn("__ordinal", F.monotonically_increasing_id())
        .withColumns({
            "__part": F.shiftright(ordinal, _POSITION_BITS).cast("int"),
            "__position": ordinal.bitwiseAND((1 << _POSITION_BITS) - 1),
        })
        .drop("__ordinal")
    )
