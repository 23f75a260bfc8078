"""Row expressions of the receipt job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.strptime import with_strptime

# Fixed values of the date rule: the tolerance in days and the latest hour kept.
MAX_DAYS_OFF = 7
LAST_HOUR = 20


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def receipt_code(
    columns: Sequence[str], code_columns: Sequence[str] | None = None, code_hash: str = "hash"
) -> Column:
    """The chosen columns joined without separator, or a hash of all raw columns.

    ``hash`` has 32 bits, so distinct rows share a code once there are many of them; ``xxhash64``
    gives a 64-bit code instead.
    """
    if code_columns:
        return F.concat_ws("", *[quoted(name) for name in code_columns])
    if code_hash not in ("hash", "xxhash64"):
        raise ValueError(f"unknown code hash {code_hash!r}")
    return getattr(F, code_hash)(*[quoted(name) for name in columns])


def code_collisions(df: DataFrame, columns: Sequence[str], code: str) -> DataFrame:
    """``(code, rows)`` of the values of the column ``code`` that rows of different ``columns`` share.

    Rows differ if their 128-bit hashes do, which tell nulls from empty texts and where a value ends. Only the least and
    the greatest hash of a code travel, so a code of very many rows is no burden.
    """
    values = [F.when(quoted(name).isNull(), "-").otherwise(F.concat(
        F.octet_length(quoted(name).cast("string")).cast("string"), F.lit(":"), quoted(name).cast("string"))) for name in columns]
    row = F.md5(F.concat(*values, F.lit("")))
    return df.groupBy(quoted(code).alias("code")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(row).alias("__least"), F.max(row).alias("__greatest")
    ).filter("__least <> __greatest").select("code", "rows")


def with_dttm(df: DataFrame, source: str, fmt: str, day: str, fix_date: bool = False) -> DataFrame:
    """Add ``__dttm``, ``__dated``, ``__error_class`` and ``__error_value``, parsed from ``source``.

    With ``fix_date`` the date is replaced by ``day`` and the hour is capped, if the parsed date is
    near enough to ``day``; otherwise the row gets a range error. ``__dated`` says whether ``__dttm`` is
    set and costs less to filter on.
    """
    parsed = with_strptime(df, source, fmt)
    wall, offset = F.col("__wall"), F.col("__utc_offset")
    if not fix_date:
        shifted = F.concat(wall.cast("string"), offset).cast("timestamp")
        dttm = F.when(offset.isNull(), wall.cast("timestamp")).otherwise(shifted)
        return parsed.withColumns({"__dttm": dttm, "__dated": wall.isNotNull()}).drop("__wall", "__utc_offset")

    text = wall.cast("string")
    fraction = F.split_part(text, F.lit("."), F.lit(2))
    shown = F.concat(
        F.split_part(text, F.lit("."), F.lit(1)),
        F.when(fraction != "", F.concat(F.lit("."), F.rpad(fraction, 6, "0"))).otherwise(""),
        F.coalesce(offset, F.lit("")))
    range_error = F.concat(
        F.lit("Range between "), F.col(day).cast("string"), F.lit(" and "), shown,
        F.lit(" is greater than 1 week"))
    days_off = F.abs(F.datediff(F.col(day), F.to_date(wall)))
    dated = F.coalesce(days_off <= MAX_DAYS_OFF, F.lit(False))
    moved = F.try_make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day),
        F.least(F.hour(wall), F.lit(LAST_HOUR)), F.minute(wall), F.second(wall))
    far = wall.isNotNull() & ~F.col("__dated")
    return (
        parsed.withColumn("__dated", dated)
        .withColumns({
            "__dttm": F.when(F.col("__dated"), moved).cast("timestamp"),
            "__error_class": F.when(far, "TypeError").otherwise(F.col("__error_class")),
            "__error_value": F.when(far, range_error).otherwise(F.col("__error_value")),
        })
        .drop("__wall", "__utc_offset")
    )


def shop_error(shop_num: Column) -> Column:
    return F.concat(
        F.lit("can't map shop_id for shop_num='"), F.coalesce(shop_num, F.lit("None")), F.lit("'"))


def date_error(error_class: Column, error_value: Column, file_name: Column, index: Column) -> Column:
    return F.concat(
        error_class, F.lit(": "), error_value, F.lit(": "), file_name,
        F.lit(": row: "), index.cast("string"))


def info_json(columns: Sequence[str]) -> Column:
    """The raw row and its receipt code as JSON; null fields are left out."""
    names = [name for name in columns if name != "receipt_code"] + ["receipt_code"]
    return F.to_json(F.struct(*[quoted(name) for name in names]))
