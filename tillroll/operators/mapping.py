"""Shop mapping: external shop codes of one system to internal ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.receipts import quoted
from tillroll.operators.lookup import BROADCAST_BYTES, join_lookup, measured_bytes


def shop_mapping(
    systems: DataFrame,
    content_types: DataFrame,
    codes: DataFrame,
    system_code: str,
    object_type: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """``(code, object_id)`` of one external system.

    Content types are only checked to exist, so a code listed for several types comes out several
    times. ``object_type`` keeps one type; ``unique`` keeps the largest id per code. Systems and types are
    measured and, as they are small, broadcast, so ``codes`` is not shuffled by a handful of values.
    """
    system = systems.filter(F.col("code") == system_code).select(F.col("id").alias("external_system_id"))
    types = content_types.select(F.col("id").alias("object_type_id"))
    if object_type is not None:
        types = types.filter(F.col("object_type_id") == object_type)
    of_system = join_lookup(codes, system, "external_system_id")
    mapping = join_lookup(of_system, types, "object_type_id").select("code", "object_id")
    return mapping.groupBy("code").agg(F.max("object_id").alias("object_id")) if unique else mapping


def map_shops(
    rows: DataFrame, mapping: DataFrame, shop_num: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left-join the mapping on the shop number; every match gives a row.

    Adds ``__shop_id``, and ``__copy`` of ``__copies`` numbering the matches of one input row (both 1
    for a row without match), so that input rows can still be told apart and counted. Codes are compared as text.
    """
    same_code = Window.partitionBy("__code")
    codes = mapping.filter(F.col("code").isNotNull()).select(
        F.col("code").cast("string").alias("__code"), F.col("object_id").alias("__shop_id"))
    lookup = codes.withColumns({
        "__copy": F.row_number().over(same_code.orderBy("__shop_id")),
        "__copies": F.count(F.lit(1)).over(same_code),
    })
    size = 2 * measured_bytes(codes)  # with room for the two numbers
    mapped = join_lookup(rows, lookup, quoted(shop_num) == F.col("__code"), "left", max_bytes, size)
    return mapped.drop("__code").withColumns({
        "__copy": F.coalesce("__copy", F.lit(1)),
        "__copies": F.coalesce("__copies", F.lit(1)),
    })
