"""Rows that do not fit are kept apart."""

from datetime import datetime

import pytest
from pyspark.sql import types as T

from tillroll.functions.receipts import code_collisions, receipt_code
from tillroll.operators.schema import RECEIPT, conform_or_reject
from tillroll.operators.typed import typed_or_rejected
from tillroll.sources.records import read_records_or_rejects


def test_each_bad_value_is_named(spark):
    df = spark.createDataFrame(
        [(1, "5", "2024-01-01 10:00:00", "a"), (2, "x", "never", "b"), (3, None, None, None), (4, "2147483648", "2024-02-30", "d"),
         (5, " 7 ", "2024-01-01", "e"), (6, "1.5", "2024-01-01", "f"), (7, "-0099999999999", "2024-01-01", "g"), (8, "", "", "h")],
        "`a.b` int, n string, t string, rest string")
    good, bad = typed_or_rejected(df, {"n": "int", "t": "timestamp"}, key=["a.b"])
    assert good.columns == df.columns and good.schema["n"].dataType == T.IntegerType()
    assert sorted(map(tuple, good.collect())) == [
        (1, 5, datetime(2024, 1, 1, 10), "a"), (3, None, None, None), (5, 7, datetime(2024, 1, 1), "e")]
    number, large, time = "not a value of type int", "out of range for type int", "not a value of type timestamp"
    assert sorted(map(tuple, bad.collect())) == [
        (2, "n", "x", number), (2, "t", "never", time), (4, "n", "2147483648", large), (4, "t", "2024-02-30", time),
        (6, "n", "1.5", number), (7, "n", "-0099999999999", large), (8, "n", "", number), (8, "t", "", time)]


def test_nothing_to_change_and_no_rows(spark):
    df = spark.createDataFrame([(1,)], "n int")
    good, bad = typed_or_rejected(df, {"n": T.IntegerType()})
    assert good.collect() == df.collect() and bad.columns == ["column", "value", "reason"] and bad.count() == 0
    good, bad = typed_or_rejected(df.limit(0).withColumn("n", df["n"].cast("string")), {"n": "int"})
    assert good.count() == bad.count() == 0


def test_lines_that_are_no_records(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text('{"dttm": "2024-01-01", "shop_id": "1"}\n{broken\n{"dttm": "x", "shop_id": "2"}\n{"shop_id": "3"}\n')
    good, bad = read_records_or_rejects(spark, str(path), "dttm string, shop_id string")
    assert sorted((row["shop_id"], row["dttm"]) for row in good.collect()) == [(1, datetime(2024, 1, 1)), (3, None)]
    assert good.columns == ["dttm", "shop_id"]
    assert sorted(map(tuple, bad.collect())) == [
        ("__line", "{broken", "not a record"), ("dttm", "x", "not a value of type timestamp")]
    with pytest.raises(ValueError, match="unknown source"):
        read_records_or_rejects(spark, str(path), "dttm string", "pickle")


def test_receipts_that_do_not_fit_the_schema(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("no", "b", "0"), ("3", "c", "0")], "shop_id string, code string, version string")
    good, bad = conform_or_reject(df, key=["code"])
    assert good.schema.names == RECEIPT.names and [row["code"] for row in good.collect()] == ["c"]
    assert sorted((row["code"], row["column"]) for row in bad.collect()) == [("a", "version"), ("b", "shop_id")]


def test_codes_of_different_rows(spark):
    df = spark.createDataFrame(
        [("1", "23"), ("12", "3"), ("5", None), ("5", ""), ("7", "7"), ("7", "7"), (None, None)], "a string, b string")
    coded = df.withColumn("code", receipt_code(["a", "b"], ["a", "b"]))
    assert sorted(map(tuple, code_collisions(coded, ["a", "b"], "code").collect())) == [("123", 2), ("5", 2)]
    assert code_collisions(coded.limit(0), ["a", "b"], "code").count() == 0
