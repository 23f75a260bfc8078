import random
from collections import defaultdict

import pytest

from tillroll.operators.row_index import _placed, rank_by_counting, with_row_index
from tillroll.scratch import materialise


@pytest.mark.parametrize("rows_per_task", [0, 10_000])
@pytest.mark.parametrize("hot", [False, True])
def test_numbers_equal_those_of_a_sort(spark, rows_per_task, hot):
    chance = random.Random(3)
    rows = [(f"f{chance.randint(0, 6)}", str(chance.randint(0, 400)), n) for n in range(3000)]
    if hot:  # a third of all rows in one file, another third copies of a single row
        rows += [("f0", str(chance.randint(0, 9999)), n) for n in range(3000)] + [("f1", "17", -1)] * 3000
    rows += [("f9", None, 1), (None, "5", 2), (None, "4", 3)]
    df = spark.createDataFrame(rows, "file string, value string, payload int").repartition(5)
    found = with_row_index(df, ["file"], ["value", "payload"], rows_per_task=rows_per_task).collect()
    expected = defaultdict(list)
    for file, value, payload in rows:
        expected[file].append((value is not None, value or "", payload))
    numbered = defaultdict(list)
    for row in found:
        numbered[row["file"]].append((row["__index"], (row["value"] is not None, row["value"] or "", row["payload"])))
    assert numbered.keys() == expected.keys()
    for file, values in expected.items():
        assert sorted(numbered[file]) == list(enumerate(sorted(values), 1))


def test_no_rows(spark):
    df = spark.createDataFrame([], "file string, value string")
    assert with_row_index(df, ["file"], ["value"]).collect() == []
    assert with_row_index(df, ["file"], ["value"], largest=1, rows_per_task=0).collect() == []


def test_copies_of_one_row_are_spread_over_tasks(spark):
    df = spark.createDataFrame([("f", "same")] * 20_000, "file string, value string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = _placed(materialise(df), ["file", "value"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["count"] for row in placed.groupBy("__part").count().collect()]
    assert sum(sizes) == 20_000
    assert len(sizes) == 4 and max(sizes) < 10_000


def ranked_rows():
    chance = random.Random(8)
    values = [None, "", "a", "a\0", "a\0\1", "ab", "b" * 60, "ß", "\x01", "\x02", *map(str, range(40))]
    rows = []
    for n in range(4_000):
        value, tie = chance.choice(values), chance.choice([None, b"", b"\0", b"\0\1", b"x"])
        # what is chosen depends on the place alone
        rows.append((chance.choice(["f0", "f1", "f1\0", None, "g"]), value, tie, hash((value, tie)) % 7 == 0))
    return rows + [("hot", "x", b"t", True)] * 5_000 + [("hot", str(n), b"t", False) for n in range(3_000)]


@pytest.mark.parametrize("per_task", [1_000_000, 700])
def test_ranks_by_counting_equal_those_of_a_sort(spark, per_task):
    df = materialise(spark.createDataFrame(ranked_rows(), "file string, value string, tie binary, bad boolean").repartition(6))
    expected = with_row_index(df, ["file"], ["value", "tie"]).filter("bad")
    found = rank_by_counting(df, "bad", ["file"], ["value", "tie"], rows_per_task=per_task)
    order = lambda rows: sorted(map(str, map(tuple, rows.select(*expected.columns).collect())))
    assert order(found) == order(expected)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("MapInArrow")
    assert "Sort" not in plan[scan:] and "Exchange" not in plan[scan:]


def test_ranks_of_none_and_of_too_many(spark):
    df = spark.createDataFrame([("f", "1", b"", False), ("f", "2", b"", False)], "file string, value string, tie binary, bad boolean")
    assert rank_by_counting(df, "bad", ["file"], ["value", "tie"]).collect() == []
    assert rank_by_counting(df.limit(0), "bad", ["file"], ["value", "tie"]).collect() == []
    assert rank_by_counting(df.withColumn("bad", df["value"] == "2"), "bad", ["file"], ["value", "tie"], max_bytes=5) is None
    with pytest.raises(ValueError, match="cannot be ranked"):
        rank_by_counting(df, "bad", ["file"], ["bad"])
