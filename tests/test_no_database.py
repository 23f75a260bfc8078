"""What has no rows to import needs no database; the rest needs one that executors reach."""

from datetime import datetime
from types import SimpleNamespace

import pytest

from checks import inputs, queries


def write_tables(spark, folder):
    """The given tables of 60 events on 30 days, three customers and five regions."""
    spark.createDataFrame(
        [(i, i % 3, "click", datetime(2024, 1, 1 + i % 30, 10, i)) for i in range(60)],
        "event_id long, user_id long, event_type string, ts timestamp").write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(i, f"R{i}") for i in range(5)], "r_regionkey long, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.createDataFrame([(i,) for i in range(25)], "n_nationkey long").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(i, i) for i in range(3)], "c_custkey long, c_nationkey long").write.parquet(f"{folder}/customer.parquet")


def test_a_history_without_receipts_is_imported_without_a_database(spark, tmp_path, monkeypatch):
    def none(spark):
        raise ValueError("set spark.tillroll.jdbc.url to a database that all executors can reach")

    monkeypatch.setattr(inputs, "database", none)  # as on a cluster without that setting
    write_tables(spark, tmp_path)
    assert queries.history_no_valid(spark, str(tmp_path)).count() == 60 + 6 + 3  # no shop is known, six times cannot be read and three are missing


def session(master, url=None):
    """As much of a session as tells where its database is."""
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: url or default), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["local-cluster[3,2,3000]", "spark://host:7077", "yarn"])
def test_executors_of_their_own_process_need_a_named_database(master):
    with pytest.raises(ValueError, match="spark.tillroll.jdbc.url"):
        inputs.database(session(master))
    assert inputs.database(session(master, "jdbc:any")).url == "jdbc:any"


@pytest.mark.parametrize("query", ["jdbc_append_roundtrip", "jdbc_append_skip", "jdbc_scan_partitioned"])
def test_without_a_reachable_database_a_query_ends_before_it_writes_to_one(spark, tmp_path, monkeypatch, query):
    real = inputs.database
    monkeypatch.setattr(inputs, "database", lambda spark: real(session("local-cluster[3,2,3000]")))
    monkeypatch.setattr(queries, "append_table", lambda *args, **options: pytest.fail("a row was to be written"))
    write_tables(spark, tmp_path)
    with pytest.raises(ValueError, match="spark.tillroll.jdbc.url"):
        queries.QUERIES[query](spark, str(tmp_path))
