"""The given tables in the roles of the receipt job: raw rows from ``events``, mapping tables from
``region``, ``nation`` and ``customer``."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.mapping import shop_mapping
from tillroll.operators.staging import ReceiptConfig
from tillroll.scratch import working_folder
from tillroll.sources.tables import Database

COLUMNS = ["receipt_no", "shop_num", "dttm_raw", "event_type"]
FILE_TEMPLATE = "{data_type}_{year}{month:02d}{day:02d}.csv"
FIX_DAY = "2024-01-15"
NO_DATABASE = Database("jdbc:none:")  # of which a connection or a read fails


def config(**changes) -> ReceiptConfig:
    values = dict(
        columns=COLUMNS,
        system_code="ASIA",
        data_type="delivery",
        shop_num_column_name="shop_num",
        dt_or_dttm_column_name="dttm_raw",
        dt_or_dttm_format="%d.%m.%Y %H:%M:%S",
        filename_fmt=FILE_TEMPLATE,
        dt_from="2024-01-01",
        dt_to="2024-01-30",
        receipt_code_columns=["receipt_no", "event_type"],
    )
    return ReceiptConfig(**{**values, **changes})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw rows with their file date and name; every tenth time is unreadable and every
    seventeenth missing."""
    event = F.col("event_id")
    digits = lambda start, length: F.substring("shown", start, length)
    written = F.concat(
        digits(9, 2), F.lit("."), digits(6, 2), F.lit("."), digits(1, 4), F.lit(" "), digits(12, 8))
    events = table(spark, sf_dir, "events").withColumn("shown", F.col("ts").cast("string"))
    return events.select(
        event.cast("string").alias("receipt_no"),
        F.col("user_id").cast("string").alias("shop_num"),
        F.when(event % 10 == 0, F.concat(F.lit("bad-"), event.cast("string")))
        .when(event % 17 == 0, None)
        .otherwise(written)
        .alias("dttm_raw"),
        "event_type",
        F.to_date("ts").alias("__dt"),
        F.concat(F.lit("delivery_"), digits(1, 4), digits(6, 2), digits(9, 2), F.lit(".csv")).alias("__file_name"),
    )


def mapping_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    systems = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("code"))
    types = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"))
    codes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code"),
        (F.col("c_custkey") + 1000).alias("object_id"),
        (F.col("c_custkey") % 5).alias("external_system_id"),
        F.col("c_nationkey").alias("object_type_id"))
    return systems, types, codes


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_mapping(*mapping_tables(spark, sf_dir), "ASIA")


def raw_files(spark: SparkSession, sf_dir: str, per_shop: bool = False, sep: str = ";", adjacent: bool = False) -> str:
    """The raw rows as CSV: a folder of part files per day, or per day and shop; returns the base.

    With ``adjacent`` a folder is named by the shop's number and, right after it, the day of the month.

    The rows are written as they lie, so a large day is spread over many part files. Event types stand
    for the shops of per-shop files.
    """
    base = working_folder(spark) + "/raw"
    rows = raw_rows(spark, sf_dir).withColumn("day", F.date_format("__dt", "yyyyMMdd"))
    folders = ["day"]
    if per_shop:
        rows, folders = rows.withColumn("shop", F.col("event_type")), ["day", "shop"]
    if adjacent:
        name = F.concat(adjacent_shop(F.col("event_type")), F.dayofmonth("__dt").cast("string"))
        rows, folders = rows.withColumn("name", name), ["name"]
    (
        rows.drop("__dt", "__file_name")
        .withColumn("surplus", F.lit("x"))
        .write.partitionBy(*folders)
        .csv(base, sep=sep)
    )
    return base


def adjacent_shop(event_type):
    """Shops 1 and 11 and so on, so that names of a shop and a day overlap."""
    return F.when(event_type == "error", "x").when(event_type == "click", "1").when(event_type == "view", "11").otherwise("2")


def database(spark: SparkSession) -> Database:
    """The database of ``spark.tillroll.jdbc.url``.

    Without that setting a local session uses an in-memory Derby, which only the session's own process
    sees; a cluster has to name a database, also one of executors on this machine (``local-cluster``).
    """
    url = spark.conf.get("spark.tillroll.jdbc.url", None)
    if url:
        return Database(url)
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.tillroll.jdbc.url to a database that all executors can reach")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    return Database("jdbc:derby:memory:tillroll;create=true")


def new_table(spark: SparkSession, prefix: str) -> str:
    """A new name; the table is dropped when the application ends, as queries read it until then."""
    name, target = f"{prefix}_{uuid.uuid4().hex}", database(spark)

    def drop() -> None:
        try:
            connection = spark._jvm.java.sql.DriverManager.getConnection(target.url)
            connection.createStatement().executeUpdate(f"DROP TABLE {name}")
            connection.close()
        except Exception:  # the session, and with it an in-memory database, may be gone already
            return

    atexit.register(drop)
    return name
