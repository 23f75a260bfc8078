"""The history job: many days of raw files to receipts, errors and shop ids."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.staging import (
    ReceiptConfig, daily_errors, daily_shop_ids, day_counts, day_kinds, stage, valid)
from tillroll.scratch import is_without_files, job_folder, materialise
from tillroll.sinks.datasets import publish_daily_datasets, publish_days
from tillroll.sinks.publish import Publication, publication
from tillroll.sources.files import dates_in_range, read_raw

logger = logging.getLogger(__name__)

OUTPUTS = ("transformed", "errors", "shop_ids")


@dataclass(frozen=True)
class DayCounts:
    dt: date
    raw_rows: int = 0
    error_rows: int = 0
    valid_rows: int = 0
    mapped_rows: int = 0


def read_job_files(
    spark: SparkSession, base: str, mapping: DataFrame, cfg: ReceiptConfig, missing: str = "error"
) -> DataFrame:
    """The raw rows of the job's date range; per-shop files are those of the mapped codes."""
    codes = mapping.select("code") if cfg.separated_file_for_each_shop else None
    return read_raw(
        spark, base, cfg.columns, cfg.dt_from, cfg.dt_to, cfg.filename_fmt, cfg.data_type, codes,
        missing=missing, options=cfg.csv_options, broadcast_bytes=cfg.broadcast_bytes)


def history_extract(
    spark: SparkSession,
    raw_base: str,
    target_base: str,
    mapping: DataFrame,
    cfg: ReceiptConfig,
    as_of: datetime | None = None,
    missing: str = "error",
    layout: str = "partitioned",
) -> list[DayCounts]:
    """Read the date range in one scan, write the three outputs and return the counts per day.

    ``layout="partitioned"`` keeps one dataset per output, ``{system}_{type}_transformed.parquet`` and
    so on, partitioned by ``dt``; the days of this run replace their former content.
    ``layout="daily"`` writes ``{system}_{type}_{yyyymmdd}_transformed.parquet`` and so on, one dataset
    per day and output.

    The mapping and the staged rows are written once, so the database is asked and the raw files are
    read and parsed a single time, and the three outputs agree even if either changes meanwhile. The staged rows are
    counted as they are written. All working tables are in one folder, which goes at the end.

    The outputs are written beside the targets and published together when all are there: a run that fails leaves the
    former three, and what a run that died left half published is undone by the next (``recover``).
    """
    if layout not in ("partitioned", "daily"):
        raise ValueError(f"unknown layout {layout!r}")
    days = dates_in_range(cfg.dt_from, cfg.dt_to)
    with job_folder(spark) as folder:
        mapping = materialise(mapping, f"{folder}/mapping")
        raw = read_job_files(spark, raw_base, mapping, cfg, missing)
        watched = Observation()
        rows = stage(raw, mapping, cfg)
        if days:
            rows = rows.observe(watched, day_kinds(days[0], len(days)).alias("kinds"))
        staged = materialise(rows, f"{folder}/staged")
        found = day_counts(watched.get["kinds"] if days else [])
        result = [DayCounts(day, **found.get(place, {})) for place, day in enumerate(days)]
        for day in result:
            logger.info("%s", day)
        outputs = {
            "transformed": valid(staged, cfg, as_of),
            "errors": daily_errors(staged, cfg, written=True, largest=max([day.raw_rows for day in result], default=0)),
            "shop_ids": daily_shop_ids(staged),
        }
        prefix = f"{target_base.rstrip('/')}/{cfg.system_code}_{cfg.data_type}"
        publish = _publish_partitioned if layout == "partitioned" else _publish_daily
        with publication(spark, target_base) as published:
            publish(published, outputs, prefix, result)
        return result


def read_output(spark: SparkSession, target_base: str, cfg: ReceiptConfig, output: str) -> DataFrame:
    """One output of the partitioned layout; without any row it has its columns all the same."""
    if output not in OUTPUTS:
        raise ValueError(f"unknown output {output!r}")
    path = f"{target_base.rstrip('/')}/{cfg.system_code}_{cfg.data_type}_{output}.parquet"
    if is_without_files(spark, path):
        return spark.createDataFrame([], _schema(cfg, output))
    reader = spark.read.schema(_schema(cfg, output)) if output == "errors" else spark.read
    return reader.parquet(path).withColumn("dt", F.col("dt").cast("date"))


def _publish_partitioned(published: Publication, outputs: dict[str, DataFrame], prefix: str, days: list[DayCounts]) -> None:
    size = {"transformed": "valid_rows", "errors": "error_rows", "shop_ids": "mapped_rows"}
    for output, df in outputs.items():
        emptied = [day.dt for day in days if getattr(day, size[output]) == 0]
        publish_days(published, df, f"{prefix}_{output}.parquet", emptied)


def _publish_daily(published: Publication, outputs: dict[str, DataFrame], prefix: str, days: list[DayCounts]) -> None:
    for output, df in outputs.items():
        names = {day.dt: f"{prefix}_{day.dt:%Y%m%d}_{output}.parquet" for day in days}
        publish_daily_datasets(published, df if output == "transformed" else df.withColumnRenamed("dt", "__day"), names)


def _schema(cfg: ReceiptConfig, output: str) -> str:
    """The columns of an output. A receipt's code is a number where it is a hash."""
    if output != "transformed":
        return {"errors": "Error string, dt date", "shop_ids": "shop_id bigint, dt date"}[output]
    code = "string" if cfg.receipt_code_columns else {"hash": "int", "xxhash64": "bigint"}[cfg.code_hash]
    return (f"code {code}, dttm timestamp, dttm_added timestamp, dttm_modified timestamp, version int, "
            "shop_id bigint, data_type string, info string, dt date")
