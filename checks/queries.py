"""One query per operator, each over whole tables."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from tillroll.functions.receipts import code_collisions, info_json, receipt_code, with_dttm
from tillroll.operators import schema, staging
from tillroll.operators.lookup import join_lookup
from tillroll.operators.mapping import map_shops
from tillroll.operators.row_index import with_row_index
from tillroll.plans.history import history_extract, read_output
from tillroll.plans.imports import import_receipts, import_records
from tillroll.scratch import materialise, working_folder
from tillroll.sinks.datasets import overwrite_dataset, overwrite_days
from tillroll.sinks.tables import append_table
from tillroll.sources.files import (
    file_plan, read_csv, read_dataset, read_raw, rename_positional)
from tillroll.sources.records import read_records, read_records_or_rejects
from tillroll.sources.tables import Split, preview_table, read_table

AS_OF = datetime(2024, 2, 1, 12, 30, 15)
DAILY_FOLDERS = "day={year}{month:02d}{day:02d}"
SHOP_FOLDERS = DAILY_FOLDERS + "/shop={shop_code}"


def _wall(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def _stage(spark: SparkSession, sf_dir: str, **changes) -> DataFrame:
    return staging.stage(
        inputs.raw_rows(spark, sf_dir), inputs.mapping(spark, sf_dir), inputs.config(**changes))


def _fix_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_rows(spark, sf_dir).withColumn("__dt", F.lit(inputs.FIX_DAY).cast("date"))
    return staging.stage(raw, inputs.mapping(spark, sf_dir), inputs.config(fix_date=True))


def _receipts(receipts: DataFrame) -> DataFrame:
    """Receipts with their times as shown, free of a time zone."""
    return receipts.select(
        "code", _wall("dttm"), _wall("dttm_added"), _wall("dttm_modified"), "version", "shop_id", "dt",
        "data_type", "info")


# sources

def rows_per_planned_file(spark, sf_dir):
    plan = file_plan(spark, "2024-01-01", "2024-01-30", inputs.FILE_TEMPLATE, "delivery")
    rows = inputs.raw_rows(spark, sf_dir).groupBy("__file_name").agg(F.count(F.lit(1)).alias("n"))
    return plan.join(rows, plan["file_name"] == rows["__file_name"], "left").select(
        "dt", "file_name",
        F.concat(F.lit("ASIA_delivery_"), F.date_format("dt", "yyyyMMdd"), F.lit("_transformed.parquet"))
        .alias("output_name"),
        F.coalesce("n", F.lit(0)).alias("raw_rows"))


def rows_per_shop_file(spark, sf_dir):
    template = "{data_type}_{shop_code}_{year}-{month}-{day}.csv"
    plan = file_plan(
        spark, "2024-01-01", "2024-01-30", template, "delivery", inputs.mapping(spark, sf_dir))
    rows = inputs.raw_rows(spark, sf_dir).groupBy("__dt", "shop_num").agg(F.count(F.lit(1)).alias("n"))
    same = [plan["dt"] == rows["__dt"], plan["shop_code"] == rows["shop_num"]]
    return plan.join(rows, same, "left").select(
        "dt", "shop_code", "file_name", F.coalesce("n", F.lit(0)).alias("raw_rows"))


def _day_scan(spark, base, template, shop_codes=None, missing="error"):
    raw = read_raw(
        spark, base, inputs.COLUMNS, "2024-01-01", "2024-01-30", template, "delivery", shop_codes,
        missing=missing)
    return raw.select(
        *inputs.COLUMNS, F.col("__dt").alias("dt"), F.col("__file_name").alias("file_name"))


def csv_day_scan(spark, sf_dir):
    return _day_scan(spark, inputs.raw_files(spark, sf_dir), DAILY_FOLDERS)


def csv_shop_scan(spark, sf_dir):
    """Files per day and shop, of which those of one shop are not planned."""
    base = inputs.raw_files(spark, sf_dir, per_shop=True)
    codes = inputs.table(spark, sf_dir, "events").select(F.col("event_type").alias("code"))
    return _day_scan(spark, base, SHOP_FOLDERS, codes.filter("code <> 'error'"), missing="skip")


def csv_shop_scan_adjacent(spark, sf_dir):
    """Folders named by shop and day without anything between, where a name may fit two pairs of them."""
    base = inputs.raw_files(spark, sf_dir, adjacent=True)
    shops = inputs.table(spark, sf_dir, "events").select(inputs.adjacent_shop(F.col("event_type")).alias("shop"))
    codes = shops.filter("shop <> 'x'").select(F.concat(F.lit("name="), "shop").alias("code"))
    return _day_scan(spark, base, "{shop_code}{day}", codes, missing="skip")


def csv_options_scan(spark, sf_dir):
    path = working_folder(spark) + "/orders"
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    orders.write.csv(path, sep="|", header=True)
    return read_csv(
        spark, path, {"sep": "|", "header": "true"},
        "o_orderkey bigint, o_orderstatus string, o_orderpriority string")


def positional_rename(spark, sf_dir):
    base = inputs.raw_files(spark, sf_dir)
    return rename_positional(read_dataset(spark, base + "/day=*", "csv"), inputs.COLUMNS)


def forecast_records(spark, sf_dir):
    path = working_folder(spark) + "/records"
    inputs.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("string").alias("dttm"), F.col("user_id").cast("string").alias("shop_id"),
        "event_type").write.json(path)
    records = read_records(
        spark, path, schema="event_id bigint, dttm string, shop_id string, event_type string",
        limit=10, order_by="event_id")
    return records.select("event_id", _wall("dttm"), "shop_id", "event_type")


def forecast_records_rejects(spark, sf_dir):
    """Records with bad times and shops among them: those loaded, and what was rejected why."""
    path = working_folder(spark) + "/records"
    event = F.col("event_id")
    shop = F.when(event % 10 == 0, F.concat(F.lit("x"), "user_id")).when(event % 17 == 0, "99999999999").when(
        event % 19 == 0, None).otherwise(F.col("user_id").cast("string"))
    inputs.table(spark, sf_dir, "events").select(
        "event_id", F.when(event % 15 == 0, F.concat(F.lit("never-"), event.cast("string"))).otherwise(F.col("ts").cast("string")).alias("dttm"),
        shop.alias("shop_id")).write.json(path)
    records, rejects = read_records_or_rejects(
        spark, path, "event_id bigint, dttm string, shop_id string", key=["event_id"])
    loaded = F.concat_ws("|", F.date_format("dttm", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.coalesce(F.col("shop_id").cast("string"), F.lit("none")))
    return records.select("event_id", F.lit("loaded").alias("output"), loaded.alias("content")).unionByName(
        rejects.select("event_id", F.lit("rejected").alias("output"), F.concat_ws("|", "column", "value", "reason").alias("content")))


def forecast_records_all(spark, sf_dir):
    """All records loaded into the receipt table, completed by its defaults."""
    records = inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("code"), F.col("ts").alias("dttm"), F.col("user_id").alias("shop_id"),
        F.to_date("ts").alias("dt"))
    path = working_folder(spark) + "/records"
    records.write.parquet(path)
    database, name = inputs.database(spark), inputs.new_table(spark, "forecast_receipt")
    import_records(read_records(spark, path, "parquet"), database, name, AS_OF)
    return _receipts(read_table(spark, database, name))


# mapping

def shop_mapping(spark, sf_dir):
    return inputs.mapping(spark, sf_dir)


def stage_mapped(spark, sf_dir):
    mapped = map_shops(inputs.raw_rows(spark, sf_dir), inputs.mapping(spark, sf_dir), "shop_num")
    return mapped.select("receipt_no", "shop_num", F.col("__shop_id").alias("shop_id"))


def stage_mapped_shuffled(spark, sf_dir):
    """The same join by shuffle, as for a mapping too large to broadcast."""
    mapped = map_shops(
        inputs.raw_rows(spark, sf_dir), inputs.mapping(spark, sf_dir), "shop_num", max_bytes=0)
    return mapped.select("receipt_no", "shop_num", F.col("__shop_id").alias("shop_id"))


def _fan_out(spark, sf_dir):
    """Each code for two object types, so that each mapped row comes out twice."""
    systems, types, codes = inputs.mapping_tables(spark, sf_dir)
    other = codes.withColumns({
        "object_type_id": (F.col("object_type_id") + 1) % 25, "object_id": F.col("object_id") + 5000})
    mapping = inputs.shop_mapping(systems, types, codes.unionByName(other), "ASIA")
    return staging.stage(inputs.raw_rows(spark, sf_dir), mapping, inputs.config())


def stage_mapped_fan_out(spark, sf_dir):
    """Receipts and errors as text, and the counts per day, of a mapping with two shops per code."""
    staged = materialise(_fan_out(spark, sf_dir))
    text = lambda *columns: F.concat_ws("|", *[F.col(name).cast("string") for name in columns])
    found = {
        "valid": staging.valid(staged, inputs.config(), AS_OF).select(text("code", "shop_id").alias("content")),
        "errors": staging.errors(staged, inputs.config(), written=True).select(F.col("Error").alias("content")),
        "counts": staging.counts(staged).select(
            text("dt", "raw_rows", "error_rows", "valid_rows", "mapped_rows").alias("content"))}
    parts = [df.select(F.lit(name).alias("output"), "content") for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stage_mapped_numeric_code(spark, sf_dir):
    """A mapping whose codes are numbers, and shop numbers of which every third is none."""
    mapping = inputs.mapping(spark, sf_dir).withColumn("code", F.col("code").cast("int"))
    shop = F.when(F.col("event_type") == "error", F.concat("shop_num", F.lit("x"))).otherwise(F.col("shop_num"))
    mapped = map_shops(inputs.raw_rows(spark, sf_dir).withColumn("shop_num", shop), mapping, "shop_num")
    return mapped.select("receipt_no", "shop_num", F.col("__shop_id").alias("shop_id"))


# expressions

def receipt_code_concat(spark, sf_dir):
    return inputs.raw_rows(spark, sf_dir).select(
        "receipt_no", receipt_code(inputs.COLUMNS, ["receipt_no", "dttm_raw"]).alias("receipt_code"))


def receipt_code_hash(spark, sf_dir):
    return inputs.raw_rows(spark, sf_dir).select(
        "receipt_no", receipt_code(inputs.COLUMNS).alias("receipt_code"))


def _parsed(spark, sf_dir, fix_date=False, fmt="%d.%m.%Y %H:%M:%S"):
    raw = inputs.raw_rows(spark, sf_dir)
    if fix_date:
        raw = raw.withColumn("__dt", F.lit(inputs.FIX_DAY).cast("date"))
    return with_dttm(raw, "dttm_raw", fmt, "__dt", fix_date)


def parse_dttm(spark, sf_dir):
    return _parsed(spark, sf_dir).select("receipt_no", _wall("__dttm").alias("dttm"))


def parse_fix_date(spark, sf_dir):
    return _parsed(spark, sf_dir, fix_date=True).select(
        "receipt_no", _wall("__dttm").alias("dttm"), F.col("__error_class").alias("error_class"),
        F.col("__error_value").alias("error_value"))


def parse_errors(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "receipt_no", F.col("__error_class").alias("error_class"), F.col("__error_value").alias("error_value"))


def _reparsed(spark, sf_dir, shown, fmt):
    """The raw times written another way, and parsed by the format of that; bad and missing ones stay."""
    raw = inputs.raw_rows(spark, sf_dir)
    time = F.try_to_timestamp(F.col("dttm_raw"), F.lit("dd.MM.yyyy HH:mm:ss"))
    text = shown(time) if callable(shown) else F.date_format(time, shown)
    raw = raw.withColumn("dttm_raw", F.coalesce(text, "dttm_raw"))
    return with_dttm(raw, "dttm_raw", fmt, "__dt").select(
        "receipt_no", _wall("__dttm").alias("dttm"), F.col("__error_class").alias("error_class"),
        F.col("__error_value").alias("error_value"))


def parse_weekday(spark, sf_dir):
    """Names of days and months."""
    return _reparsed(spark, sf_dir, "EEEE d MMM yyyy HH:mm:ss", "%A %d %b %Y %H:%M:%S")


def parse_12_hour(spark, sf_dir):
    return _reparsed(spark, sf_dir, "dd.MM.yyyy hh:mm:ss a", "%d.%m.%Y %I:%M:%S %p")


def parse_offset(spark, sf_dir):
    """An offset, which the time is moved by."""
    return _reparsed(spark, sf_dir, "yyyy D HH:mm:ss'+02:30'", "%Y %j %H:%M:%S%z")


def parse_iso_week(spark, sf_dir):
    """Days by the week of the ISO year."""
    return _reparsed(spark, sf_dir, lambda time: F.concat(
        F.extract(F.lit("YEAROFWEEK"), time).cast("string"), F.lit("-W"), F.weekofyear(time).cast("string"), F.lit("-"),
        (F.weekday(time) + 1).cast("string"), F.date_format(time, " HH:mm:ss")), "%G-W%V-%u %H:%M:%S")


def parse_week_of_year(spark, sf_dir):
    """Days by the number of Sundays up to them and the day of the week."""
    return _reparsed(spark, sf_dir, lambda time: F.concat(
        F.date_format(time, "yyyy "), F.floor((F.dayofyear(time) + 7 - F.dayofweek(time)) / 7).cast("string"), F.lit(" "),
        (F.dayofweek(time) - 1).cast("string"), F.date_format(time, " HH:mm:ss")), "%Y %U %w %H:%M:%S")


def receipt_code_collisions(spark, sf_dir):
    """Codes of shop and type, which many different rows share."""
    coded = inputs.raw_rows(spark, sf_dir).withColumn("receipt_code", receipt_code(inputs.COLUMNS, ["shop_num", "event_type"]))
    return code_collisions(coded, inputs.COLUMNS, "receipt_code")


def info_json_text(spark, sf_dir):
    return inputs.raw_rows(spark, sf_dir).withColumn(
        "receipt_code", receipt_code(inputs.COLUMNS, ["receipt_no"])
    ).select("receipt_no", info_json(inputs.COLUMNS).alias("info"))


# row numbers

def _row_index(spark, sf_dir, **options):
    keys, order = ["__dt", "__file_name"], ["receipt_no"]
    indexed = with_row_index(inputs.raw_rows(spark, sf_dir), keys, order, **options)
    return indexed.select("receipt_no", F.col("__file_name").alias("file_name"), F.col("__index").alias("row_index"))


def row_index_per_file(spark, sf_dir):
    return _row_index(spark, sf_dir)


def row_index_split_files(spark, sf_dir):
    """The same numbers by the sort across tasks, as for files too large for one task."""
    return _row_index(spark, sf_dir, rows_per_task=0)


# transform

def receipts_valid(spark, sf_dir):
    return _receipts(staging.valid(_stage(spark, sf_dir), inputs.config(), AS_OF))


def receipts_valid_fixed_date(spark, sf_dir):
    return _receipts(staging.valid(_fix_stage(spark, sf_dir), inputs.config(fix_date=True), AS_OF))


def receipts_errors(spark, sf_dir):
    return staging.errors(_stage(spark, sf_dir), inputs.config())


def receipts_errors_ranked(spark, sf_dir):
    """Failed rows numbered by counting the rows before them, without a sort of the others."""
    return staging.errors(_stage(spark, sf_dir), inputs.config(rank="counting"))


def receipts_errors_fixed_date(spark, sf_dir):
    return staging.errors(_fix_stage(spark, sf_dir), inputs.config(fix_date=True))


def receipts_errors_ties(spark, sf_dir, **changes):
    """Rows numbered by a column of few values, so that nearly all of them tie."""
    columns = ["event_type", "receipt_no", "shop_num", "dttm_raw"]
    cfg = inputs.config(columns=columns, **changes)
    return staging.errors(_stage(spark, sf_dir, columns=columns), cfg)


def shop_ids(spark, sf_dir):
    return staging.shop_ids(_stage(spark, sf_dir))


def stage_counts(spark, sf_dir):
    return staging.counts(_stage(spark, sf_dir))


def conform_receipt(spark, sf_dir):
    receipts = staging.valid(_stage(spark, sf_dir), inputs.config(), AS_OF).withColumn(
        "version", F.when(F.col("shop_id") % 2 == 0, F.col("version")))
    return _receipts(schema.with_defaults(schema.conform(receipts), AS_OF))


# datasets

def parquet_overwrite_roundtrip(spark, sf_dir):
    path = working_folder(spark) + "/orders.parquet"
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    overwrite_dataset(orders, path)
    overwrite_dataset(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return read_dataset(spark, path)


def history_overwrite_day(spark, sf_dir):
    """All days, then again the days up to the 15th with other content and one of them emptied."""
    path = working_folder(spark) + "/receipts.parquet"
    receipts = materialise(staging.valid(_stage(spark, sf_dir), inputs.config(), AS_OF))
    overwrite_days(receipts, path)
    again = receipts.filter("dt <= date'2024-01-15'").withColumn("version", F.lit(1))
    emptied = datetime(2024, 1, 3).date()
    overwrite_days(again.filter(F.col("dt") != F.lit(emptied)), path, [emptied])
    return read_dataset(spark, path).select(
        "code", "shop_id", "version", F.col("dt").cast("date").alias("dt"))


# databases

def _customer(spark, sf_dir):
    return inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def _customer_table(spark, sf_dir, times=1):
    database, name = inputs.database(spark), inputs.new_table(spark, "customer")
    for _ in range(times):
        append_table(_customer(spark, sf_dir), database, name)
    return database, name


def jdbc_scan_partitioned(spark, sf_dir):
    database, name = _customer_table(spark, sf_dir)
    bounds = _customer(spark, sf_dir).agg(F.min("c_custkey").alias("low"), F.max("c_custkey").alias("high")).first()
    return read_table(spark, database, name, Split("c_custkey", bounds["low"], bounds["high"], 8))


def jdbc_append_roundtrip(spark, sf_dir):
    return read_table(spark, *_customer_table(spark, sf_dir, times=2))


def jdbc_append_skip(spark, sf_dir):
    """Half of the days imported, then all of them with rows already present left out."""
    path = working_folder(spark) + "/receipts.parquet"
    overwrite_days(staging.valid(_stage(spark, sf_dir), inputs.config(), AS_OF), path)
    database, name = inputs.database(spark), inputs.new_table(spark, "forecast_receipt")
    half = schema.conform(read_dataset(spark, path).filter("dt <= date'2024-01-15'"))
    append_table(half, database, name)
    import_receipts(spark, path, database, name, on_existing="skip", schema=schema.RECEIPT)
    return _receipts(read_table(spark, database, name))


def import_receipts_query(spark, sf_dir):
    path = working_folder(spark) + "/receipts.parquet"
    overwrite_dataset(staging.valid(_stage(spark, sf_dir), inputs.config(), AS_OF), path)
    database, name = inputs.database(spark), inputs.new_table(spark, "forecast_receipt")
    import_receipts(spark, path, database, name, schema=schema.RECEIPT)
    return _receipts(read_table(spark, database, name))


def preview(spark, sf_dir):
    database, name = inputs.database(spark), inputs.new_table(spark, "orders")
    append_table(
        inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), database, name)
    return preview_table(spark, database, name, 3, order_by="o_orderkey")


# the whole job

def history(spark, sf_dir, layout="partitioned", sep=None, base=None):
    """Raw CSV of all days to the three outputs, read back as rows of text."""
    base = base or inputs.raw_files(spark, sf_dir, sep=sep or ";")
    target = working_folder(spark)
    cfg = inputs.config(filename_fmt=DAILY_FOLDERS, csv_options={} if sep is None else {"sep": sep})
    history_extract(spark, base, target, inputs.mapping(spark, sf_dir), cfg, AS_OF, layout=layout)
    if layout == "daily":
        read = {name: spark.read.parquet(f"{target}/ASIA_delivery_*_{name}.parquet") for name in
                ("transformed", "errors", "shop_ids")}
    else:
        read = {name: read_output(spark, target, cfg, name) for name in ("transformed", "errors", "shop_ids")}
    receipt = F.concat_ws(
        "|", "code", F.col("dttm").cast("string"), F.col("shop_id").cast("string"), F.col("dt").cast("string"),
        "data_type", "info")
    return (
        read["transformed"].select(F.lit("transformed").alias("output"), receipt.alias("content"))
        .unionByName(read["errors"].select(F.lit("errors").alias("output"), F.col("Error").alias("content")))
        .unionByName(read["shop_ids"].select(
            F.lit("shop_ids").alias("output"), F.col("shop_id").cast("string").alias("content")))
    )


def history_no_valid(spark, sf_dir):
    """A system without codes: every row is an error, and importing its receipts appends none."""
    base, target = inputs.raw_files(spark, sf_dir), working_folder(spark)
    cfg = inputs.config(filename_fmt=DAILY_FOLDERS, system_code="NONE")
    none = inputs.shop_mapping(*inputs.mapping_tables(spark, sf_dir), "NONE")
    history_extract(spark, base, target, none, cfg, AS_OF)
    import_receipts(spark, f"{target}/NONE_delivery_transformed.parquet", inputs.NO_DATABASE, "never.made")
    receipts, shops = (read_output(spark, target, cfg, name) for name in ("transformed", "shop_ids"))
    return (
        read_output(spark, target, cfg, "errors").select("Error")
        .unionByName(receipts.select(F.col("code").alias("Error")))
        .unionByName(shops.select(F.col("shop_id").cast("string").alias("Error"))))


QUERIES = {
    "rows_per_planned_file": rows_per_planned_file,
    "rows_per_shop_file": rows_per_shop_file,
    "csv_day_scan": csv_day_scan,
    "csv_shop_scan": csv_shop_scan,
    "csv_shop_scan_adjacent": csv_shop_scan_adjacent,
    "csv_options_scan": csv_options_scan,
    "positional_rename": positional_rename,
    "jdbc_scan_partitioned": jdbc_scan_partitioned,
    "shop_mapping": shop_mapping,
    "stage_mapped": stage_mapped,
    "stage_mapped_shuffled": stage_mapped_shuffled,
    "stage_mapped_fan_out": stage_mapped_fan_out,
    "stage_mapped_numeric_code": stage_mapped_numeric_code,
    "receipt_code_concat": receipt_code_concat,
    "receipt_code_hash": receipt_code_hash,
    "receipt_code_collisions": receipt_code_collisions,
    "parse_dttm": parse_dttm,
    "parse_fix_date": parse_fix_date,
    "parse_errors": parse_errors,
    "parse_weekday": parse_weekday,
    "parse_12_hour": parse_12_hour,
    "parse_offset": parse_offset,
    "parse_iso_week": parse_iso_week,
    "parse_week_of_year": parse_week_of_year,
    "row_index_per_file": row_index_per_file,
    "row_index_split_files": row_index_split_files,
    "info_json": info_json_text,
    "receipts_valid": receipts_valid,
    "receipts_valid_fixed_date": receipts_valid_fixed_date,
    "receipts_errors": receipts_errors,
    "receipts_errors_fixed_date": receipts_errors_fixed_date,
    "receipts_errors_ties": receipts_errors_ties,
    "receipts_errors_ties_split": partial(receipts_errors_ties, rows_per_task=0, broadcast_bytes=0, places_bytes=0),
    "receipts_errors_ranked": receipts_errors_ranked,
    "receipts_errors_ties_ranked": partial(receipts_errors_ties, rank="counting"),
    "shop_ids": shop_ids,
    "stage_counts": stage_counts,
    "conform_receipt": conform_receipt,
    "parquet_overwrite_roundtrip": parquet_overwrite_roundtrip,
    "history_overwrite_day": history_overwrite_day,
    "jdbc_append_roundtrip": jdbc_append_roundtrip,
    "jdbc_append_skip": jdbc_append_skip,
    "import_receipts": import_receipts_query,
    "forecast_records": forecast_records,
    "forecast_records_rejects": forecast_records_rejects,
    "forecast_records_import": forecast_records_all,
    "preview_table": preview,
    "history_extract": history,
    "history_extract_daily": partial(history, layout="daily"),
    "history_extract_comma": partial(history, sep=","),
    "history_extract_no_valid": history_no_valid,
}
