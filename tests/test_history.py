import logging
from datetime import date, datetime

import pytest

from tillroll.operators.staging import ReceiptConfig
from tillroll.plans.history import DayCounts, history_extract, read_job_files, read_output

AS_OF = datetime(2024, 2, 1)


def config(**changes):
    values = dict(
        columns=["no", "shop", "at"], system_code="sys", data_type="check", shop_num_column_name="shop",
        dt_or_dttm_column_name="at", dt_or_dttm_format="%d.%m.%Y %H:%M", receipt_code_columns=["no"],
        filename_fmt="{data_type}_{year}{month:02d}{day:02d}.csv", dt_from="2024-01-01", dt_to="2024-01-03")
    return ReceiptConfig(**{**values, **changes})


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame([("10", 110), ("20", 120)], "code string, object_id int")


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "check_20240101.csv").write_text("1;10;01.01.2024 10:00\n2;20;bad\n3;30;01.01.2024 11:00\n")
    (folder / "check_20240102.csv").write_text("4;10;02.01.2024 10:00\n")
    (folder / "check_20240103.csv").write_text("")
    return folder


COUNTS = [
    DayCounts(date(2024, 1, 1), 3, 2, 1, 2), DayCounts(date(2024, 1, 2), 1, 0, 1, 1), DayCounts(date(2024, 1, 3))]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_partitioned_outputs(spark, raw, tmp_path, mapping, caplog):
    target = str(tmp_path / "out")
    with caplog.at_level(logging.INFO):
        assert history_extract(spark, str(raw), target, mapping, config(), AS_OF) == COUNTS
    assert "raw_rows=3" in caplog.text
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    output = lambda name: read_output(spark, target, config(), name)
    assert rows(output("transformed"), "code", "shop_id", "dt") == [("1", 110, first), ("4", 110, second)]
    assert rows(output("shop_ids"), "shop_id", "dt") == [(110, first), (110, second), (120, first)]
    assert rows(output("errors"), "Error", "dt") == [
        ("ValueError: time data 'bad' does not match format '%d.%m.%Y %H:%M': check_20240101.csv: row: 2", first),
        ("can't map shop_id for shop_num='30'", first)]
    with pytest.raises(ValueError, match="unknown output"):
        read_output(spark, target, config(), "other")


def test_a_second_run_replaces_its_days_only(spark, raw, tmp_path, mapping):
    target = str(tmp_path / "out")
    history_extract(spark, str(raw), target, mapping, config(), AS_OF)
    (raw / "check_20240101.csv").write_text("9;10;01.01.2024 10:00\n")
    again = config(dt_to="2024-01-01")
    assert history_extract(spark, str(raw), target, mapping, again, AS_OF) == [DayCounts(date(2024, 1, 1), 1, 0, 1, 1)]
    assert rows(read_output(spark, target, again, "transformed"), "code") == [("4",), ("9",)]
    assert rows(read_output(spark, target, again, "errors"), "Error") == []


def test_daily_outputs(spark, raw, tmp_path, mapping):
    target = str(tmp_path / "out")
    assert history_extract(spark, str(raw), target, mapping, config(), AS_OF, layout="daily") == COUNTS
    names = sorted(path.name for path in (tmp_path / "out").iterdir())
    assert names == sorted(
        f"sys_check_2024010{day}_{output}.parquet" for day in (1, 2, 3)
        for output in ("transformed", "errors", "shop_ids"))
    receipts = spark.read.parquet(f"{target}/sys_check_20240101_transformed.parquet")
    assert receipts.columns == [
        "code", "dttm", "dttm_added", "dttm_modified", "version", "shop_id", "dt", "data_type", "info"]
    assert receipts.count() == 1
    assert spark.read.parquet(f"{target}/sys_check_20240103_errors.parquet").columns == ["Error"]
    with pytest.raises(ValueError, match="unknown layout"):
        history_extract(spark, str(raw), target, mapping, config(), layout="monthly")


def test_missing_days(spark, raw, tmp_path, mapping):
    longer = config(dt_to="2024-01-04")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        history_extract(spark, str(raw), str(tmp_path / "out"), mapping, longer)
    found = history_extract(spark, str(raw), str(tmp_path / "out"), mapping, longer, missing="skip")
    assert found == [*COUNTS, DayCounts(date(2024, 1, 4))]


def test_files_per_shop_end_in_one_output_per_day(spark, tmp_path, mapping):
    for shop in ("10", "20", "30"):
        (tmp_path / f"{shop}_1.csv").write_text(f"1;{shop};01.01.2024 10:00\n2;{shop};bad\n")
    cfg = config(
        separated_file_for_each_shop=True, filename_fmt="{shop_code}_{day}.csv", dt_to="2024-01-01")
    assert read_job_files(spark, str(tmp_path), mapping, cfg).count() == 4
    target = str(tmp_path / "out")
    assert history_extract(spark, str(tmp_path), target, mapping, cfg) == [DayCounts(date(2024, 1, 1), 4, 2, 2, 4)]
    errors = rows(read_output(spark, target, cfg, "errors"), "Error")
    assert [text.split(": ", 2)[2] for text, in errors] == ["10_1.csv: row: 2", "20_1.csv: row: 2"]


def test_staging_folder_is_removed(spark, raw, tmp_path, mapping):
    shared = spark.conf.get("spark.checkpoint.dir")
    from pathlib import Path
    history_extract(spark, str(raw), str(tmp_path / "out"), mapping, config())
    assert not [path for path in Path(shared).glob("tillroll-*/staged")]


def test_columns_of_awkward_names(spark, tmp_path, mapping):
    (tmp_path / "d1.csv").write_text("1;10;01.01.2024 10:00;x\n2;10;bad;y\n")
    cfg = config(
        columns=["a b", "c;d,e", "f.g=h", "ключ"], shop_num_column_name="c;d,e", dt_or_dttm_column_name="f.g=h",
        receipt_code_columns=["a b", "ключ"], filename_fmt="d{day}.csv", dt_to="2024-01-01")
    target = str(tmp_path / "out")
    assert history_extract(spark, str(tmp_path), target, mapping, cfg) == [DayCounts(date(2024, 1, 1), 2, 1, 1, 2)]
    assert rows(read_output(spark, target, cfg, "transformed"), "code", "info") == [
        ("1x", '{"a b":"1","c;d,e":"10","f.g=h":"01.01.2024 10:00","ключ":"x","receipt_code":"1x"}')]


def test_hash_codes_by_default(spark, raw, tmp_path, mapping):
    cfg = config(receipt_code_columns=None, dt_to="2024-01-01")
    target = str(tmp_path / "out")
    history_extract(spark, str(raw), target, mapping, cfg)
    receipt = read_output(spark, target, cfg, "transformed").first()
    assert isinstance(receipt["code"], int) and f'"receipt_code":{receipt["code"]}' in receipt["info"]


def test_no_working_table_is_left(spark, raw, tmp_path, mapping):
    from pathlib import Path
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    history_extract(spark, str(raw), str(tmp_path / "out"), mapping, config(rows_per_task=0, broadcast_bytes=0))
    assert set(shared.iterdir()) == before


def test_separator_of_the_job(spark, tmp_path, mapping):
    (tmp_path / "check_20240101.csv").write_text("1,10,01.01.2024 10:00\n")
    cfg = config(dt_to="2024-01-01", csv_options={"sep": ","})
    assert history_extract(spark, str(tmp_path), str(tmp_path / "out"), mapping, cfg) == [
        DayCounts(date(2024, 1, 1), 1, 0, 1, 1)]


@pytest.mark.parametrize("codes", [["no"], None])
def test_outputs_without_rows_can_be_read_and_imported(spark, raw, tmp_path, codes):
    from tillroll.plans.imports import import_receipts
    from tillroll.sources.tables import Database
    none = spark.createDataFrame([], "code string, object_id int")
    cfg, target = config(receipt_code_columns=codes), str(tmp_path / "out")
    history_extract(spark, str(raw), target, none, cfg)
    receipts = read_output(spark, target, cfg, "transformed")
    assert receipts.count() == 0 and receipts.schema["code"].dataType.simpleString() == ("string" if codes else "int")
    assert read_output(spark, target, cfg, "shop_ids").columns == ["shop_id", "dt"]
    import_receipts(spark, f"{target}/sys_check_transformed.parquet", Database("jdbc:none"))


def test_daily_layout_takes_as_many_jobs_for_any_number_of_days(spark, tmp_path, mapping):
    def jobs(days):
        folder = tmp_path / f"raw{days}"
        folder.mkdir()
        for day in range(1, days + 1):
            (folder / f"check_202401{day:02}.csv").write_text(f"1;10;{day:02}.01.2024 10:00\n2;20;bad\n")
        group = f"daily-{days}"
        spark.sparkContext.setJobGroup(group, group)
        history_extract(spark, str(folder), str(tmp_path / f"out{days}"), mapping,
                        config(dt_to=f"2024-01-{days:02}"), layout="daily")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert jobs(3) == jobs(9)
