"""Outputs that change together, and in few files."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.operators import staging
from tillroll.operators.staging import ReceiptConfig
from tillroll.plans.history import OUTPUTS, history_extract, read_output
from tillroll.sinks import publish
from tillroll.sinks.publish import publication, recover

AS_OF = datetime(2024, 2, 1)


def config(**changes):
    values = dict(
        columns=["no", "shop", "at"], system_code="sys", data_type="check", shop_num_column_name="shop",
        dt_or_dttm_column_name="at", dt_or_dttm_format="%d.%m.%Y %H:%M", receipt_code_columns=["no"],
        filename_fmt="d{day}.csv", dt_from="2024-01-01", dt_to="2024-01-02")
    return ReceiptConfig(**{**values, **changes})


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame([("10", 110), ("20", 120), ("30", 130)], "code string, object_id int")


def write_days(folder, number):
    for day in (1, 2):
        (folder / f"d{day}.csv").write_text(f"{number};10;0{day}.01.2024 10:00\n{number};20;bad\n{number};99;bad\n")


def content(spark, target, layout):
    """What every dataset below the target holds."""
    paths = sorted(path for path in Path(target).iterdir() if path.name.startswith("sys_"))
    found = {path.name: sorted(map(str, spark.read.parquet(str(path)).collect())) for path in paths}
    assert len(found) == (3 if layout == "partitioned" else 6)
    assert [path.name for path in Path(target).iterdir()].__len__() == len(paths), "nothing else is left"
    return found


class Death(BaseException):
    pass


@pytest.mark.parametrize("layout, when, dies", [
    ("partitioned", 0, True), ("partitioned", 4, False), ("partitioned", 4, True), ("daily", 4, True)])
def test_a_run_that_fails_leaves_the_former_three(spark, tmp_path, mapping, monkeypatch, layout, when, dies):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write_days(raw, 1)
    history_extract(spark, str(raw), target, mapping, config(), AS_OF, layout=layout)
    former = content(spark, target, layout)
    write_days(raw, 2)
    moved, move, undo = [], publish.Publication._move, publish._undo

    def failing(self, source, goal, *rest):
        if len(moved) == when:
            raise Death(goal)
        moved.append(goal)
        move(self, source, goal, *rest)

    monkeypatch.setattr(publish.Publication, "_move", failing)
    if dies:  # then nothing more is done by this process
        monkeypatch.setattr(publish, "_undo", lambda *_: (_ for _ in ()).throw(Death("gone")))
    with pytest.raises(Death):
        history_extract(spark, str(raw), target, mapping, config(), AS_OF, layout=layout)
    monkeypatch.setattr(publish.Publication, "_move", move)
    monkeypatch.setattr(publish, "_undo", undo)
    assert recover(spark, target) == (1 if dies else 0)
    assert content(spark, target, layout) == former
    history_extract(spark, str(raw), target, mapping, config(), AS_OF, layout=layout)
    assert content(spark, target, layout) != former


def test_an_undo_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    base = tmp_path / "base"
    for name in ("a", "b"):
        (base / name).mkdir(parents=True)
        (base / name / "x").write_text("former")
    undo, remove = publish._undo, publish.remove
    monkeypatch.setattr(publish, "_undo", lambda *_: (_ for _ in ()).throw(Death()))
    with pytest.raises(Death), publication(spark, str(base)) as published:
        for name in ("a", "b", "c"):
            source = Path(published.folder) / name
            source.mkdir(parents=True)
            (source / "x").write_text("new")
            published.replace(str(source), str(base / name))
        published.remove(str(base / "none"))
        published.replace(str(Path(published.folder) / "missing"), str(base / "d"))
    monkeypatch.setattr(publish, "_undo", undo)
    assert (base / "a/x").read_text() == "new"
    count = []

    def breaking(spark, path):
        count.append(path)
        if len(count) == 3:
            raise Death
        remove(spark, path)

    monkeypatch.setattr(publish, "remove", breaking)
    with pytest.raises(Death):
        recover(spark, str(base))
    monkeypatch.setattr(publish, "remove", remove)
    assert recover(spark, str(base)) == 1
    assert sorted(path.name for path in base.iterdir()) == ["a", "b"]
    assert {(base / name / "x").read_text() for name in ("a", "b")} == {"former"}


def test_a_block_that_fails_publishes_nothing(spark, tmp_path):
    base = tmp_path / "base"
    with pytest.raises(ZeroDivisionError), publication(spark, str(base)) as published:
        Path(published.folder, "a").mkdir(parents=True)
        published.replace(f"{published.folder}/a", str(base / "a"))
        1 / 0
    assert not list(base.iterdir()) and recover(spark, str(tmp_path / "never")) == 0


@pytest.mark.parametrize("layout", ["partitioned", "daily"])
def test_files_per_shop_make_few_output_files(spark, tmp_path, mapping, layout):
    days = [date(2024, 1, 1) + timedelta(n) for n in range(60)]
    for day in days:
        for shop in ("10", "20", "30"):
            (tmp_path / f"{shop}_{day:%m-%d}.csv").write_text(f"1;{shop};{day:%d.%m.%Y} 10:00\n2;{shop};bad\n")
    cfg = config(separated_file_for_each_shop=True, filename_fmt="{shop_code}_{month:02}-{day:02}.csv", dt_to=str(days[-1]))
    target, partitions = str(tmp_path / "out"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))  # a task reads two files, whatever their size
    try:
        history_extract(spark, str(tmp_path), target, mapping, cfg, AS_OF, layout=layout)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for output in OUTPUTS:
        files = [path for path in Path(target).glob(f"*{output}.parquet/**/*.parquet") if path.is_file()]
        assert len(files) == len(days)
    if layout == "partitioned":
        assert [read_output(spark, target, cfg, output).count() for output in OUTPUTS] == [180, 180, 360]


def test_rows_are_counted_while_they_are_written(spark, tmp_path, mapping):
    write_days(tmp_path, 1)
    (tmp_path / "d2.csv").write_text("")
    twice = mapping.unionByName(spark.createDataFrame([("10", 111)], "code string, object_id int"))
    spark.sparkContext.setJobGroup("counted", "counted")
    found = history_extract(spark, str(tmp_path), str(tmp_path / "out"), twice, config(), AS_OF)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) <= 20
    staged = staging.stage(
        spark.createDataFrame([("1", "10", "01.01.2024 10:00"), ("1", "20", "bad"), ("1", "99", "bad")], "no string, shop string, at string")
        .withColumns({"__dt": F.lit("2024-01-01").cast("date"), "__file_name": F.lit("d1.csv")}), twice, config())
    counted = staging.counts(staged).first()
    assert [found[0].raw_rows, found[0].error_rows, found[0].valid_rows, found[0].mapped_rows] == list(counted)[1:] == [3, 3, 2, 3]
    assert found[1].raw_rows == found[1].error_rows == 0
    totals = [read_output(spark, str(tmp_path / "out"), config(), output).count() for output in OUTPUTS]
    assert totals == [sum(getattr(day, name) for day in found) for name in ("valid_rows", "error_rows", "mapped_rows")]
