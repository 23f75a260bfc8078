"""The whole transform against a row-by-row model in plain Python, on random rows."""

import json
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillroll.operators import staging
from tillroll.operators.staging import ReceiptConfig

FORMAT = "%d.%m.%Y %H:%M"
COLUMNS = ["no", "shop", "at", "note"]


def random_rows(seed):
    chance = random.Random(seed)
    rows = []
    for number in range(400):
        day, file = chance.choice([(date(2024, 1, 15), "a"), (date(2024, 1, 15), "b"), (date(2024, 1, 20), "a")])
        at = chance.choice([
            None, "", "soon", "31.02.2024 1:00", f"{chance.randint(1, 31)}.1.2024 {chance.randint(0, 24)}:05",
            f"{chance.randint(1, 31):02}.01.2024 23:59", "15.01.2024 10:00 "])
        shop = chance.choice([None, "10", "20", "30", "10"])
        rows.append((str(number), shop, at, chance.choice([None, "n\"1", "я"]), day, file))
    return rows


# What each text comes to, as the rules say: its time, or its error whatever the day of the file.
NO_MATCH = "ValueError: time data {!r} does not match format '%d.%m.%Y %H:%M'"
FAILURES = {
    None: "TypeError: strptime() argument 1 must be str, not None",
    "": NO_MATCH.format(""), "soon": NO_MATCH.format("soon"),
    "31.02.2024 1:00": "ValueError: day is out of range for month",
    "15.01.2024 10:00 ": "ValueError: unconverted data remains:  ",
}
LATEST = {21: 20, 22: 20, 23: 20}  # the hours that a fixed date does not keep
# January days within a week of a file's day.
NEAR = {date(2024, 1, 15): range(8, 23), date(2024, 1, 20): range(13, 28)}


def parsed(text, day, fix_date):
    if text in FAILURES:
        return None, FAILURES[text]
    in_january, hour, minute = map(int, re.fullmatch(r"(\d+)\.0?1\.2024 (\d+):(\d+)", text).groups())
    if hour == 24:
        return None, NO_MATCH.format(text)
    shown = datetime(2024, 1, in_january, hour, minute)
    if not fix_date:
        return shown, None
    if in_january not in NEAR[day]:
        return None, f"TypeError: Range between {day} and {shown} is greater than 1 week"
    return datetime(day.year, day.month, day.day, LATEST.get(hour, hour), minute), None


def model(rows, mapping, fix_date):
    receipts, errors, shops = [], [], []
    for group in {row[4:] for row in rows}:
        members = sorted((row for row in rows if row[4:] == group), key=lambda row: row[0])
        for index, row in enumerate(members, 1):
            moment, error = parsed(row[2], row[4], fix_date)
            for shop_id in [found for code, found in mapping if code == row[1] is not None] or [None]:
                if shop_id is None:
                    errors.append(f"can't map shop_id for shop_num='{row[1]}'")
                else:
                    shops.append(shop_id)
                if error:
                    errors.append(f"{error}: {row[5]}: row: {index}")
                elif shop_id is not None:
                    info = {name: value for name, value in zip(COLUMNS, row) if value is not None}
                    info["receipt_code"] = (row[0] or "") + (row[3] or "")
                    receipts.append((info["receipt_code"], moment, shop_id, row[4], json.dumps(info, sort_keys=True)))
    return sorted(receipts), sorted(errors), sorted(shops)


@pytest.mark.parametrize("fix_date", [False, True])
@pytest.mark.parametrize(("rows_per_task", "broadcast_bytes"), [(1000, 1 << 20), (0, 0)])
def test_outputs_equal_the_model(spark, fix_date, rows_per_task, broadcast_bytes):
    cfg = ReceiptConfig(
        columns=COLUMNS, system_code="s", data_type="t", shop_num_column_name="shop",
        dt_or_dttm_column_name="at", dt_or_dttm_format=FORMAT, receipt_code_columns=["no", "note"],
        fix_date=fix_date, rows_per_task=rows_per_task, broadcast_bytes=broadcast_bytes)
    rows, mapping = random_rows(11), [("10", 1), ("10", 2), ("10", 2), ("20", 3), ("99", 4)]
    raw = spark.createDataFrame(
        rows, "no string, shop string, at string, note string, __dt date, __file_name string").repartition(3)
    staged = staging.stage(raw, spark.createDataFrame(mapping, "code string, object_id int"), cfg)
    receipts = [
        (row["code"], row["dttm"], row["shop_id"], row["dt"], json.dumps(json.loads(row["info"]), sort_keys=True))
        for row in staging.valid(staged, cfg).collect()]
    errors = [row["Error"] for row in staging.errors(staged, cfg).collect()]
    shops = [row["shop_id"] for row in staging.shop_ids(staged).collect()]
    expected = model(rows, mapping, fix_date)
    assert sorted(receipts) == expected[0]
    assert sorted(errors) == expected[1]
    assert sorted(shops) == expected[2]
    totals = staging.counts(staged).agg(
        *[F.sum(name) for name in ("raw_rows", "valid_rows", "error_rows", "mapped_rows")]).first()
    assert tuple(totals) == (len(rows), *map(len, expected))
