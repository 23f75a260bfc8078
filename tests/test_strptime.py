import random
import warnings
from datetime import datetime

import pytest

from tillroll.functions.strptime import format_pattern, with_strptime

warnings.simplefilter("ignore", DeprecationWarning)

TRANSLATED = [
    "%d.%m.%Y %H:%M:%S", "%d%m%Y", "%d%m%Y%H%M%S", "%Y-%m-%dT%H:%M:%S.%f", "%y/%m/%d", "%m%d", "%H:%M",
    "%d %m %y  %H", "%Y%m%d %f", "%d%Y%m", "100%% %Y", "(%d)[%m]*$\\ %Y", "%S", "%Y-%m-%d\n%H",
    "%d %b %Y", "%I:%M %p", "%Y-%m-%d %H:%M:%S%z", "%Y %j", "%A, %d. %B %Y %H:%M:%S.%f", "%a %d%b%y", "%p %I", "%I",
    "%j", "%Y%j%H", "%z %d.%m.%Y", "%H %p", "%B", "%d.%m.%Y %j",
    "%G-%V-%u", "%G W%V %A %H:%M", "%a %V %G", "%Y %U %w", "%Y|%W|%a %S", "%y %W %u", "%A %U %Y %z", "%Y %j %U %w", "%d.%m.%Y %a %w",
    "%d.%m.%Y %U", "%w %d.%m.%Y %W %I %p",
]
LEFT_TO_PYTHON = ["%f", "%Q", "%d %", "%d %d", "no directive", "%c", "%U %w", "%G %V", "%V %Y %u", "%G %V %u %a", "%G %V %u %j", "%Y %U %w %a", "%Y %U %W %w", "%G %V %u %d", "%H %I", "%b %m", "%Z"]
FIXED = [
    None, "", "x", "0000", "31.02.2024 10:00:00", "01.01.0000 00:00:00", "1.1.2024 1:1:61",
    "31.02.2024 10:00:61", " 1.1.2024 1:1:1", "1.1.2024  1:1:1", "2024-01-01", "24:00", "29.02.2023 1:1:1",
    "001.01.2024 1:1:1", "1.1.2024 1:1:1Z", "1.1.2024 1:1:1+03:00", "1.1.2024 1:1:1 ", "110000", "10000",
    "100005", "1100001", "5 Jan 2024", "05 feb 2024", "11:30 PM", "2024-01-01 10:00:00+0300", "2024 60",
    "12:30 am", "12:30 AM", "12:01 pm", "0:30 pm", "PM 3", "29 Feb 2023", "2023 366", "2024 366", "0000 5", "000 1", "may", "December",
    "2024-01-01 10:00:00Z", "2024-01-01 10:00:00z", "2024-01-01 10:00:61+01:00", "2024-01-01 10:00:00-00:30",
    "2024-01-01 10:00:00+01:0030", "2024-01-01 10:00:00+0100:30", "2024-01-01 10:00:00+01:00:30.5", "2024-01-01 10:00:00-010030",
    "2024-01-01 10:00:00+24:00", "2024-01-01 10:00:00-9959", "2024-02-30 10:00:00+9959", "2024-01-01 10:00:00+23:59:59.999999",
    "0000-01-01 10:00:00+0100", "2024-01-01 10:00:00+0160", "+01:30 05.06.2024", "Friday, 5. January 2024 10:11:12.5",
    "friday, 31. FEBRUARY 2024 1:1:1.000001", "Mon 31dec99", "30.02.2024 5", "1.1.2024 366",
    "0000-10-1", "9999-52-7", "9999-52-5", "2024-53-1", "2020-53-1", "2020-0-1", "0001-01-1", "0000-00-1", "2021-53-3", "2026-53-4",
    "0000 5 1", "0001 0 0", "9999 53 6", "9999 52 6", "2024 53 6", "2024 0 1", "2024 0 0", "1999 00 3", "2023 1 0", "2000 52 6",
    "2024|0|Mon 5", "2024|53|sun 61", "0001|0|Mon 1", "24 01 7", "Sunday 0 2023 +0100", "Sunday 0 0001 +0100", "2024 60 0 1", "Sat 53 2020",
    "2024 W09 thursday 10:11", "3 31.02.2024 5 11 pm", "30.02.2024 Mon 1",
    "it's", 'say "no"', "it's \"no\"", "back\\slash", "tab\there", "no directive",
]
ALPHABET = "0123456789.: -/T%'\"\\\n\t(+Zк "


def expected(text, fmt):
    try:
        moment = datetime.strptime(text, fmt)
    except Exception as error:
        return None, None, type(error).__name__, str(error)
    wall = moment.replace(tzinfo=None)
    return wall, moment.strftime("%:z") or None, None, None


def texts_for(fmt, seed=5, count=400):
    chance = random.Random(seed)
    texts = set(FIXED)
    for _ in range(count):
        moment = datetime(
            chance.choice([1, 99, 1900, 1969, 1999, 2000, 2024, 2068, 2069, 9999]), chance.choice([1, 1, 12, 12, *range(1, 13)]),
            chance.choice([1, 2, 3, 26, 27, 28, *range(1, 29)]), chance.randint(0, 23), chance.randint(0, 59), chance.randint(0, 59),
            chance.randint(0, 999999))
        text = moment.strftime(fmt)
        for _ in range(chance.choice([0, 0, 1, 2])):
            place, char = chance.randint(0, len(text)), chance.choice(ALPHABET)
            text = text[:place] + chance.choice(["", char]) + text[place + chance.choice([0, 1]):]
        texts.add(text)
        texts.add("".join(chance.choice("0123456789") for _ in range(chance.randint(1, 15))))
    return list(texts)


@pytest.mark.parametrize("fmt", TRANSLATED + LEFT_TO_PYTHON)
def test_parses_as_python_does(spark, fmt):
    texts = texts_for(fmt) if fmt in TRANSLATED else FIXED
    rows = with_strptime(spark.createDataFrame([(t,) for t in texts], "text string"), "text", fmt).collect()
    different = [
        (row["text"], expected(row["text"], fmt), found)
        for row in rows
        if (found := (row["__wall"], row["__utc_offset"], row["__error_class"], row["__error_value"]))
        != expected(row["text"], fmt)
    ]
    assert different == []


def test_which_formats_are_translated():
    assert all(format_pattern(fmt) is not None for fmt in TRANSLATED)
    assert all(format_pattern(fmt) is None for fmt in LEFT_TO_PYTHON)


def test_column_names_with_dots_and_ticks(spark):
    df = spark.createDataFrame([("1.2.2024",)], ["a.b`c"])
    assert with_strptime(df, "a.b`c", "%d.%m.%Y").first()["__wall"] == datetime(2024, 2, 1)


def test_no_python_for_formats_that_are_translated(spark):
    df = with_strptime(spark.createDataFrame([("x",)], "text string"), "text", "%A %d %b %Y %I:%M %p %z")
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
