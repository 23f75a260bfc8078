"""Parse text by a Python ``strptime`` format with Spark expressions.

A format becomes, once and on the driver, one regular expression. Per row Spark then rewrites the text
as ``2024-1-31 9:05:00`` by one ``regexp_replace`` and casts it; both are part of code generation, and
the time is a single expression, so that a filter pushed below it does not multiply the work. Error
texts are worked out for rejected rows only.

Formats with names of months or days (English ones), a 12-hour clock, a day of the year, weeks or an offset take a
pattern too, which splits the text into parts that are put together one by one. What goes by the machine's locale
and zone (``%c`` ``%x`` ``%X`` ``%Z``), and combinations that contradict themselves or lack a part, go through
``datetime.strptime`` in a pandas UDF.

Two points differ from Python and are accepted: digits outside ASCII are rejected, and the message for
a value with control characters other than tab, newline and carriage return shows them unescaped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text that each strptime directive accepts. Year 0 and the blank of a day are
# accepted but not captured, so year 0 leaves a text that no cast reads.
DIRECTIVES = {
    "Y": r"(?:0000|(?<Y>[0-9][0-9][0-9][0-9]))",
    "y": r"(?<y>[0-9][0-9])",
    "m": r"(?<m>1[0-2]|0[1-9]|[1-9])",
    "d": r"(?:(?<d>3[01]|[12][0-9]|0[1-9]|[1-9])| (?<e>[1-9]))",
    "H": r"(?<H>2[0-3]|[01][0-9]|[0-9])",
    "M": r"(?<M>[0-5][0-9]|[0-9])",
    "S": r"(?<S>6[01]|[0-5][0-9]|[0-9])",
    "f": r"(?<f>[0-9]{1,6})",
}
# The English names that Python's parser knows in its plain locale.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def _one_of(group: str, names: list[str]) -> str:
    return f"(?<{group}>(?i:{'|'.join(sorted(names, key=len, reverse=True))}))"


# The same for the directives whose parts are put together one by one.
MORE_DIRECTIVES = {
    "B": _one_of("B", MONTHS),
    "b": _one_of("b", [name[:3] for name in MONTHS]),
    "A": _one_of("A", WEEKDAYS),
    "a": _one_of("a", [name[:3] for name in WEEKDAYS]),
    "I": r"(?<I>1[0-2]|0[1-9]|[1-9])",
    "p": _one_of("p", ["am", "pm"]),
    "j": r"(?<j>36[0-6]|3[0-5][0-9]|[12][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9])",
    "U": r"(?<U>5[0-3]|[0-4][0-9]|[0-9])",
    "W": r"(?<W>5[0-3]|[0-4][0-9]|[0-9])",
    "G": r"(?<G>[0-9][0-9][0-9][0-9])",
    "V": r"(?<V>5[0-3]|0[1-9]|[1-4][0-9]|[0-9])",
    "u": r"(?<u>[1-7])",
    "w": r"(?<w>[0-6])",
    "z": r"(?<z>[+-][0-9][0-9]:?[0-5][0-9](?::?[0-5][0-9](?:\.[0-9]{1,6})?)?|Z)",
}
# Directives of which a format may have one only, as the later would go before the earlier.
EXCLUSIVE = ("Yy", "mBb", "HI", "UW")
SECONDS_PER_DAY = 86_400
# What a format without the directive stands for.
DEFAULTS = {"Y": "1900", "m": "1", "d": "1", "H": "0", "M": "0", "S": "0", "f": "0"}
# Fixed value: two-digit years from here on belong to the 1900s.
CENTURY_PIVOT = 69

# Fixed value: what Python takes for white space.
SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

_TOKEN = re.compile(r"%(?P<directive>.)|(?P<space>\s+)|(?P<text>[^%\s]+)", re.DOTALL)
_BETWEEN = "\x1f"  # no part of a time holds it
_GROUP = re.compile(r"\(\?<(\w)>")


@dataclass(frozen=True)
class FormatPattern:
    """``prefix`` matches the start of a text the one way Python does; ``whole`` matches any text.

    ``whole`` captures the directives, and the first surplus character as ``x``; of a text that does not
    fit it captures nothing. The texts built from it put ``x`` in two places, of which each is
    invalid for a cast where the other may pass (blanks within a year, anything else before its sign).
    Groups go by number, which is faster per row than by name.
    """

    named_prefix: str
    directives: str

    @property
    def prefix(self) -> str:
        return _GROUP.sub("(", self.named_prefix)

    @property
    def by_parts(self) -> bool:
        return any(directive in MORE_DIRECTIVES for directive in self.directives)

    @property
    def named_whole(self) -> str:
        return self.named_prefix.replace(r"\A", r"\A(?:", 1) + r"(?:\z|(?<x>.).*)|.*)\z"

    @property
    def whole(self) -> str:
        return _GROUP.sub("(", self.named_whole)

    def group(self, name: str) -> str:
        return f"${_GROUP.findall(self.named_whole).index(name) + 1}"

    def _shown(self, directive: str) -> str:
        if directive not in self.directives:
            return DEFAULTS[directive]
        return self.group("d") + self.group("e") if directive == "d" else self.group(directive)

    @property
    def date_text(self) -> str:
        year = "20" + self.group("y") if "y" in self.directives else self._shown("Y")
        surplus = self.group("x")
        return f"{surplus}+{year}{surplus}-{self._shown('m')}-{self._shown('d')}"

    @property
    def time_text(self) -> str:
        return "{}:{}:{}.{}".format(*map(self._shown, "HMSf"))


def format_pattern(fmt: str) -> FormatPattern | None:
    """The pattern for ``fmt``, or None where only Python itself gives the same result."""
    regex, directives, position = "", "", 0
    while position < len(fmt):
        token = _TOKEN.match(fmt, position)
        if token is None:
            return None
        position = token.end()
        directive = token["directive"]
        if directive == "%":
            regex += "%"
        elif directive:
            known = {**DIRECTIVES, **MORE_DIRECTIVES}
            if directive not in known or directive in directives:
                return None
            directives += directive
            regex += known[directive]
        elif token["space"]:
            regex += SPACES
        else:
            regex += r"\Q" + token["text"] + r"\E"
    # A text without captures must not pass as a time, which it could if only a fraction were missing.
    if directives in ("", "f") or "\\E" in fmt:
        return None
    if any(sum(name in directives for name in group) > 1 for group in EXCLUSIVE):
        return None
    if not _week_fits(directives):
        return None
    # Letters in the format match in either case; without any, the plain comparison is faster.
    flags = "(?siu)" if any(char.isalpha() for char in re.sub("%.", "", fmt)) else "(?s)"
    return FormatPattern(rf"{flags}\A{regex}", directives)


def _week_fits(directives: str) -> bool:
    """Whether a week of the format, if any, is either complete or without effect."""
    has = lambda names: sum(name in directives for name in names)
    if has("GV"):
        return has("GV") == 2 and has("Aauw") == 1 and not has("UW") and not has("YyjmBbd")
    if has("UW") and has("Aauw") and not has("j"):
        return has("Aauw") == 1 and has("Yy") == 1
    return True


def python_repr(value: Column) -> Column:
    """The text Python prints for a string inside ``%r``."""
    text = value
    for char, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(shown))
    only_single = value.contains("'") & ~value.contains('"')
    single = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(only_single, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(single)


def with_strptime(df: DataFrame, source: str, fmt: str) -> DataFrame:
    """Add ``__wall`` (timestamp without zone), ``__utc_offset``, ``__error_class``, ``__error_value``.

    Either ``__wall`` or both error columns are set. ``__utc_offset`` is set only for formats that
    read an offset.
    """
    value = F.col("`" + source.replace("`", "``") + "`")
    pattern = format_pattern(fmt)
    if pattern is None:
        return _with_python(df, value, fmt)
    return (_with_parts if pattern.by_parts else _with_pattern)(df, value, fmt, pattern)


def _with_pattern(df: DataFrame, value: Column, fmt: str, pattern: FormatPattern) -> DataFrame:
    wall = F.regexp_replace(value, pattern.whole, f"{pattern.date_text} {pattern.time_text}")
    wall = wall.try_cast("timestamp_ntz")
    day = F.regexp_replace(value, pattern.whole, pattern.date_text).try_cast("date")
    if "y" in pattern.directives:
        late = F.year(wall) >= 2000 + CENTURY_PIVOT
        wall = F.when(late, wall - F.expr("INTERVAL '100' YEAR")).otherwise(wall)

    unmatched = F.concat(F.lit("time data "), python_repr(value), F.lit(f" does not match format {fmt!r}"))
    rest = F.regexp_replace(value, pattern.prefix, "")
    year_text = F.regexp_replace(value, pattern.whole, pattern.group("Y")) if "Y" in pattern.directives else F.lit("1")
    error = (
        F.when(F.col("__wall").isNotNull(), None)
        .when(value.isNull(), "strptime() argument 1 must be str, not None")
        .when(~value.rlike(pattern.prefix), unmatched)
        .when(rest != "", F.concat(F.lit("unconverted data remains: "), rest))
        .when(year_text == "", "year 0 is out of range")
        .when(day.isNull(), "day is out of range for month")
        .otherwise("second must be in 0..59")
    )
    kind = F.when(F.col("__wall").isNull(), F.when(value.isNull(), "TypeError").otherwise("ValueError"))
    return df.withColumn("__wall", wall).withColumns({
        "__utc_offset": F.lit(None).cast("string"), "__error_class": kind, "__error_value": error})


def _with_parts(df: DataFrame, value: Column, fmt: str, pattern: FormatPattern) -> DataFrame:
    has = lambda directive: directive in pattern.directives
    groups = [name for name in _GROUP.findall(pattern.named_whole) if name != "x"]
    parts = F.split(F.regexp_replace(value, pattern.whole, _BETWEEN.join(map(pattern.group, groups))), _BETWEEN)
    part = lambda directive: F.get("__parts", groups.index(directive))
    number = lambda directive, default: part(directive).try_cast("int") if has(directive) else F.lit(default)

    def numbered(directive: str, names: list[str]) -> Column:
        pairs = [F.lit(x) for i, name in enumerate(names) for x in (name if directive in "AB" else name[:3], i + 1)]
        return F.element_at(F.create_map(*pairs), F.lower(part(directive)))

    if has("y"):
        two = number("y", 0)
        year = two + F.when(two >= CENTURY_PIVOT, 1900).otherwise(2000)
    else:
        year = number("Y", 1900)
    month = next((numbered(name, MONTHS) for name in "Bb" if has(name)), number("m", 1))
    day = F.coalesce(number("d", 1), number("e", 1)) if has("d") else F.lit(1)
    hour = number("H", 0)
    if has("I"):
        late = F.when(F.lower(part("p")) == "pm", 12).otherwise(0) if has("p") else F.lit(0)
        hour = number("I", 0) % 12 + late
    micros = F.rpad(part("f"), 6, "0").try_cast("int") if has("f") else F.lit(0)
    second = number("S", 0)

    fits, rest = value.rlike(pattern.prefix), F.regexp_replace(value, pattern.prefix, "")
    day_of = lambda *ymd: F.try_make_timestamp_ntz(*ymd, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    date, week_error = day_of(year, month, day), F.lit(None).cast("string")
    if has("j"):
        date = F.date_add(day_of(year, F.lit(1), F.lit(1)), number("j", 1) - 1)
    elif any(map(has, "Aauw")) and any(map(has, "GUW")):
        weekday = next((numbered(name, WEEKDAYS) - 1 for name in "Aa" if has(name)), None)  # from Monday
        if weekday is None:
            weekday = number("u", 1) - 1 if has("u") else (number("w", 1) + 6) % 7
        if has("G"):
            iso, week = number("G", 1900), number("V", 1)
            weeks = F.weekofyear(day_of(iso, F.lit(12), F.lit(28)))
            fourth = day_of(iso, F.lit(1), F.lit(4))
            date = F.date_add(F.date_sub(fourth, F.weekday(fourth)), 7 * (week - 1) + weekday)
            week_error = (
                F.when(iso == 0, "Year is out of range: 0")
                .when((week < 1) | (week > weeks), F.concat(F.lit("Invalid week: "), week.cast("string"))))
        else:
            first = day_of(year, F.lit(1), F.lit(1))
            week = number("U", 1) if has("U") else number("W", 1)
            shift = 1 if has("U") else 0  # weeks begin on Sunday
            begins, within = (F.weekday(first) + shift) % 7, (weekday + shift) % 7
            date = F.date_add(first, F.when(week == 0, within - begins).otherwise((7 - begins) % 7 + 7 * (week - 1) + within))
        shown_year = F.year(date)
        week_error = F.coalesce(week_error, F.when((shown_year < 1) | (shown_year > 9999), F.concat(
            F.lit("year "), shown_year.cast("string"), F.lit(" is out of range"))))
    seconds = (second + micros / 1_000_000).cast("decimal(16,6)")
    moment = F.when(second < 60, F.try_make_timestamp_ntz(
        F.year("__date"), F.month("__date"), F.dayofmonth("__date"), hour, number("M", 0), seconds))

    if has("z"):
        z = part("z")
        plain = F.replace(z, F.lit(":"), F.lit(""))
        field = lambda start: F.coalesce(F.substring(plain, start, 2).try_cast("int"), F.lit(0))
        fraction = F.coalesce(F.rpad(F.split_part(z, F.lit("."), F.lit(2)), 6, "0").try_cast("int"), F.lit(0))
        size = (field(2) * 3600 + field(4) * 60 + field(6)).cast("long") * 1_000_000 + fraction
        offset = F.when(z == "Z", 0).otherwise(F.when(z.startswith("-"), -size).otherwise(size)).cast("long")
        wrong = (
            F.when(z.rlike(r"^.\d\d:\d\d\d"), F.concat(F.lit("Inconsistent use of : in "), z))
            .when(z.rlike(r"^.\d{4}:"), F.concat(F.lit("invalid literal for int() with base 10: '"), F.substring(z, 6, 2), F.lit("'"))))
    else:
        offset, wrong = F.lit(None).cast("long"), F.lit(None).cast("string")
    day_micros = SECONDS_PER_DAY * 1_000_000
    days, within = F.floor(F.col("__offset") / day_micros), F.pmod("__offset", F.lit(day_micros))
    shown = F.concat_ws(
        ", ", F.when(days != 0, F.concat(F.lit("days="), days.cast("string"))),
        F.when(within >= 1_000_000, F.concat(F.lit("seconds="), F.floor(within / 1_000_000).cast("string"))),
        F.when(within % 1_000_000 != 0, F.concat(F.lit("microseconds="), (within % 1_000_000).cast("string"))))
    too_far = F.abs("__offset") >= day_micros

    unmatched = F.concat(F.lit("time data "), python_repr(value), F.lit(f" does not match format {fmt!r}"))
    error = (
        F.when(value.isNull(), "strptime() argument 1 must be str, not None")
        .when(~fits, unmatched)
        .when(rest != "", F.concat(F.lit("unconverted data remains: "), rest))
        .when(wrong.isNotNull(), wrong)
        .when(F.lit(has("Y")) & (part("Y") == "" if has("Y") else F.lit(False)), "year 0 is out of range")
        .when(F.col("__week_error").isNotNull(), F.col("__week_error"))
        .when(F.col("__date").isNull(), "day is out of range for month")
        .when(too_far, F.concat(F.lit(
            "offset must be a timedelta strictly between -timedelta(hours=24) and timedelta(hours=24), not "
            "datetime.timedelta("), shown, F.lit(").")))
        .when(second >= 60, "second must be in 0..59"))
    kind = F.when(F.col("__error_value").isNotNull(), F.when(value.isNull(), "TypeError").otherwise("ValueError"))
    away = F.abs("__offset")
    clock = lambda micros, unit: F.lpad((F.floor(away / micros) % unit).cast("string"), 2, "0")
    utc_offset = F.concat(
        F.when(F.col("__offset") < 0, "-").otherwise("+"), clock(3_600_000_000, 24), F.lit(":"), clock(60_000_000, 60),
        F.when(away % 60_000_000 != 0, F.concat(F.lit(":"), clock(1_000_000, 60))).otherwise(""),
        F.when(away % 1_000_000 != 0, F.concat(F.lit("."), F.lpad((away % 1_000_000).cast("string"), 6, "0"))).otherwise(""))
    good = F.col("__error_value").isNull()
    return (
        df.withColumn("__parts", parts)
        .withColumns({"__date": date, "__offset": offset, "__week_error": week_error})
        .withColumn("__error_value", error)
        .withColumns({"__wall": F.when(good, moment), "__error_class": kind, "__utc_offset": F.when(good, utc_offset)})
        .drop("__date", "__offset", "__parts", "__week_error"))


def _with_python(df: DataFrame, value: Column, fmt: str) -> DataFrame:
    @F.pandas_udf("wall string, utc_offset string, error_class string, error_value string")
    def parse(values: pd.Series) -> pd.DataFrame:
        def one(text):
            try:
                moment = datetime.strptime(text, fmt)
            except Exception as error:
                return None, None, type(error).__name__, str(error)
            wall = moment.replace(tzinfo=None)
            offset = moment.isoformat()[len(wall.isoformat()):]
            return wall.isoformat(" "), offset or None, None, None

        rows = [one(text) for text in values.astype(object).where(values.notna(), None)]
        return pd.DataFrame(rows, columns=["wall", "utc_offset", "error_class", "error_value"], dtype=object)

    # Called non-deterministic so that Catalyst neither repeats it nor moves it past a filter.
    return (
        df.withColumn("__parsed", parse.asNondeterministic()(value))
        .withColumns({
            "__wall": F.col("__parsed.wall").cast("timestamp_ntz"),
            "__utc_offset": F.col("__parsed.utc_offset"),
            "__error_class": F.col("__parsed.error_class"),
            "__error_value": F.col("__parsed.error_value"),
        })
        .drop("__parsed")
    )
