"""From raw rows and the shop mapping to valid receipts, errors and shop ids."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.receipts import (
    date_error, info_json, quoted, receipt_code, shop_error, with_dttm)
from tillroll.operators.lookup import BROADCAST_BYTES, join_lookup, measured_bytes
from tillroll.operators.mapping import map_shops
from tillroll.operators.row_index import PLACES_BYTES, ROWS_PER_TASK, rank_by_counting, with_row_index
from tillroll.scratch import materialise


@dataclass(frozen=True)
class ReceiptConfig:
    """Parameters of one job; the names are those of the job's configuration.

    The fields after ``separated_file_for_each_shop`` are additions. ``rank`` says how failed rows get their numbers:
    ``"counting"`` finds them without a sort of the others, ``"auto"`` does so only where a file has more than
    ``rows_per_task`` rows; both sort where the places of the failed rows take more than ``places_bytes``.
    """

    columns: list[str]
    system_code: str
    data_type: str
    shop_num_column_name: str
    dt_or_dttm_column_name: str
    dt_or_dttm_format: str
    filename_fmt: str = ""
    dt_from: str = ""
    dt_to: str = ""
    fix_date: bool = False
    receipt_code_columns: list[str] | None = None
    separated_file_for_each_shop: bool = False
    code_hash: str = "hash"
    broadcast_bytes: int = BROADCAST_BYTES
    rows_per_task: int = ROWS_PER_TASK
    places_bytes: int = PLACES_BYTES
    rank: str = "auto"
    csv_options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if len(set(self.columns)) != len(self.columns):
            raise ValueError("column names must differ")
        if self.rank not in ("auto", "counting"):
            raise ValueError(f"rank must be 'auto' or 'counting', not {self.rank!r}")


def stage(raw: DataFrame, mapping: DataFrame, cfg: ReceiptConfig) -> DataFrame:
    """Raw rows with all that the outputs need.

    ``raw`` has the configured columns, ``__dt`` and ``__file_name``. The result adds
    ``receipt_code`` and columns of a ``__`` prefix, so no raw column is overwritten, except one that
    is itself called ``receipt_code``. No row is shuffled while the mapping is small enough to broadcast.
    """
    coded = raw.withColumn(
        "receipt_code", receipt_code(cfg.columns, cfg.receipt_code_columns, cfg.code_hash))
    mapped = map_shops(coded, mapping, cfg.shop_num_column_name, cfg.broadcast_bytes)
    return with_dttm(mapped, cfg.dt_or_dttm_column_name, cfg.dt_or_dttm_format, "__dt", cfg.fix_date)


def valid(staged: DataFrame, cfg: ReceiptConfig, as_of: datetime | None = None) -> DataFrame:
    """Receipts with a shop and a time. ``as_of`` (default now) fills both bookkeeping times."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(" ")).cast("timestamp")
    return staged.filter(_is_valid()).select(
        F.col("receipt_code").alias("code"),
        F.col("__dttm").alias("dttm"),
        stamp.alias("dttm_added"),
        stamp.alias("dttm_modified"),
        F.lit(0).alias("version"),
        F.col("__shop_id").alias("shop_id"),
        F.col("__dt").alias("dt"),
        F.lit(cfg.data_type).alias("data_type"),
        info_json(cfg.columns).alias("info"),
    )


def errors(staged: DataFrame, cfg: ReceiptConfig, written: bool = False) -> DataFrame:
    """One ``Error`` per failed check; a row without shop and without time gives two.

    ``written`` says that ``staged`` reads a table and may be read again at little cost.
    """
    return daily_errors(staged, cfg, written).select("Error")


def shop_ids(staged: DataFrame) -> DataFrame:
    """The shop of every mapped row, valid or not, duplicates kept."""
    return daily_shop_ids(staged).select("shop_id")


def counts(staged: DataFrame) -> DataFrame:
    """Rows read, errors, receipts and mapped rows per day, in one pass."""
    unmapped, undated = F.col("__shop_id").isNull(), ~F.col("__dated")
    return staged.groupBy(F.col("__dt").alias("dt")).agg(
        F.count_if(F.col("__copy") == 1).alias("raw_rows"),
        (F.count_if(unmapped) + F.count_if(undated)).alias("error_rows"),
        F.count_if(_is_valid()).alias("valid_rows"), F.count_if(~unmapped).alias("mapped_rows"))


def day_kinds(first: date, days: int) -> Column:
    """An aggregate that can be observed while staged rows are written: how many rows there are of each kind and day.

    A day has eight kinds of rows, which ``day_counts`` adds up. The histogram has a bin for each, hence is exact.
    """
    kind = sum(F.when(flag, bit).otherwise(0) for bit, flag in (
        (1, F.col("__copy") == 1), (2, F.col("__shop_id").isNull()), (4, ~F.col("__dated"))))
    return F.histogram_numeric(8 * F.datediff(F.col("__dt"), F.lit(first)) + kind, F.lit(8 * max(days, 1)))


def day_counts(kinds: list) -> dict[int, dict[str, int]]:
    """The numbers of ``counts`` by the day's place in the range, from what ``day_kinds`` found."""
    found: dict[int, dict[str, int]] = {}
    for kind, rows in ((int(bin_["x"]), int(bin_["y"])) for bin_ in kinds or []):
        day = found.setdefault(kind // 8, dict.fromkeys(("raw_rows", "error_rows", "valid_rows", "mapped_rows"), 0))
        unmapped, undated = bool(kind & 2), bool(kind & 4)
        day["raw_rows"] += rows * (kind & 1)
        day["error_rows"] += rows * (unmapped + undated)
        day["valid_rows"] += rows * (not unmapped and not undated)
        day["mapped_rows"] += rows * (not unmapped)
    return found


def daily_shop_ids(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("__shop_id").isNotNull()).select(
        F.col("__dt").alias("dt"), F.col("__shop_id").alias("shop_id"))


def daily_errors(
    staged: DataFrame, cfg: ReceiptConfig, written: bool = False, largest: int | None = None
) -> DataFrame:
    """``Error`` and ``dt``. No file has more than ``largest`` rows, which are counted unless given."""
    if not written:
        # One pass over the source for both kinds of errors.
        kept = ["__dt", "__file_name", "__copy", "__copies", "__dated", "__shop_id", "__error_class", "__error_value"]
        staged, written = materialise(staged.select(*kept, *map(quoted, cfg.columns))), True
    unmapped = staged.filter(F.col("__shop_id").isNull()).select(
        F.col("__dt").alias("dt"), shop_error(quoted(cfg.shop_num_column_name)).alias("Error"))
    undated = (
        indexed_rejects(staged, cfg, written, largest)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
        .select(
            F.col("__dt").alias("dt"),
            date_error(
                F.col("__error_class"), F.col("__error_value"), F.col("__file_name"), F.col("__index")
            ).alias("Error"))
    )
    return unmapped.unionByName(undated)


def tie_key(columns: list[str]) -> Column:
    """A hash of the columns that tells nulls from empty texts, and where one value ends."""
    values = [F.when(quoted(name).isNull(), "-").otherwise(
        F.concat(F.octet_length(quoted(name)).cast("string"), F.lit(":"), quoted(name))) for name in columns]
    return F.unhex(F.md5(F.concat(*values, F.lit(""))))


def indexed_rejects(
    staged: DataFrame, cfg: ReceiptConfig, written: bool = False, largest: int | None = None
) -> DataFrame:
    """The rows whose time failed, with ``__index`` counted over all rows of their file.

    Rows are numbered by the first raw column. Ties, which may be numbered in any order, are settled by
    ``tie_key`` of the other columns, so that 16 bytes per row are sorted instead of the whole row, and only
    equal rows are exchangeable. Unless ``staged`` is ``written``, these few columns are, once. Only files with
    a failed time are sorted, and none where the failed rows are ranked by counting.
    """
    first, *others = cfg.columns
    file = ["__dt", "__file_name"]
    order = ["__first_value", "__tie"]
    rows = staged.filter(F.col("__copy") == 1).select(
        *file, quoted(first).alias("__first_value"), tie_key(others).alias("__tie"), "__copies",
        (~F.col("__dated")).alias("__rejected"), "__error_class", "__error_value")
    if not written:
        rows = materialise(rows)
    if largest is None:
        largest = rows.groupBy(*file).count().agg(F.max("count").alias("rows")).first()["rows"] or 0
    if cfg.rank == "counting" or largest > cfg.rows_per_task:
        ranked = rank_by_counting(rows, "__rejected", file, order, cfg.places_bytes, max(cfg.rows_per_task, 1))
        if ranked is not None:
            return ranked
    files = materialise(rows.filter("__rejected").select(*file).distinct())
    size = measured_bytes(files)
    affected = join_lookup(rows, files, file, "left_semi", cfg.broadcast_bytes, size)
    indexed = with_row_index(
        affected, file, order, largest, cfg.rows_per_task, written=size <= cfg.broadcast_bytes)  # then it is a filter over a table
    return indexed.filter(F.col("__rejected"))


def _is_valid() -> Column:
    return F.col("__shop_id").isNotNull() & F.col("__dated")
