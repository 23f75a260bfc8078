"""The given tables, and batches of texts in Arrow."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillroll.scratch import working_folder

BATCH_BYTES = 4 << 20

# What separates words in the contracts of the queries (a space, and \x09 to \x0D).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared working folder, closely compressed as it holds texts."""
    path = working_folder(df.sparkSession) + "/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as they may start anywhere."""
    name, context = "tillroll-code.zip", spark.sparkContext
    if not any(path.endswith(name) for path in context.listFiles):
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="tillroll-")) / name.removesuffix(".zip")
        context.addPyFile(shutil.make_archive(str(archive), "zip", root, "tillroll"))


def map_batches(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``rows``, from columns as lists to columns as lists, to each Arrow batch of ``df``.

    Batches are cut to about ``BATCH_BYTES``, a row at least, so that what a task holds does not grow with the texts
    that a batch of Spark's happens to have.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    share_code(df.sparkSession)
    target = to_arrow_schema(_parse_datatype_string(schema))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, whole.num_rows * BATCH_BYTES // max(whole.nbytes, 1))
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                found = rows({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [found[f.name] if isinstance(found[f.name], pa.Array) else pa.array(found[f.name], f.type)
                     for f in target], schema=target)

    return df.mapInArrow(mapped, schema)
