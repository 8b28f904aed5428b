"""Reading the tables, run folders in the shared folder, and text in Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harborline.session import shared_dir

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_SLICE_ROWS = 256
_BATCH_SETTING, _BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1024


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if that folder exists on their machine.

    Clusters that do not share it get the package with ``--py-files``. Texts are long, so Arrow batches get fewer rows than
    usual, unless the session says otherwise.
    """
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(_BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to a new folder in the shared folder and read them from there.

    Cuts the lineage: a lost executor costs nothing written here, and later readers get only the columns they use.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def stored_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stored``, and the number of rows, counted by the job that writes them."""
    seen = Observation()
    rows = stored(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return rows, seen.get.get("rows", 0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = _SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of few rows, so that the Python objects of a batch stay few."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def width(spark: SparkSession) -> int:
    """Number of partitions the session shuffles to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
