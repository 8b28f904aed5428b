"""Tables that change without a moment in which readers see half of it: replaced as a whole, merged by bucket, appended once.

All three write new folders first and say afterwards which folders count. A writer that fails or loses an executor leaves folders
that nobody reads, and a batch that is written again writes the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- Versioned folders ---------------------------------------------------------------------------
# A version is complete once Spark wrote its _SUCCESS marker. Readers take the newest complete one.


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop objects."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, root = folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []


def _versions(spark: SparkSession, base: str) -> list[int]:
    """All versions begun, complete or not."""
    return sorted(int(n.split("=", 1)[1]) for n in names_in(spark, base) if n.startswith("version="))


def complete_versions(spark: SparkSession, base: str) -> list[int]:
    return [v for v in _versions(spark, base) if "_SUCCESS" in names_in(spark, version_path(base, v))]


def version_path(base: str, version: int) -> str:
    return f"{base}/version={version:012d}"


def read_latest_version(spark: SparkSession, base: str, before: int | None = None) -> DataFrame | None:
    versions = [v for v in complete_versions(spark, base) if before is None or v < before]
    return spark.read.parquet(version_path(base, versions[-1])) if versions else None


def version_for(spark: SparkSession, base: str, origin: str) -> int:
    """Version that the batch ``origin`` writes: the one it was given before, or the next after all given so far.

    The choice is noted as an empty file before anything is written, so a replay finds it.
    """
    given = {}
    for note in names_in(spark, f"{base}/_origins"):
        name, version = note.rsplit(".", 1)
        given[name] = int(version)
    if origin not in given:
        given[origin] = max([*given.values(), *complete_versions(spark, base), -1]) + 1
        files, note = folder(spark, f"{base}/_origins/{origin}.{given[origin]}")
        files.create(note).close()
    return given[origin]


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Remove complete versions older than the newest ``keep``."""
    for version in complete_versions(spark, base)[:-keep]:
        files, path = folder(spark, version_path(base, version))
        files.delete(path, True)


# ---- Replaced as a whole -------------------------------------------------------------------------


def replace_rows(df: DataFrame, base: str, keep: int = 2) -> str:
    """Write the rows as a new version of a folder and return its path. Readers see it once it is complete.

    The rows may come from the version they replace. The last ``keep`` versions stay for readers that began before.
    """
    target = version_path(base, max(_versions(df.sparkSession, base), default=-1) + 1)
    df.write.parquet(target)
    drop_old_versions(df.sparkSession, base, keep)
    return target


def replace_table(df: DataFrame, table: str, base: str, partition_by: Sequence[str] = (), keep: int = 2) -> None:
    """Replace a catalog table: a new version is written in full, then the catalog points to it in one step.

    Every version is an external table of its own, ``<table>__v<number>``, and the pointer a view on the newest. Until the
    switch, and if the write fails, readers get the old rows.
    """
    spark = df.sparkSession
    version = max(_versions(spark, base), default=-1) + 1
    of = lambda v: f"{table}__v{v}"
    spark.sql(f"DROP TABLE IF EXISTS {of(version)}")  # of a write that failed after its folder was removed
    df.write.partitionBy(*partition_by).option("path", version_path(base, version)).saveAsTable(of(version))
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")  # from before tables were versioned
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {of(version)}")
    for old in complete_versions(spark, base)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {of(old)}")
    drop_old_versions(spark, base, keep)


# ---- Appended once -------------------------------------------------------------------------------

BATCH = "batch"


def append_once(df: DataFrame, path: str, token: str) -> None:
    """Append the rows of the batch ``token``; the same batch again replaces its own rows and no others."""
    rows = df.withColumn(BATCH, F.lit(token))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def appended(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All appended rows, without the batch they came in."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).drop(BATCH)


# ---- Merged by bucket ----------------------------------------------------------------------------


@dataclass(frozen=True)
class BucketedTable:
    """Rows in buckets by key. A merge reads and writes only the buckets that its rows fall into.

    Every merge is a version. Its manifest, as many rows as there are buckets at most, says which version each bucket has.
    """

    spark: SparkSession
    base: str
    keys: Sequence[str]
    schema: T.StructType
    buckets: int = 64

    def _manifest(self, before: int | None = None) -> dict[int, int]:
        found = read_latest_version(self.spark, f"{self.base}/manifest", before)
        return {r["bucket"]: r["version"] for r in found.collect()} if found is not None else {}

    def _path(self, bucket: int, version: int) -> str:
        return f"{version_path(f'{self.base}/data', version)}/_bucket={bucket}"

    def _rows(self, manifest: Mapping[int, int]) -> DataFrame:
        paths = [self._path(b, v) for b, v in sorted(manifest.items())]
        # A folder named in full has no partition column, so only the rows' own columns come back.
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._rows(self._manifest())

    def merge(self, rows: DataFrame, origin: str, pick: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Merge the batch ``origin``: ``pick`` reduces old and new rows of a key. Returns the buckets that were written.

        ``pick`` must not depend on the order in which batches come. A batch merged again starts from the same older
        version, so it writes the same rows.
        """
        version = version_for(self.spark, f"{self.base}/manifest", origin)
        manifest = self._manifest(before=version)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        touched = sorted(r[0] for r in rows.select(bucket).distinct().collect())  # bounded by the number of buckets
        old = self._rows({b: v for b, v in manifest.items() if b in touched})
        merged = pick(old.unionByName(rows.select(*self.schema.names))).withColumn("_bucket", bucket)
        merged.write.mode("overwrite").partitionBy("_bucket").parquet(version_path(f"{self.base}/data", version))
        now = {**manifest, **dict.fromkeys(touched, version)}
        entries = self.spark.createDataFrame(list(now.items()), "bucket int, version long")
        entries.coalesce(1).write.mode("overwrite").parquet(version_path(f"{self.base}/manifest", version))
        return touched

    def vacuum(self, keep: int = 2) -> None:
        """Remove what none of the newest ``keep`` versions needs."""
        versions = complete_versions(self.spark, f"{self.base}/manifest")[-keep:]
        needed = {(v, f"_bucket={b}") for at in versions for b, v in self._manifest(before=at + 1).items()}
        for version in complete_versions(self.spark, f"{self.base}/data"):
            for name in names_in(self.spark, version_path(f"{self.base}/data", version)):
                if version < versions[-1] and name.startswith("_bucket=") and (version, name) not in needed:
                    files, path = folder(self.spark, f"{version_path(f'{self.base}/data', version)}/{name}")
                    files.delete(path, True)
        drop_old_versions(self.spark, f"{self.base}/manifest", keep)
