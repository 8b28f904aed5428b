"""Session construction and the few session facts the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Same limit Spark applies by default before it broadcasts a side on its own.
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024


def build_session(app_name: str = "harborline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs expect; extra settings win over the defaults.

    Nothing here sizes the cluster: memory, cores and the shuffle partition count stay with the
    submitter. Adaptive execution merges small partitions and splits skewed ones at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Checkpoints that nothing refers to any more are removed.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; clusters that do not share that folder use ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that folder would sit on
    one machine and be lost with it.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="harborline-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and continue from that copy."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them from there, for facts used more than once.

    Unlike a checkpoint the copy is columnar: each reader gets only the columns it uses.
    """
    folder = f"{shared_dir(df.sparkSession).rstrip('/')}/harborline/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the optimizer's own size for the frame is within the broadcast limit.

    Exact for master data (local relations); files count with their size on disk.
    """
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint when the checked size allows it; otherwise Spark picks a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def per_key(dim: DataFrame, reduced: DataFrame, keys: str | list[str], limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``reduced`` (one row per key) restricted to the keys of ``dim``.

    ``dim`` holds each key once. The result then has exactly the rows of ``dim``, so the size check on
    ``dim`` also bounds it, even when ``reduced`` comes from a very large fact and has no usable size
    estimate.
    """
    keys = [keys] if isinstance(keys, str) else keys
    bounded = dim.select(*keys).join(reduced, on=keys, how="left")
    return F.broadcast(bounded) if fits_broadcast(dim, limit) else bounded


def as_array(df: DataFrame, *order: str):
    """A small option list as one array-of-structs value, for use as a column on other rows.

    This carries a fixed list onto every row without a join. Refuses lists past the limit.
    """
    if not fits_broadcast(df):
        raise ValueError("option list exceeds the broadcast limit; join on a key instead")
    columns = [*order, *(c for c in df.columns if c not in order)]
    return df.agg(F.sort_array(F.collect_list(F.struct(*columns)))).scalar()
