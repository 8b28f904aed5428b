"""The newest row per key as keyed streaming state: every batch reads and writes only the keys it holds.

The state lives in the checkpoint. A batch emits the keys whose newest row changed, and these changes are appended once. A table of
the newest rows is read from the changes, or from the last snapshot and the changes since. A query with a new checkpoint takes the
table of the one before as its initial state.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from harborline.functions.ranking import last_seen
from harborline.session import package_on_workers
from harborline.sources.tables import append_once, appended, folder, names_in, replace_rows
from harborline.streaming.queries import MICRO_BATCH, run_name, start_batches

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch checkpoints what it changed, not the files of the store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_RANK = "_rank_"


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with what they are ordered by; times as numbers, which compare alike wherever they come from."""
    def plain(name: str):
        kind = rows.schema[name].dataType
        return F.unix_micros(F.col(name).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(name)

    return rows.withColumns({f"{_RANK}{i}": plain(c) for i, c in enumerate(order)})


class NewestRow(StatefulProcessor):
    """Keeps the row of each key that ranks highest, nulls lowest; emits it when it changed."""

    def __init__(self, schema: T.StructType, ttl_ms: int | None):
        self._schema, self._ttl_ms = schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getValueState("newest", self._schema, self._ttl_ms)

    def _rank(self, row: Sequence) -> tuple:
        values = [v for name, v in zip(self._schema.names, row) if name.startswith(_RANK)]
        return tuple((False, 0) if v is None else (True, v) for v in values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self._newest.get() if self._newest.exists() else None
        best = max((tuple(row[c] for c in self._schema.names) for row in rows), key=self._rank)
        if kept is None or self._rank(best) > self._rank(kept):
            self._newest.update(best)
            yield Row(*self._schema.names)(*best)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._newest.update(tuple(initialState[c] for c in self._schema.names))


def newest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], initial: DataFrame | None = None,
                ttl_ms: int | None = None) -> DataFrame:
    """Stream of the newest rows by key, each time they change. Late and repeated rows change nothing.

    With ``ttl_ms`` a key that is not updated for so long is forgotten; its next row counts as the newest, whatever its time.
    """
    package_on_workers(rows.sparkSession)
    ranked = _ranked(rows, order)
    newest = ranked.groupBy(*keys).transformWithState(
        NewestRow(ranked.schema, ttl_ms), ranked.schema, "Update", "ProcessingTime" if ttl_ms else "None",
        initialState=None if initial is None else _ranked(initial.select(*rows.columns), order).groupBy(*keys),
    )
    return newest.select(*rows.columns)


def newest_rows_query(rows: DataFrame, base: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], ttl_ms: int | None = None,
                      trigger: Mapping[str, object] = MICRO_BATCH) -> StreamingQuery:
    """Keep the newest row per key under ``base``; a first start of a checkpoint takes over what is there already."""
    spark = rows.sparkSession
    run = run_name(checkpoint)
    given = [n.rsplit(".", 1)[1] for n in names_in(spark, f"{base}/initial") if n.startswith(f"{run}.")]
    if names_in(spark, checkpoint):  # a restart keeps the snapshot it began with
        snapshot = f"{base}/snapshot/{given[0]}" if given else None
    else:
        snapshot = compact(spark, base, keys, order)
        if snapshot:
            files, note = folder(spark, f"{base}/initial/{run}.{snapshot.rsplit('/', 1)[1]}")
            files.create(note).close()
    initial = spark.read.schema(rows.schema).parquet(snapshot) if snapshot else None
    # What keyed state needs; a running query keeps the settings it began with.
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return start_batches(
            newest_rows(rows, keys, order, initial, ttl_ms), lambda batch, i: append_once(batch, f"{base}/changes", f"{run}-{i:09d}"),
            checkpoint, trigger, mode="update",
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_newest(spark: SparkSession, base: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key, from the changes of all batches."""
    return last_seen(appended(spark, f"{base}/changes"), keys, order[0], order[1:])


def compact(spark: SparkSession, base: str, keys: Sequence[str], order: Sequence[str]) -> str | None:
    """Write the newest rows as a snapshot and return its path; None when nothing was written yet."""
    if not names_in(spark, f"{base}/changes"):
        return None
    return replace_rows(read_newest(spark, base, keys, order), f"{base}/snapshot", keep=3)
