"""Staging that reads only what is new: a ledger of consumed files, and merges into the buckets that the new rows touch.

The file source with a checkpoint is the ledger. A scheduled run takes the files that came since the last one, in one or more
batches, and stops. A batch that failed is read again, by the same files, and merged under the same version. Lines that a landing
stream wrote twice, because an attempt of its own failed, have one key and are one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline import schemas
from harborline.functions.ranking import first_per
from harborline.operators import staging
from harborline.session import written
from harborline.sources.readers import message_stream
from harborline.sources.tables import BucketedTable, names_in
from harborline.streaming.queries import checkpoint_path, run_name, start_batches

#: Staged table: landing kind, keys, raw schema, and the step from parsed lines to staged rows.
STAGED = {
    "stg_ships": ("ships", staging.SHIP_KEYS, schemas.SHIP_POSITION, staging.stage_ships),
    "stg_alerts_clima": ("clima", staging.ALERT_KEYS, schemas.GLOBAL_ALERT, staging.stage_alerts),
    "stg_alerts_noticias": ("noticias", staging.ALERT_KEYS, schemas.GLOBAL_ALERT, staging.stage_alerts),
}


def staged_table(run, name: str, buckets: int = 64) -> BucketedTable:
    _, keys, raw, stage = STAGED[name]
    empty = run.spark.createDataFrame([], schemas.with_lineage(raw))
    return BucketedTable(run.spark, run.path(name), keys, T.StructType(stage(empty).schema.fields), buckets)


def _first_by_value(keys: list[str], raw: T.StructType) -> Callable[[DataFrame], DataFrame]:
    """The same choice among rows of one key as in a full run, whatever batches they came in."""
    rest = [c for c in schemas.with_lineage(raw).names if c not in keys]
    return lambda rows: first_per(rows, keys, [F.col(c).asc_nulls_last() for c in rest])


def stage_new_files(run, name: str, files_per_batch: int | None = None, buckets: int = 64) -> dict[str, int]:
    """Stage what landed since the last call; returns the lines read and the buckets written."""
    kind, keys, raw, stage = STAGED[name]
    root = f"{run.raw}/kind={kind}" if run.landed else f"{run.raw}/{kind}"
    done = {"lines": 0, "buckets": 0}
    if not names_in(run.spark, root):
        return done
    table, pick = staged_table(run, name, buckets), _first_by_value(keys, raw)
    checkpoint = checkpoint_path(run.base, f"stage-{name}")
    source = root if run.landed else f"{root}/{run.raw_glob}"
    lines = message_stream(run.spark, source, "text", per_trigger=files_per_batch).select("value")
    parsed = staging.parse_json(lines, schemas.with_lineage(raw))

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Written once, since the merge looks at the rows twice: the files are read a single time.
        touched = table.merge(written(stage(batch)), f"{run_name(checkpoint)}-{batch_id}", pick)
        done["buckets"] += len(touched)

    query = start_batches(parsed, merge, checkpoint, skip_empty=False)
    query.awaitTermination()
    done["lines"] = sum(p.numInputRows for p in query.recentProgress)
    if done["buckets"]:
        table.vacuum()
    return done


def raw_to_staging(run, files_per_batch: int | None = None) -> dict[str, dict[str, int]]:
    return {name: stage_new_files(run, name, files_per_batch) for name in STAGED}
