"""Incremental staging, atomic replacement, appends that happen once, keyed state and window risk on streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from harborline import schemas
from harborline.functions.ranking import last_seen
from harborline.operators import staging
from harborline.plans import incremental, microbatch
from harborline.sources import tables, writers
from harborline.sources.readers import message_stream
from harborline.streaming import queries, state
from tests.conftest import position


def land(root, minute, events, kind="ships"):
    folder = root / f"raw/{kind}/2026/03/26/{minute}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir()))}.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))


def fixes(minute, ships=40):
    return [position(f"ship-{i:03d}", f"2026-03-26T10:{minute:02d}:{i % 60:02d}", lat=float(minute)) for i in range(ships)]


def runs(spark, root):
    kind = {"spark": spark, "raw": f"{root}/raw", "as_of": "2026-03-27 00:00:00"}
    return microbatch.Run(base=f"{root}/inc", incremental=True, **kind), microbatch.Run(base=f"{root}/full", **kind)


def data_files(path, kind=".parquet"):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_size for at, _, names in os.walk(path) for f in names if f.endswith(kind)}


def test_a_second_run_reads_and_writes_only_what_is_new(spark, tmp_path):
    inc, full = runs(spark, tmp_path)
    for minute in range(5):
        land(tmp_path, f"10{minute:02d}", fixes(minute))
    assert incremental.stage_new_files(inc, "stg_ships")["lines"] == 200
    before = data_files(inc.path("stg_ships"))
    land(tmp_path, "1007", [position("ship-777", "2026-03-26T10:07:00"), *fixes(4, 2)])  # one new row, two repeated ones
    second = incremental.stage_new_files(inc, "stg_ships")
    assert second["lines"] == 3 and second["buckets"] <= 3
    added = set(data_files(inc.path("stg_ships"))) - set(before)
    assert len([f for f in added if "_bucket=" in f]) == second["buckets"]  # buckets not touched were not written
    assert incremental.stage_new_files(inc, "stg_ships") == {"lines": 0, "buckets": 0}
    full.write(staging.stage_ships(full.raw_lines("ships", schemas.SHIP_POSITION)), "stg_ships")
    assert sorted(map(repr, inc.read("stg_ships").collect())) == sorted(map(repr, full.read("stg_ships").select(*inc.read("stg_ships").columns).collect()))
    assert inc.read("stg_ships").count() == 201


def test_batches_in_any_order_give_the_rows_of_a_full_run(spark, tmp_path):
    inc, full = runs(spark, tmp_path)
    for minute in (3, 1, 2):
        events = fixes(minute, 9) + [position("ship-001", "2026-03-26T10:00:00", lat=float(10 - minute))]  # one key, three values
        land(tmp_path, f"10{minute:02d}", events)
        incremental.stage_new_files(inc, "stg_ships", files_per_batch=1, buckets=4)
    full.write(staging.stage_ships(full.raw_lines("ships", schemas.SHIP_POSITION)), "stg_ships")
    got = incremental.staged_table(inc, "stg_ships", 4).read()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, full.read("stg_ships").select(*got.columns).collect()))


def test_a_batch_merged_again_writes_the_same_rows(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v int").schema
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], schema, 4)
    total = lambda rows: rows.groupBy("k").agg(F.max("v").cast("int").alias("v"))
    table.merge(spark.createDataFrame([(i, 1) for i in range(20)], schema), "a-0", total)
    for _ in range(2):
        table.merge(spark.createDataFrame([(3, 5), (30, 2)], schema), "a-1", total)
    table.merge(spark.createDataFrame([(4, 9)], schema), "b-0", total)
    want = {i: 1 for i in range(20)} | {3: 5, 30: 2, 4: 9}
    assert {r.k: r.v for r in table.read().collect()} == want
    table.vacuum(keep=1)
    assert {r.k: r.v for r in table.read().collect()} == want
    # a merge that fails half way leaves the table as it was
    with pytest.raises(Exception, match="boom"):
        table.merge(spark.createDataFrame([(5, 100)], schema), "c-0", lambda rows: rows.withColumn("v", F.raise_error(F.lit("boom")).cast("int")))
    assert {r.k: r.v for r in table.read().collect()} == want


def test_readers_see_the_old_rows_while_a_write_fails(spark, tmp_path):
    writers.create_database(spark, "harborline_swap")
    try:
        name, path = "harborline_swap.t", str(tmp_path / "t")
        rows = spark.createDataFrame([("01", 1), ("02", 2)], "dt string, v int")
        writers.overwrite_table(rows, name, path, partition_by=["dt"])
        assert spark.table(name).schema["dt"].dataType.simpleString() == "string"
        with pytest.raises(Exception, match="boom"):
            writers.overwrite_table(rows.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("boom")).cast("int")).otherwise(7)), name, path)
        assert {(r.dt, r.v) for r in spark.table(name).collect()} == {("01", 1), ("02", 2)}
        writers.overwrite_table(spark.table(name).withColumn("v", F.col("v") + 10).withColumn("w", F.lit(0.5)), name, path)  # reads what it replaces
        assert {(r.dt, r.v, r.w) for r in spark.table(name).collect()} == {("01", 11, 0.5), ("02", 12, 0.5)}
    finally:
        spark.sql("DROP DATABASE harborline_swap CASCADE")


def test_a_failed_stage_leaves_the_last_good_table(spark, tmp_path):
    run = microbatch.Run(spark, f"{tmp_path}/raw", f"{tmp_path}/base", "2026-03-27 00:00:00")
    run.write(spark.range(3), "t")
    with pytest.raises(Exception, match="boom"):
        run.write(spark.range(3).select(F.raise_error(F.lit("boom")).alias("id")), "t")
    assert run.read("t").count() == 3
    run.write(run.read("t").filter("id > 0"), "t")
    assert run.read("t").count() == 2


def test_the_same_batch_twice_appends_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    for token, n in (("a", 3), ("b", 2), ("a", 3), ("a", 3)):
        tables.append_once(spark.range(n), path, token)
    assert tables.appended(spark, path).count() == 5 and tables.appended(spark, path).columns == ["id"]


# ---- Keyed state -----------------------------------------------------------------------------------

SCHEMA = "ship_id string, event_ts timestamp, event_id long, v double"
ORDER = ["event_ts", "event_id"]


def write_rows(spark, folder, rows):
    frame = spark.createDataFrame(rows, "ship_id string, ts string, event_id long, v double")
    frame.withColumn("event_ts", F.col("ts").cast("timestamp")).select("ship_id", "event_ts", "event_id", "v").coalesce(1).write.mode("append").parquet(folder)


def go(spark, folder, base, version=1):
    rows = message_stream(spark, folder, "parquet", schema=spark.createDataFrame([], SCHEMA).schema, per_trigger=1)
    query = state.newest_rows_query(rows, base, queries.checkpoint_path(base, "state", version), ["ship_id"], ORDER)
    query.awaitTermination()
    return query


def test_late_and_repeated_rows_change_nothing(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [("s1", "2026-01-01 10:00", 1, 1.0), ("s2", "2026-01-01 10:00", 2, 2.0), ("s3", None, 3, 3.0)],
        [("s1", "2026-01-01 09:00", 4, 9.0), ("s2", "2026-01-01 10:00", 2, 2.0)],  # late, repeated
        [("s1", "2026-01-01 11:00", 5, 5.0), ("s3", "2026-01-01 08:00", 6, 6.0), ("s1", "2026-01-01 11:00", 4, 0.0)],
    ]
    for rows in batches:
        write_rows(spark, folder, rows)
        go(spark, folder, base)
    everything = spark.read.parquet(folder)
    want = last_seen(everything, ["ship_id"], *ORDER[:1], ORDER[1:])
    assert sorted(state.read_newest(spark, base, ["ship_id"], ORDER).collect()) == sorted(want.collect())
    written = [r.n for r in spark.read.parquet(f"{base}/changes").groupBy("batch").agg(F.count("*").alias("n")).orderBy("batch").collect()]
    assert written == [3, 2]  # the batch without news wrote nothing


def test_what_a_batch_writes_does_not_grow_with_the_state(spark, tmp_path):
    sizes = []
    for ships in (50, 2000):
        folder, base = str(tmp_path / f"in{ships}"), str(tmp_path / f"out{ships}")
        write_rows(spark, folder, [(f"s{i}", "2026-01-01 10:00", i, 1.0) for i in range(ships)])
        go(spark, folder, base)
        before = data_files(base, "")
        write_rows(spark, folder, [(f"s{i}", "2026-01-01 11:00", i, 2.0) for i in range(5)])
        go(spark, folder, base)
        sizes.append(sum(size for f, size in data_files(base, "").items() if f not in before))
    assert sizes[1] < 1.2 * sizes[0], sizes  # rows, state and log together


def test_a_new_checkpoint_takes_over_the_state(spark, tmp_path):
    folder, base = str(tmp_path / "a"), str(tmp_path / "out")
    write_rows(spark, folder, [("s1", "2026-01-01 10:00", 1, 1.0), ("s2", "2026-01-01 10:00", 2, 2.0)])
    go(spark, folder, base)
    other = str(tmp_path / "b")
    write_rows(spark, other, [("s1", "2026-01-01 09:00", 3, 3.0), ("s2", "2026-01-01 12:00", 4, 4.0)])
    for _ in range(2):  # and a restart of the new one
        go(spark, other, base, version=2)
    assert {r.ship_id: r.v for r in state.read_newest(spark, base, ["ship_id"], ORDER).collect()} == {"s1": 1.0, "s2": 4.0}
    changes = spark.read.parquet(f"{base}/changes").filter("batch like 'state-v2%'").collect()
    assert [(r.ship_id, r.v) for r in changes] == [("s2", 4.0)]  # the late row of s1 met the state it was handed
