"""Repeated byte strings by names of ever longer strings: which bytes lie in a string of ``length`` bytes that starts elsewhere too.

Every window of ``length`` bytes has one anchor: the leftmost place of the smallest hash among its short substrings, the same
place in equal windows. The windows of one anchor follow each other; together they are its context. Contexts are named by
hash and compared in levels, each of which sees only what the one before could not settle:

1. an anchor whose substring occurs once: none of its windows is repeated;
2. a context that occurs twice or more: all its windows are repeated;
3. different contexts with one substring are cut, and the two rules above hold again for the longer substring that all windows
   of a cut have in common, and for the cut; the last cuts are single windows.

Every level counts by key with partial sums and then joins the counts, so no group of rows has to meet in one task, whatever a
substring's share of the corpus, and a passage that a third of all documents share is a few rows a task. A context that occurs
more than once goes to the next level once. Names are two 64-bit hashes. See the README for why names take the place of an
external suffix array here.

Defined results: a null text counts as empty; null ids are kept; repeated rows and copies are repeats of each other; texts shorter
than ``length`` lose nothing and are no repeat; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, stored, texts

LENGTH = 200
SEED_LENGTH = 32
#: A unit is cut into this many at each further level.
FAN = 4
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_UNIT = {"row": pa.int64(), "at": pa.int32(), "before": pa.int16(), "behind": pa.int16(), "times": pa.int64(), "data": pa.binary()}
_UNIT_SCHEMA = "row long, at int, before short, behind short, times long, data binary"
_STARTS = ("row", "at - before as start", "at - behind as last")


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


class Names:
    """Hashes of any substrings of one text, from running sums of its bytes' values."""

    _powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def __init__(self, data: bytes, table: int = 0):
        n = len(data)
        with np.errstate(over="ignore"):
            up, down = Names._powers
            if len(up) <= n:
                size = 1 << (n + 1).bit_length()
                steps = np.full(size, _BASE), np.full(size, _BACK)
                for s in steps:
                    s[0] = 1
                up, down = Names._powers = tuple(np.multiply.accumulate(s) for s in steps)
            values = _TABLE[table][np.frombuffer(data, dtype=np.uint8)]
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:n], dtype=np.uint64)])
            self._down = down

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self._sums[end] - self._sums[start]) * self._down[start])


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Smallest or largest value of every ``width`` neighbours."""
    n = len(values)
    fill = -n % width
    blocks = np.concatenate([values, np.repeat(values[-1:], fill)]).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - width + 1], ahead[width - 1: n])


def anchors(names: Names, n: int, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``at, key, first, last``: anchors, the names of the substrings there, and the first and last start of their windows."""
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    at = np.arange(n - seed + 1)
    value = names.of(at, at + seed)
    width = length - seed + 1
    least = _sliding(value, width, np.minimum)
    # runs of neighbouring windows with one smallest value
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    ends = np.concatenate([starts[1:] - 1, [len(least) - 1]])
    kinds, rank = np.unique(least[starts], return_inverse=True)
    spot = np.minimum(np.searchsorted(kinds, value), len(kinds) - 1)
    places = np.flatnonzero(kinds[spot] == value)
    step = n + 1
    order = np.sort(spot[places] * step + places)
    low, high = np.searchsorted(order, rank * step + starts), np.searchsorted(order, rank * step + ends + width)
    # of several places with that value in a run, each has the windows from behind the one before up to itself
    run = np.repeat(np.arange(len(starts)), high - low)
    index = np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[run]
    place = order[index] % step
    first = np.where(index == low[run], starts[run], np.concatenate([[0], place[:-1] + 1]) if len(place) else place)
    last = np.minimum(ends[run], place)
    kept = first <= last
    place, first, last = place[kept], first[kept], last[kept]
    # a value may lead, give way to none, and lead again: one anchor, one context
    joined = np.concatenate([[False], (place[1:] == place[:-1]) & (first[1:] == last[:-1] + 1)]) if len(place) else np.zeros(0, bool)
    begin = np.flatnonzero(~joined)
    last = np.maximum.reduceat(last, begin) if len(begin) else last
    return place[begin], value[place[begin]], first[begin], last


def scan(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``row, at, before, behind, key, context``: the anchors of all texts, and how far before and behind them windows start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            parts: list[tuple] = []
            for row, text in zip(batch.column("row").to_pylist(), texts(batch)):
                data = text.encode()
                if len(data) < length:
                    continue
                names = Names(data)
                at, key, first, last = anchors(names, len(data), length, seed)
                with np.errstate(over="ignore"):
                    name = _mixed(names.of(first, last + length) ^ ((at - first) * 1000003 + (last - first)).astype(np.uint64))
                parts.append((np.full(len(at), row), at, at - first, at - last, key.astype(np.int64), name.astype(np.int64)))
            columns = [np.concatenate(c) for c in zip(*parts)] or [np.zeros(0, np.int64)] * 6
            names_ = ("row", "at", "before", "behind", "key", "context")
            kinds = (pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64(), pa.int64())
            yield pa.record_batch({k: pa.array(c.astype(t.to_pandas_dtype()), t) for k, c, t in zip(names_, columns, kinds)})

    return docs.mapInArrow(run, "row long, at int, before short, behind short, key long, context long")


def _units(placed: DataFrame, length: int) -> DataFrame:
    """``row, at, before, behind, times, data``: the wanted contexts of each text with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            out = []
            for row, text, wanted in zip(batch.column("row").to_pylist(), texts(batch), batch.column("contexts").to_pylist()):
                data = text.encode()
                for c in wanted:
                    piece = data[c["at"] - c["before"]: c["at"] - c["behind"] + length]
                    out.append((row, c["at"], c["before"], c["behind"], c["times"], piece))
            columns = list(zip(*out)) or [[]] * len(_UNIT)
            yield pa.record_batch({k: pa.array(list(c), t) for (k, t), c in zip(_UNIT.items(), columns)})

    return placed.mapInArrow(run, _UNIT_SCHEMA)


def widths(windows: int) -> list[int]:
    """How many neighbouring windows have a core in common, level by level; each divides the one before, the last is one."""
    found = [1]
    while found[-1] * FAN < windows:
        found.append(found[-1] * FAN)
    return found[::-1]


def _split(units: DataFrame, length: int, seed: int, width: int) -> DataFrame:
    """The units cut where their windows' distance from the anchor passes a multiple of ``width``, with the key of each.

    All windows of one cut hold the bytes from its last start to its first end: that core's name is the key. Equal windows
    start equally far before their anchors, so they have equal keys.
    """
    most = length - seed + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            pieces = batch.column("data").to_pylist()
            joined = b"".join(pieces)
            before, behind = (batch.column(c).to_numpy().astype(np.int64) for c in ("before", "behind"))
            count = before // width - behind // width + 1
            which = np.repeat(np.arange(len(pieces)), count)
            cut = behind[which] // width + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            low, high = cut * width, np.minimum((cut + 1) * width, most) - 1
            far, near = np.minimum(before[which], high), np.maximum(behind[which], low)
            at = (np.cumsum([0, *map(len, pieces)])[:-1] + before)[which]
            start, end = at - far, at - near + length
            with np.errstate(over="ignore"):
                key = _mixed(Names(joined, 1).of(at - low, at - high + length) ^ (low * 1000003 + high).astype(np.uint64))
                context = _mixed(Names(joined).of(start, end) ^ (far * 1000003 + near).astype(np.uint64))
            same = {c: batch.column(c).take(pa.array(which)) for c in ("row", "at", "times")}
            yield pa.record_batch({
                "row": same["row"], "at": same["at"], "before": pa.array(far.astype(np.int16)), "behind": pa.array(near.astype(np.int16)),
                "times": same["times"], "data": pa.array([joined[s:e] for s, e in zip(start.tolist(), end.tolist())], pa.binary()),
                "key": pa.array(key.astype(np.int64)), "context": pa.array(context.astype(np.int64)),
            })

    return units.mapInArrow(run, f"{_UNIT_SCHEMA}, key long, context long")


def _open_keys(named: DataFrame) -> DataFrame:
    """Keys with several contexts of which one at least occurs once; those of other keys are settled."""
    return named.groupBy("key").agg(F.count("*").alias("kinds"), F.min("times").alias("least")).filter("kinds > 1 and least = 1").select("key")


def _refined(units: DataFrame, length: int, seed: int) -> list[DataFrame]:
    """``row, start, last``, level by level: first and last start of windows of the units that are repeated."""
    marks = []
    for width in widths(length - seed + 1):
        parts = _split(units, length, seed, width)
        named = stored(
            parts.groupBy("key", "context").agg(F.sum("times").alias("times"), F.min(F.struct("row", "at", "behind")).alias("first")), "repeats-names"
        )
        opened = _open_keys(named).withColumn("open", F.lit(True))
        state = named.join(opened, "key", "left").filter(F.col("open") | (F.col("times") > 1)).withColumnRenamed("times", "all_times")
        met = stored(parts.join(state, ["key", "context"]), "repeats-parts")
        marks.append(met.filter("times = 1 and all_times > 1").selectExpr(*_STARTS))
        # of equal contexts one goes on, for the others to compare with
        units = met.filter(F.col("open") & (F.struct("row", "at", "behind") == F.col("first"))).select(
            "row", "at", "before", "behind", F.col("all_times").alias("times"), "data"
        )
    return marks


def covered(n: int, marks: list[dict], length: int) -> np.ndarray:
    """Which of n bytes lie in a window that starts from ``start`` to ``last`` of a mark."""
    edge = np.zeros(n + 1, dtype=np.int32)
    for m in marks:
        edge[m["start"]] += 1
        edge[m["last"] + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def drop_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED_LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    # row ids hold for one evaluation only, and three uses need the same
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), "repeats-rows")
    found = scan(rows.select("row", "text"), length, seed)
    repeated = stored(found.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("key"), "repeats-keys")
    live = stored(found.join(repeated, "key", "left_semi"), "repeats-anchors")
    named = stored(
        live.groupBy("key", "context").agg(F.count("*").alias("times"), F.min(F.struct("row", "at", "before", "behind")).alias("first")),
        "repeats-contexts",
    )
    one = F.struct(*[F.col(f"first.{c}").alias(c) for c in ("at", "before", "behind")], "times")
    wanted = stored(
        named.join(_open_keys(named), "key").groupBy(F.col("first.row").alias("row")).agg(F.collect_list(one).alias("contexts")), "repeats-open"
    )
    units = _units(rows.join(wanted, "row").select("row", "text", "contexts"), length)
    settled = [live.join(named.filter("times > 1").select("key", "context"), ["key", "context"], "left_semi").selectExpr(*_STARTS)]
    found = reduce(DataFrame.unionByName, settled + _refined(stored(units, "repeats-units"), length, seed))
    marks = found.groupBy("row").agg(F.collect_list(F.struct("start", "last")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            out = []
            for doc_id, text, marked in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("marks").to_pylist()):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                gone = covered(len(data), marked or [], length)
                spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            columns = list(zip(*out)) or [[]] * 5
            names = [f.split()[0] for f in RESULT.split(", ")]
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.record_batch({k: pa.array(list(c), t) for k, c, t in zip(names, columns, kinds)})

    return rows.join(marks, "row", "left").select("doc_id", "text", "marks").mapInArrow(cut, RESULT)
