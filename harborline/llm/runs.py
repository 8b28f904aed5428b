"""Periodic runs of words, found by recompression, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q and at least ``exponent`` times q and ``least`` words that no
neighbouring word extends with that period. The words of many documents make one sequence with a symbol of its own between any
two documents. For every period p the grid of step (exponent - 1) p, or more where runs must be longer, has a point in every run
of that period, and a point is a candidate if its word comes again p words on. Candidates are harmonic in number. The grammar of
the sequence gives their exact extensions in both directions, hence the whole run. Candidates within a known run whose
period divides theirs are left out, and of several periods of one stretch the smallest counts.

Defined results: a null text counts as empty; a text without words has no runs and an empty collapsed text; words are kept
exactly, in any letter case; null ids, ties and repeated rows are rows like any other; an empty table gives an empty result;
further columns are left out. A text is never cut: a task needs some 300 bytes of memory a word of its longest text, or of
``_BATCH_WORDS`` words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, texts
from harborline.llm.recompression import Grammar

EXPONENT = 3
LEAST = 24
RUN = "struct<start: bigint, length: bigint, period: bigint>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"
_BATCH_WORDS = 1 << 18
_CANDIDATES = 1 << 16


def _grid(sequence: np.ndarray, longest: int, exponent: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and periods of the candidates; each run has at least one with its own period."""
    n, most = len(sequence), longest // exponent
    by_period = min(most, max(least, int((n / (exponent - 1)) ** 0.5)))
    for p in range(1, by_period + 1):
        step = max((exponent - 1) * p, least - p)
        at = np.flatnonzero(sequence[:n - p: step] == sequence[p:: step]) * step
        yield at, np.full(len(at), p)
    if most > by_period:
        first = by_period + 1
        # long periods have few points each: go by the number of the point, over all of these periods at once
        for k in range(exponent - 1, (n - 1) // first, exponent - 1):
            stop = min(most, (n - 1) // (k + 1)) + 1
            p = first + np.flatnonzero(sequence[k * first: k * (stop - 1) + 1: k] == sequence[(k + 1) * first: (k + 1) * (stop - 1) + 1: k + 1])
            yield p * k, p


def find_runs(sequence: np.ndarray, longest: int, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, by start, then end. No document has more than ``longest`` words.

    ``sequence`` begins and ends with symbols that occur once, and has another such symbol between any two documents.
    """
    found: dict[tuple[int, int], int] = {}
    if longest < least:
        return np.zeros((0, 3), dtype=np.int64)
    grammar = Grammar.of(sequence)
    covered_to, with_period = np.zeros(len(sequence), dtype=np.int64), np.ones(len(sequence), dtype=np.int64)

    def settle(at: np.ndarray, p: np.ndarray) -> None:
        new = (covered_to[at] <= at + p) | (p % with_period[at] != 0)
        at, p = at[new], p[new]
        end = at + p + grammar.extension(at, at + p)
        start = at - grammar.extension(at - 1, at + p - 1, -1)
        run = end - start >= np.maximum(least, exponent * p)
        # by period downwards, so that the smallest period of a stretch is what stays
        for s, e, q in sorted(set(zip(start[run].tolist(), end[run].tolist(), p[run].tolist())), key=lambda r: -r[2]):
            if found.setdefault((s, e), q) >= q:
                found[s, e] = q
                less = covered_to[s:e] <= e
                covered_to[s:e][less], with_period[s:e][less] = e, q

    waiting, size = [], 0
    for part in _grid(sequence, longest, exponent, least):
        if len(part[0]):
            waiting.append(part)
            size += len(part[0])
        if size >= _CANDIDATES:
            settle(*(np.concatenate(x) for x in zip(*waiting)))
            waiting, size = [], 0
    if waiting:
        settle(*(np.concatenate(x) for x in zip(*waiting)))
    return np.array([(s, e, found[s, e]) for s, e in sorted(found)], dtype=np.int64).reshape(-1, 3)


def runs_of(documents: list[list[bytes]], exponent: int = EXPONENT, least: int = LEAST) -> list[np.ndarray]:
    """``start, end, period`` of the runs of every document, in word numbers."""
    sizes = np.array([len(words) for words in documents], dtype=np.int64)
    number: defaultdict[bytes, int] = defaultdict(count(len(documents) + 1).__next__)
    starts = np.cumsum(sizes + 1) - sizes
    sequence = np.empty(int(sizes.sum()) + len(documents) + 1, dtype=np.int64)
    sequence[0], sequence[starts + sizes] = 0, np.arange(1, len(documents) + 1)
    for start, words in zip(starts, documents):
        sequence[start: start + len(words)] = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    runs = find_runs(sequence, int(sizes.max(initial=0)), exponent, least)
    at = np.searchsorted(runs[:, 0], [*starts, len(sequence)])
    return [runs[low:high] - (start, start, 0) for low, high, start in zip(at, at[1:], starts)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without those of any run after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 1], -1)
        words = compress(words, (np.cumsum(change[:-1]) == 0).tolist())
    return b" ".join(words)


def collapse_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every document; runs by start, then period."""

    def of(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(documents, exponent, least)
        rows = [[{"start": s, "length": e - s, "period": p} for s, e, p in sorted(runs.tolist(), key=lambda r: (r[0], r[2]))] for runs in found]
        kept = [collapsed(words, runs) for words, runs in zip(documents, found)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(map(len, documents), pa.int64()),
            "runs": pa.array(rows, kind), "collapsed": pa.array(kept, pa.string()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, documents, size = [], [], 0
        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = text.encode().split()  # of bytes: at exactly the six white-space characters of ASCII
                if documents and size + len(words) > _BATCH_WORDS:
                    yield of(ids, documents)
                    ids, documents, size = [], [], 0
                ids.append(doc_id)
                documents.append(words)
                size += len(words) + 1
        if documents:
            yield of(ids, documents)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period; of equal ones the first."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
