"""Toxicity by a linear classifier over character n-grams scaled with naive Bayes log-count ratios.

Features are the distinct character n-grams of a text in lower case, hashed to a fixed number of bins. Each is scaled by the
log ratio of its smoothed document frequencies in the two classes, counted in Spark over all labelled training rows. The
features of a text have unit length. A logistic model over them is fitted on a bounded sample of the training rows by
gradient descent; its weights, one a bin, are all that the scoring tasks get.

Defined results: a null or empty text has no features and scores as the intercept alone says; rows without a label only get
scores; several equal labels of one id count once, an id with both labels counts as toxic; null ids are never labelled and not
held out; repeated rows count each, but the fit takes one text an id, the smallest; ties of the sample's order go by id; very long
texts are scored whole; without labels of both classes all scores are 0; further columns are carried untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, texts
from harborline.llm.sampling import bounded_sample, labelled_ids

BINS = 1 << 18
ORDERS = (2, 3, 4)
#: Most training rows of each class that the linear model is fitted on, and most bytes of their texts; the counts cover all rows.
FIT_ROWS, FIT_BYTES = 2000, 16 << 20
_COUNT_BLOCK = 1 << 12
_CHARS = 1 << 18
_STEPS = 100
_PENALTY = 2e-5


class Features:
    """Bins of the distinct n-grams of a text."""

    def __init__(self, bins: int = BINS, orders: tuple[int, ...] = ORDERS):
        if bins & (bins - 1):
            raise ValueError("bins must be a power of two")
        self.bins, self.orders = bins, orders
        self._shift = np.uint64(65 - bins.bit_length())
        self._met = np.zeros(bins, dtype=bool)

    def __call__(self, text: str) -> np.ndarray:
        met = self._met
        longest = max(self.orders)
        text = text.lower()
        for start in range(0, len(text), _CHARS):
            piece = text[start: start + _CHARS + longest - 1]
            code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
            gram = np.zeros(len(code), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for n in range(1, longest + 1):
                    if len(code) < n:
                        break
                    gram = gram[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:] + np.uint64(1)
                    if n in self.orders:
                        mixed = (gram ^ (gram >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                        met[mixed >> self._shift] = True
        found = np.flatnonzero(met)
        met[found] = False
        return found.astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this id are never learnt from: one row in five by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("_label_id")).agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    return known.filter(~held_out(F.col("_label_id")))


def class_counts(train: DataFrame, bins: int = BINS, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class that hold each bin, and documents of each class, over all rows of ``text, toxic``."""
    step = min(_COUNT_BLOCK, bins)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bins, orders)
        counts, rows = np.zeros((2, bins), dtype=np.int32), [0, 0]
        for batch in small_batches(batches):
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                counts[toxic, features(text)] += 1
                rows[toxic] += 1
        for toxic in (0, 1):
            if rows[toxic]:
                blocks = counts[toxic].reshape(-1, step)
                yield pa.record_batch({
                    "toxic": pa.array([toxic] * len(blocks), pa.int32()), "block": pa.array(range(len(blocks)), pa.int32()),
                    "counts": pa.array([b.tobytes() for b in blocks], pa.binary()), "rows": pa.array([rows[toxic]] * len(blocks), pa.int64()),
                })

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(step, dtype=np.int64)
        for one in part["counts"]:
            width = np.int32 if len(one) == 4 * step else np.int64
            total += np.frombuffer(one, dtype=width)
        first = part.iloc[0]
        return pd.DataFrame({"toxic": [first["toxic"]], "block": [first["block"]], "counts": [total.tobytes()], "rows": [part["rows"].sum()]})

    schema = "toxic int, block int, counts binary, rows long"
    sums = train.select("text", "toxic").mapInArrow(count, schema).groupBy("toxic", "block").applyInPandas(add, schema)
    counts, rows = np.zeros((2, bins)), np.zeros(2)
    for r in sums.toLocalIterator():  # as many numbers as there are bins
        counts[r["toxic"], r["block"] * step: (r["block"] + 1) * step] = np.frombuffer(r["counts"], dtype=np.int64)
        rows[r["toxic"]] = r["rows"]
    return counts, rows


def log_ratio(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    share = (counts + 1) / (rows[:, None] + 2)
    return (np.log(share[1]) - np.log(share[0])).astype(np.float32)


def _unit(found: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    scaled = ratio[found]
    length = float(np.sqrt((scaled * scaled).sum()))
    return scaled / length if length else scaled


def fit_linear(rows: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by bin and intercept of a penalised logistic model, by accelerated gradient descent on unit-length rows."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    value = np.concatenate([_unit(r, ratio) for r in rows]) if rows else np.zeros(0, np.float32)
    used, index = np.unique(index, return_inverse=True)
    share = weight / weight.sum()
    w, b = np.zeros(len(used)), 0.0
    w_ahead, b_ahead, speed = w, b, 1.0
    rate = 2.0  # rows have length one and an intercept: the curvature is at most a half
    for _ in range(_STEPS):
        z = np.bincount(at, weights=value * w_ahead[index], minlength=len(rows)) + b_ahead
        error = share * (1 / (1 + np.exp(-z)) - toxic)
        w_new = w_ahead - rate * (np.bincount(index, weights=value * error[at], minlength=len(used)) + _PENALTY * w_ahead)
        b_new = b_ahead - rate * error.sum()
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        pull = (speed - 1) / faster
        w_ahead, b_ahead = w_new + pull * (w_new - w), b_new + pull * (b_new - b)
        w, b, speed = w_new, b_new, faster
    whole = np.zeros(len(ratio), dtype=np.float32)
    whole[used] = w
    return whole, float(b)


def fit(docs: DataFrame, labels: DataFrame, bins: int = BINS, orders: tuple[int, ...] = ORDERS, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES):
    """Log ratios, weights and intercept; None if the training labels lack a class.

    The linear model is fitted in one task on a bounded sample of each class, of the labelled ids that ``docs`` has, and weighted
    back to the classes' shares of all training rows.
    """
    known = _labelled(docs, labels)
    # labels grow with the documents, so they are never broadcast: one plan at every size
    train = docs.select(F.col("doc_id").alias("_id"), "text").join(known.hint("merge"), F.col("_id") == F.col("_label_id"))
    counts, rows = class_counts(train.select("text", F.col("_toxic").alias("toxic")), bins, orders)
    if not rows.all():
        return None
    ratio = log_ratio(counts, rows)
    labelled = labelled_ids(docs, known.select(F.col("_label_id").cast("long").alias("_id"), F.col("_toxic").alias("_label")))
    sample = bounded_sample(docs, labelled, fit_rows, fit_bytes).withColumnRenamed("_label", "_toxic")
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    scale = [float(r) for r in rows]

    def bins_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bins, orders)
        for batch in small_batches(batches):
            found = [features(t).tobytes() for t in texts(batch)]
            yield pa.record_batch({"id": batch.column("_id"), "toxic": batch.column("_toxic"), "bins": pa.array(found, pa.binary())})

    def train_all(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "bins"])
        toxic = part["toxic"].to_numpy()
        seen = np.bincount(toxic, minlength=2)
        weight = np.where(toxic == 1, scale[1] / max(seen[1], 1), scale[0] / max(seen[0], 1))
        found = [np.frombuffer(x, dtype=np.int32) for x in part["bins"]]
        w, b = fit_linear(found, toxic, weight, shared.value)
        return pd.DataFrame({"weights": [w.tobytes()], "intercept": [b]})

    features = sample.select("_id", "_toxic", "text").mapInArrow(bins_of, "id long, toxic int, bins binary")
    model = features.groupBy().applyInPandas(train_all, "weights binary, intercept double").first()
    return ratio, np.frombuffer(model["weights"], dtype=np.float32), model["intercept"]


def score(docs: DataFrame, model, column: str = "score", bins: int = BINS, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """All columns and the score, 0 to 1."""
    schema = type(docs.schema)([*docs.schema.fields]).add(column, "double")
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bins, orders)
        ratio, weights, intercept = shared.value
        for batch in small_batches(batches):
            found = [features(t) for t in texts(batch)]
            z = np.array([float(_unit(f, ratio) @ weights[f]) for f in found]) + intercept
            scores = 1 / (1 + np.exp(-z))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, fit_rows=fit_rows)).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_harmless(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that are not predicted toxic."""
    scored = score(docs.select(F.struct("*").alias("row"), "text"), fit(docs, labels, fit_rows=fit_rows), "_score")
    return scored.filter(F.col("_score") < 0.5).select("row.*")
