"""Quality by attention-based multiple-instance learning: a document is a bag of passages and only the bag has a label.

Every text is cut into passages of ``WORDS`` words. A passage is encoded from shares of byte-class trigrams, shares of hashed
words and a few figures of repetition and length, by one learnt layer. A gated attention, tanh times sigmoid, learns from the
documents' labels how much each passage matters; the weighted mean of the encodings is the document's, and a logistic layer
scores it. All weights are learnt together on a bounded sample of labelled rows; every passage of every text is scored.

Defined results: a null text counts as empty; a text without words has no passage and scores as the last intercept alone says;
rows without a label only get scores; an id with several labels has the smallest; of rows that repeat an id the fit takes the
smallest text; null ids are never labelled and not held out; ties of the sample's order go by id; repeated rows are scored each;
without training labels of both classes every score is the share of label 1, 0 without any; very long texts are scored whole,
in a group of their own; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, texts
from harborline.llm.sampling import bounded_sample, labelled_ids
from harborline.llm.toxicity import held_out

WORDS = 48
#: Bounds of the sample that the model is fitted on, for each label: rows, and bytes of their texts.
FIT_ROWS, FIT_BYTES = 4000, 8 << 20
THRESHOLD = 0.3
_GROUP_BYTES = 1 << 20
_WORD_BINS, _FIGURES = 256, 6
FEATURES = 8 ** 3 + _WORD_BINS + _FIGURES
_HIDDEN, _GATES = 32, 16
_EPOCHS, _BAG, _RATE, _PENALTY = 14, 32, 3e-3, 1e-5

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Classes of bytes: lower case, upper case, digits, blanks, line ends, stops and commas, other ASCII, beyond ASCII.
_CLASS = np.full(256, 6, dtype=np.int32)
for _number, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r\v\f", b".,;:!?", (), range(128, 256))):
    _CLASS[list(_bytes)] = _number
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_PLACE = np.random.default_rng(12).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, and the range of each."""
    of = np.repeat(np.arange(len(starts)), lengths)
    return np.arange(len(of)) + (starts - (np.cumsum(lengths) - lengths))[of], of


def passages(documents: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of passages of each text."""
    data = np.frombuffer(b" ".join([*documents, b""]), dtype=np.uint8)
    sizes = np.array([len(d) + 1 for d in documents], dtype=np.int64)
    space = _SPACES[data]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    document = np.searchsorted(np.cumsum(sizes), starts, side="right")
    per_document = np.bincount(document, minlength=len(documents))
    number = np.arange(len(starts)) - (np.cumsum(per_document) - per_document)[document]
    opens = np.flatnonzero(number % words == 0)
    counts = np.bincount(document[opens], minlength=len(documents))
    if not len(opens):
        return np.zeros((0, FEATURES), dtype=np.float32), counts
    n = len(opens)
    n_words = np.diff(opens, append=len(starts))
    passage = np.repeat(np.arange(n), n_words)
    begin, end = starts[opens], ends[opens + n_words - 1]

    kind = _CLASS[data]
    trigrams = np.maximum(end - begin - 2, 0)
    at, of = _ranges(begin, trigrams)
    codes = kind[at] * 64 + kind[at + 1] * 8 + kind[at + 2]
    shapes = np.bincount(of * 512 + codes, minlength=n * 512).reshape(n, 512) / np.maximum(trigrams, 1)[:, None]

    lengths = ends - starts
    at, of = _ranges(starts, lengths)
    with np.errstate(over="ignore"):
        value = _LOWER[data[at]] * _PLACE[(at - starts[of]) & 63]
        hashed = np.add.reduceat(value, np.cumsum(lengths) - lengths) * _PLACE[0]
        hashed ^= hashed >> np.uint64(32)
        hashed *= _PLACE[1]
    bins = (hashed >> np.uint64(56)).astype(np.int64)
    vocabulary = np.bincount(passage * _WORD_BINS + bins, minlength=n * _WORD_BINS).reshape(n, _WORD_BINS) / n_words[:, None]

    again = np.flatnonzero((hashed[1:] == hashed[:-1]) & (passage[1:] == passage[:-1])) + 1
    distinct = np.unique(passage.astype(np.uint64) << np.uint64(40) | hashed >> np.uint64(24)) >> np.uint64(40)
    letters = np.add.reduceat(lengths, opens)
    figures = np.stack([
        np.bincount(passage[again], minlength=n) / n_words, 1 - np.bincount(distinct.astype(np.int64), minlength=n) / n_words,
        letters / n_words / 10, np.maximum.reduceat(lengths, opens) / 30, np.log1p(n_words) / 4, (end - begin - letters) / n_words - 1,
    ], axis=1)
    return np.concatenate((np.sqrt(shapes), np.sqrt(vocabulary), np.minimum(figures, 5)), axis=1, dtype=np.float32, casting="same_kind"), counts


def _groups(documents: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts of ``_GROUP_BYTES`` together, or one longer one."""
    group, size = [], 0
    for d in documents:
        if group and size + len(d) > _GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(d)
        size += len(d)
    yield group


class Attention:
    """Encoder, gated attention and logistic layer over bags of passages."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def new(cls, share: float, seed: int = 12) -> Attention:
        rng = np.random.default_rng(seed)
        sizes = {"encode": (FEATURES, _HIDDEN), "tanh": (_HIDDEN, _GATES), "gate": (_HIDDEN, _GATES), "attend": (_GATES,), "score": (_HIDDEN,)}
        weights = {k: rng.normal(0, (2 / (s[0] + s[-1])) ** 0.5, s) for k, s in sizes.items()}
        weights |= {"encode_0": np.zeros(_HIDDEN), "tanh_0": np.zeros(_GATES), "gate_0": np.zeros(_GATES), "score_0": np.array([np.log(share / (1 - share))])}
        return cls({k: w.astype(np.float32) for k, w in weights.items()})

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags that have at least one passage each, and all that led to them."""
        w, first = self.weights, np.cumsum(counts) - counts
        code = np.tanh(x @ w["encode"] + w["encode_0"])
        value = np.tanh(code @ w["tanh"] + w["tanh_0"])
        gate = 1 / (1 + np.exp(-(code @ w["gate"] + w["gate_0"])))
        logit = (value * gate) @ w["attend"]
        weight = np.exp(logit - np.repeat(np.maximum.reduceat(logit, first), counts))
        weight /= np.repeat(np.add.reduceat(weight, first), counts)
        bag = np.add.reduceat(code * weight[:, None], first)
        score = 1 / (1 + np.exp(-(bag @ w["score"] + w["score_0"][0])))
        return {"code": code, "value": value, "gate": gate, "weight": weight, "bag": bag, "score": score}

    def gradient(self, x: np.ndarray, counts: np.ndarray, label: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy, each bag with its share."""
        w, f, first = self.weights, self.forward(x, counts), np.cumsum(counts) - counts
        error = (share * (f["score"] - label)).astype(np.float32)
        of = np.repeat(np.arange(len(counts)), counts)
        to_bag = error[:, None] * w["score"]
        pull = (f["code"] * to_bag[of]).sum(axis=1)
        to_logit = f["weight"] * (pull - np.add.reduceat(f["weight"] * pull, first)[of])
        to_value = to_logit[:, None] * w["attend"] * f["gate"] * (1 - f["value"] ** 2)
        to_gate = to_logit[:, None] * w["attend"] * f["value"] * f["gate"] * (1 - f["gate"])
        to_code = to_bag[of] * f["weight"][:, None] + to_value @ w["tanh"].T + to_gate @ w["gate"].T
        to_code *= 1 - f["code"] ** 2
        return {
            "encode": x.T @ to_code, "encode_0": to_code.sum(axis=0), "tanh": f["code"].T @ to_value, "tanh_0": to_value.sum(axis=0),
            "gate": f["code"].T @ to_gate, "gate_0": to_gate.sum(axis=0), "attend": (f["value"] * f["gate"]).T @ to_logit,
            "score": f["bag"].T @ error, "score_0": np.array([error.sum()]),
        }

    def scores(self, documents: list[bytes]) -> np.ndarray:
        """One score a text, also for texts without passages."""
        x, counts = passages(documents)
        out = np.full(len(documents), 1 / (1 + np.exp(-float(self.weights["score_0"][0]))))
        if len(x):
            out[counts > 0] = self.forward(x, counts[counts > 0])["score"]
        return np.round(out, 6)


def learn(documents: list[bytes], label: np.ndarray, share: np.ndarray) -> Attention:
    """Adam over shuffled groups of bags; ``share`` weighs each document."""
    # half precision: the sample is by far the largest thing the task holds
    x, counts = (np.concatenate(p) for p in zip(*((f.astype(np.float16), n) for f, n in map(passages, _groups(documents)))))
    first, rng = np.cumsum(counts) - counts, np.random.default_rng(12)
    weight = share / share.mean()
    model = Attention.new(float(np.clip(np.average(label, weights=share), 0.01, 0.99)))
    mean, square = ({k: np.zeros_like(w) for k, w in model.weights.items()} for _ in range(2))
    bags, step = np.flatnonzero(counts), 0
    for epoch in range(_EPOCHS):
        rate = _RATE * (1 - epoch / _EPOCHS)
        order = rng.permutation(bags)
        for start in range(0, len(order), _BAG):
            some = order[start: start + _BAG]
            at, _ = _ranges(first[some], counts[some])
            step += 1
            for k, g in model.gradient(x[at].astype(np.float32), counts[some], label[some], weight[some] / len(some)).items():
                g = g.astype(np.float32) + _PENALTY * model.weights[k]
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                model.weights[k] = model.weights[k] - rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Attention | float:
    """The model; the share of label 1 if the training labels lack a class."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(F.col("quality").cast("int")).alias("_label"))
    labelled = labelled_ids(docs, known)
    rows = {r["_label"]: r["n"] for r in labelled.groupBy("_label").agg(F.count("*").alias("n")).filter("_label in (0, 1)").collect()}
    if len(rows) < 2:
        return float(1 in rows)
    sample = bounded_sample(docs, labelled, fit_rows, fit_bytes)

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_id")
        label = part["_label"].to_numpy()
        seen = np.bincount(label, minlength=2)
        share = np.array([rows[k] / max(seen[k], 1) for k in (0, 1)])[label]
        model = learn([t.encode() for t in part["text"]], label, share)
        return pd.DataFrame({"name": list(model.weights), "weights": [w.astype(np.float32).tobytes() for w in model.weights.values()]})

    found = sample.groupBy().applyInPandas(train, "name string, weights binary").collect()
    shapes = Attention.new(0.5).weights
    return Attention({r["name"]: np.frombuffer(r["weights"], dtype=np.float32).reshape(shapes[r["name"]].shape) for r in found})


def score(docs: DataFrame, model: Attention | float) -> DataFrame:
    """``doc_id, score`` for every document."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if isinstance(model, float):
        return ids.select("doc_id", F.lit(model).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Attention(shared.value)
        for batch in small_batches(batches):
            scores = [model.scores(group) for group in _groups([t.encode() for t in texts(batch)])]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(np.concatenate(scores), pa.float64())})

    return ids.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    scored = score(docs, fit(docs, labels, fit_rows, fit_bytes))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
