"""Attention over passages: features, forward pass and gradients against plain versions, and held-out accuracy."""

import math
import re

import numpy as np
import pytest

from harborline.llm import quality
from harborline.llm.common import table
from tests.llm.rows import frame, make

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_class(byte):
    if 97 <= byte < 123:
        return 0
    if 65 <= byte < 91:
        return 1
    if 48 <= byte < 58:
        return 2
    if byte in b" \t":
        return 3
    if byte in b"\n\r\v\f":
        return 4
    return 5 if byte in b".,;:!?" else 7 if byte > 127 else 6


def plain_passages(text):
    """Features of each passage, by loops."""
    found, out = list(WORD.finditer(text)), []
    for k in range(0, len(found), quality.WORDS):
        words = found[k: k + quality.WORDS]
        body = [plain_class(b) for b in text[words[0].start(): words[-1].end()]]
        shapes, vocabulary = np.zeros(512), np.zeros(256)
        for a, b, c in zip(body, body[1:], body[2:]):
            shapes[a * 64 + b * 8 + c] += 1
        hashes = []
        for w in words:
            h = sum((b + 1 + (32 if 65 <= b < 91 else 0)) * int(quality._PLACE[i & 63]) for i, b in enumerate(w.group())) * int(quality._PLACE[0])
            h %= 1 << 64
            h = (h ^ (h >> 32)) * int(quality._PLACE[1]) % (1 << 64)
            vocabulary[h >> 56] += 1
            hashes.append(h)
        sizes = [len(w.group()) for w in words]
        n = len(words)
        figures = [
            sum(a == b for a, b in zip(hashes, hashes[1:])) / n, 1 - len(set(hashes)) / n, sum(sizes) / n / 10, max(sizes) / 30,
            math.log1p(n) / 4, (len(body) - sum(sizes)) / n - 1,
        ]
        out.append(np.concatenate((np.sqrt(shapes / max(len(body) - 2, 1)), np.sqrt(vocabulary / n), np.minimum(figures, 5))))
    return out


def plain_score(w, rows):
    if not rows:
        return 1 / (1 + math.exp(-w["score_0"][0]))
    codes = [np.tanh(r @ w["encode"] + w["encode_0"]) for r in rows]
    logits = [float((np.tanh(c @ w["tanh"] + w["tanh_0"]) / (1 + np.exp(-(c @ w["gate"] + w["gate_0"])))) @ w["attend"]) for c in codes]
    total = sum(math.exp(x) for x in logits)
    bag = sum(math.exp(x) / total * c for x, c in zip(logits, codes))
    return 1 / (1 + math.exp(-float(bag @ w["score"] + w["score_0"][0])))


TEXTS = [(r[1] or "").encode() for r in make()] + [b" a  b\n\nc! ", b"x", b"\t", "é ü 中文 ".encode() * 60]


def test_features_and_scores_equal_loops():
    x, counts = quality.passages(TEXTS)
    plain = [plain_passages(t) for t in TEXTS]
    assert counts.tolist() == [len(p) for p in plain]
    assert np.allclose(x, np.array([r for p in plain for r in p]), atol=1e-6)
    model = quality.Attention.new(0.4)
    assert np.allclose(model.scores(TEXTS), [plain_score(model.weights, p) for p in plain], atol=1e-5)
    assert [quality.passages([t])[0].tolist() for t in TEXTS[:9]] == [x[s: s + n].tolist() for s, n in list(zip(np.cumsum(counts) - counts, counts))[:9]]


def test_gradient_equals_differences():
    x, counts = quality.passages([t for t in TEXTS if t.split()][:12])
    rng = np.random.default_rng(1)
    model = quality.Attention({k: w.astype(np.float64) + rng.normal(0, 0.1, w.shape) for k, w in quality.Attention.new(0.3).weights.items()})
    label, share = rng.integers(0, 2, len(counts)), rng.random(len(counts))

    def loss():
        s = model.forward(x.astype(np.float64), counts)["score"]
        return -(share * np.where(label == 1, np.log(s), np.log(1 - s))).sum()

    for k, g in model.gradient(x, counts, label, share).items():
        for at in rng.integers(0, g.size, 6):
            w = model.weights[k].reshape(-1)
            kept = w[at]
            w[at] = kept + 1e-5
            high = loss()
            w[at] = kept - 1e-5
            low, w[at] = loss(), kept
            assert g.reshape(-1)[at] == pytest.approx((high - low) / 2e-5, abs=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    got = quality.classify(table(spark, folder, "documents"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (good.predicted == 1).mean() > 0.99 and (bad.predicted == 0).mean() > 0.95


def test_awkward_rows(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(60)] + [(3, 0, 1, "x"), (None, 1, 0, "x"), (7, None, 0, "x")], "doc_id long, quality int, toxic int, score string")
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (100, 101, 102)}) == 1
    assert sorted(map(repr, rows)) == sorted(map(repr, quality.classify(docs, labels).collect()))
    assert {r.score for r in quality.classify(docs, labels.filter("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.0}
    assert quality.classify(frame(spark, []), labels).collect() == []
    bounded = quality.classify(docs, labels, fit_rows=5, fit_bytes=2000)
    assert bounded.count() == docs.count()
