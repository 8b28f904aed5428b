"""Fill-in-the-middle: rank queries, cuts and forms against a plain version, and exact round trips."""

import hashlib
import random
import re

import numpy as np

from harborline.llm import fill_middle
from harborline.llm.wavelet import WaveletMatrix
from pyspark.sql import functions as F
from tests.llm.rows import frame, make, sorted_rows

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_ranks_equal_counts():
    rng = np.random.default_rng(3)
    for size, bits in [(0, 2), (1, 2), (63, 2), (64, 3), (200, 3), (1000, 4)]:
        numbers = rng.integers(0, 1 << bits, size).astype(np.uint8)
        matrix, at = WaveletMatrix(numbers, bits), np.arange(size + 1)
        for number in range(1 << bits):
            assert matrix.rank(number, at).tolist() == [int((numbers[:i] == number).sum()) for i in at]


def test_outputs_and_round_trip(spark):
    rng = random.Random(6)
    odd = ["<", ">", "P", "S", "M", "<S", "<P", "é", "😀", "\n", "ab", " "]
    rows = make() + [(1000 + i, "".join(rng.choice(odd) for _ in range(rng.randint(0, 40))), "en", "s1") for i in range(300)]
    docs = frame(spark, rows)
    got = fill_middle.fill_in_middle(docs)
    assert sorted_rows(got.collect()) == sorted_rows(plain(r[0], r[1]) for r in rows)
    back = got.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted_rows(back.collect()) == sorted_rows((r[0], r[1] or "") for r in rows)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(frame(spark, [])).collect() == []


def test_rates(spark):
    docs = frame(spark, make())
    assert {r.form for r in fill_middle.fill_in_middle(docs, changed=0.0).collect()} == {"plain"}
    assert {r.form for r in fill_middle.fill_in_middle(docs, suffix_first=1.0).collect()} == {"plain", "spm"}
