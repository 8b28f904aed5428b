"""Periodic runs against brute force: the grammar, the runs, and the query's digests."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from harborline.llm import queries, runs
from harborline.llm.common import table
from harborline.llm.recompression import Grammar
from tests.llm.rows import frame, make, sorted_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, exponent=3, least=24):
    """``start, length, period`` by trying every period from the smallest on."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(least, exponent * p):
                found.setdefault((start, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_collapsed(words, found):
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    words, kinds = [], rng.choice([1, 2, 3, 50])
    for _ in range(rng.randint(0, 6)):
        period = [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(1, 20))]
        words += (period * rng.randint(1, 8))[: rng.randint(1, 150)]
    return words


def test_extensions_equal_a_scan():
    rng = np.random.default_rng(5)
    for _ in range(60):
        body = np.tile(rng.integers(10, 10 + rng.integers(1, 4), rng.integers(1, 9)), rng.integers(1, 7))
        seq = np.concatenate(([0], body, [1], body[: len(body) // 2], [2]))
        grammar, (x, y) = Grammar.of(seq), np.triu_indices(len(seq), 1)
        for step in (1, -1):
            for a, b, got in zip(x, y, grammar.extension(x, y, step)):
                n = 0
                while 0 <= a + step * n and b + step * n < len(seq) and seq[a + step * n] == seq[b + step * n]:
                    n += 1
                assert got == n


def test_runs_of_many_documents_equal_brute_force():
    rng = random.Random(2)
    for exponent, least in [(3, 24)] * 60 + [(2, 4)] * 20 + [(4, 1)] * 20:
        docs = [some_words(rng) for _ in range(rng.randint(1, 6))]
        for words, found in zip(docs, runs.runs_of([[w.encode() for w in d] for d in docs], exponent, least)):
            assert [(s, e - s, p) for s, e, p in found.tolist()] == plain_runs(words, exponent, least)


def test_long_periods_and_long_texts():
    rng = random.Random(4)
    part = [f"w{rng.randrange(9)}".encode() for _ in range(3001)]
    assert [r.tolist() for r in runs.runs_of([[b"x"] * 50_000, part * 4, part * 3])] == [[[0, 50_000, 1]], [[0, 12_004, 3001]], [[0, 9003, 3001]]]
    assert runs.runs_of([[], [b"a"] * 23, [b"a"] * 24])[2].tolist() == [[0, 24, 1]]


def plain_query(rows):
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = plain_runs(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{k},{p}\n" for s, k, p in found), plain_collapsed(words, found))]
        out.append((doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], *sha))
    return out


def test_query_equals_brute_force(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    got = queries.op13_periodic_runs(spark, sf_dir).collect()
    assert sorted_rows(got) == sorted_rows(plain_query((r.doc_id, r.text) for r in docs.collect()))
    assert sum(r.n_runs > 0 for r in got) > 10


def test_awkward_rows(spark, tmp_path):
    rows = make() + [(700 + i, " ".join(some_words(random.Random(i))), "en", "s1") for i in range(80)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted_rows(got) == sorted_rows(plain_query((r[0], r[1]) for r in rows))
    assert runs.collapse_runs(frame(spark, [])).collect() == []
