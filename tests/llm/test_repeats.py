"""Repeated byte strings against a table of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from harborline.llm import suffix_dedup
from tests.llm.rows import frame, make, sorted_rows


def plain(rows, length):
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    counts = Counter(d[i: i + length] for _, d in data for i in range(len(d) - length + 1))
    out = []
    for doc_id, d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc_id, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    letters = "abcdé \n"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(rng.randint(30, 400)) for _ in range(12)]
    rows = []
    for i in range(70):
        parts = [rng.choice([text(rng.randint(0, 90)), rng.choice(shared), rng.choice(shared)]) for _ in range(rng.randint(0, 7))]
        whole = "".join(parts)
        if whole and rng.random() < 0.3:  # an edit within
            k = rng.randrange(len(whole))
            whole = whole[:k] + "#" + whole[k + 1:]
        rows.append((i, whole, "en", "s"))
    rows += [(90, "z" * 700, "en", "s"), (91, "xy" * 300, "en", "s"), (92, "abc" * 21, "en", "s"), (None, shared[0] * 3, "en", "s")]
    return rows


@pytest.mark.parametrize("length,seed", [(60, 12), (40, 39), (100, 8)])
def test_removed_bytes_equal_brute_force(spark, length, seed):
    rows = passages(length)
    got = suffix_dedup.drop_repeats(frame(spark, rows), length, seed)
    assert sorted_rows(got.collect()) == sorted_rows(plain(rows, length))


def test_default_length_and_awkward_rows(spark):
    rows = [r for r in make() if r[0] != 103] + [(300, "w" * 199, "en", "s"), (301, "w" * 199, "en", "s")]
    assert sorted_rows(suffix_dedup.drop_repeats(frame(spark, rows)).collect()) == sorted_rows(plain(rows, 200))
    assert suffix_dedup.drop_repeats(frame(spark, [])).collect() == []


def test_line_with_many_surroundings(spark):
    """One substring, a context for each document; some of the contexts share windows."""
    rng = random.Random(5)
    line = "the same line of the foot of every page " * 3
    rows = [(i, f"{rng.random()}" * (i % 5) + line + f"{rng.randrange(20)}" * (i % 40), "en", "s") for i in range(300)]
    assert sorted_rows(suffix_dedup.drop_repeats(frame(spark, rows), 130, 20).collect()) == sorted_rows(plain(rows, 130))


def test_levels_divide_each_other():
    assert suffix_dedup.widths(169) == [64, 16, 4, 1] and suffix_dedup.widths(2) == [1] and suffix_dedup.widths(1) == [1]


def test_rows_dealt_anew_at_every_evaluation(spark):
    """As after a lost executor or with other file splits: each evaluation sees the rows in another order."""
    rows = passages(7)

    def shuffled(batches):
        import pyarrow as pa

        whole = pa.Table.from_batches(list(batches))
        order = random.SystemRandom().sample(range(whole.num_rows), whole.num_rows)
        yield from whole.take(pa.array(order, pa.int64())).to_batches()

    docs = frame(spark, rows).coalesce(1)
    docs = docs.mapInArrow(shuffled, docs.schema)
    assert sorted_rows(suffix_dedup.drop_repeats(docs, 60, 12).collect()) == sorted_rows(plain(rows, 60))
