"""Small documents with every awkward case, and columns whose names clash with those of the operators."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, row string, `_key` string, "
    "score double, part int, context long, target double, root long, base string, added string"
)


def make(n=60, seed=7):
    rng = random.Random(seed)
    words = ["tide", "Harbor", "crane", "the", "of", "pilot", "Ärger", "naïve", "42", "buoy,", "quay.", "x"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 40, 300])))
        rows.append((i, text, "en", rng.choice(["s1", "s2", "s3", "s4", None])))
    rows += [
        (100, None, None, None), (101, "", "en", "s1"), (102, " \t\n ", "en", "s2"), (None, "no id at all", "en", "s1"),
        (None, None, None, "s1"), (103, "long " * 30_000, "en", "s3"), (104, "n" * 70_001, "de", "s3"), (105, "😀é " * 50, "en", "s9"),
        (106, "mail a.b@c.example.com or +1 (212) 555-0100 then 10.0.0.1, card 4111 1111 1111 1111", "en", "s2"),
    ]
    rows += rows[:4] + [rows[0]] * 3  # repeated rows
    rows += [(200 + k, rows[5][1], "en", "s1") for k in range(6)]  # copies
    return rows


def frame(spark, rows=None):
    rows = make() if rows is None else rows
    clash = (1, 2, "row", "key", 0.5, 3, 4, 0.1, 5, "base", "added")
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, *clash) for r in rows], SCHEMA)


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)
