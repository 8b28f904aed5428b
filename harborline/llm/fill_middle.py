"""Fill-in-the-middle: documents cut in three at token boundaries and put in another order, cut by a wavelet matrix.

A token is a maximal run of ASCII letters or any other single character. Each character belongs to one of four classes, by
whether it and the one before it are letters; three of them begin a token. Ranks of these three in a wavelet matrix of many
documents add up to the number of tokens begun before a position, and bisection on that number finds where a token begins. Two
seeded numbers a document draw the cuts, two more its form.

Forms: ``plain`` is the text itself, ``psm`` has prefix, suffix, middle, ``spm`` suffix, prefix, middle, each after its marker.

Defined results: a null text counts as empty, and an empty text is plain, as is one that contains a marker; a null id draws
from the seed alone; documents with equal ids draw alike; a cut may be at either end and cuts may be equal, so any part may be
empty; very long texts are cut whole, in a group of their own; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, texts
from harborline.llm.wavelet import WaveletMatrix

SEED = "1"
#: Share of documents that are changed, and of these the share that begins with the suffix.
CHANGED, SUFFIX_FIRST = 0.9, 0.2
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_GROUP_CHARS = 1 << 20
#: Classes: the character is a letter (2), the one before it is (1).
_CONTINUED = 3


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of every code point; documents begin at ``starts``."""
    letter = ((points | 32) - np.uint32(97) < 26).astype(np.uint8)
    found = letter << 1
    found[1:] |= letter[:-1]
    found[starts[starts < len(found)]] &= 2
    return found


class Tokens:
    """Token numbers and positions in a sequence of documents."""

    def __init__(self, documents: list[str]):
        sizes = np.array([len(d) for d in documents], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        points = np.frombuffer("".join(documents).encode("utf-32-le"), dtype=np.uint32)
        self._matrix = WaveletMatrix(classes(points, self.starts), 2)
        self._first = self._begun(self.starts)
        self.counts = self._begun(self.ends) - self._first

    def _begun(self, at: np.ndarray) -> np.ndarray:
        return sum(self._matrix.rank(c, at) for c in range(_CONTINUED))

    def place(self, number: np.ndarray) -> np.ndarray:
        """Where the token of this number begins in each document; its end for the number of all tokens."""
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():
            middle = (low + high) // 2
            begun = (middle < self.ends) & (self._begun(np.minimum(middle + 1, self.ends)) - self._first > number)
            low, high = np.where(begun | (low == high), low, middle + 1), np.where(begun, middle, high)
        return low - self.starts


def _drawn(group: int, seed: str) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, changed: float = CHANGED, suffix_first: float = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: tokens, form, lengths in code points, and the new text."""
    text = F.coalesce("text", F.lit(""))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(marker))
    form = (
        F.when((text == "") | marked | (_drawn(3, seed) % 100 >= round(100 * changed)), "plain")
        .when(_drawn(4, seed) % 100 < round(100 * suffix_first), "spm").otherwise("psm")
    )

    def of(rows: list[tuple]) -> pa.RecordBatch:
        ids, first, second, forms, documents = (list(x) for x in zip(*rows))
        tokens = Tokens(documents)
        cuts = [np.array(h, dtype=np.int64) % (tokens.counts + 1) for h in (first, second)]
        low, high = (tokens.place(k(*cuts)).tolist() for k in (np.minimum, np.maximum))
        output = []
        for d, f, a, b in zip(documents, forms, low, high):
            if f == "psm":
                output.append(f"{PREFIX}{d[:a]}{SUFFIX}{d[b:]}{MIDDLE}{d[a:b]}")
            else:
                output.append(d if f == "plain" else f"{SUFFIX}{d[b:]}{PREFIX}{d[:a]}{MIDDLE}{d[a:b]}")
        cut = [f != "plain" for f in forms]
        return pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()), "n": pa.array(tokens.counts, pa.int64()), "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array([a if c else None for a, c in zip(low, cut)], pa.int64()),
            "middle_chars": pa.array([b - a if c else None for a, b, c in zip(low, high, cut)], pa.int64()),
            "output": pa.array(output, pa.string()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in small_batches(batches):
            given = (batch.column(c).to_pylist() for c in ("doc_id", "_first", "_second", "_form"))
            for *row, text in zip(*given, texts(batch)):
                if rows and size + len(text) > _GROUP_CHARS:
                    yield of(rows)
                    rows, size = [], 0
                rows.append((*row, text))
                size += len(text)
        if rows:
            yield of(rows)

    drawn = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _drawn(1, seed).alias("_first"), _drawn(2, seed).alias("_second"), form.alias("_form"), "text",
    )
    return drawn.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form alone: no marker is part of a text that was cut."""
    def after(marker: str) -> Column:
        return F.substring_index(output, marker, -1)

    begun = after(PREFIX), after(SUFFIX)
    psm = F.concat(F.substring_index(begun[0], SUFFIX, 1), after(MIDDLE), F.substring_index(begun[1], MIDDLE, 1))
    spm = F.concat(F.substring_index(begun[0], MIDDLE, 1), after(MIDDLE), F.substring_index(begun[1], PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
