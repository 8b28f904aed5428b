"""SimHash fingerprints of documents, and the search for all fingerprints within a Hamming radius.

Terms are word shingles. A term that occurs n times weighs 1 + ln(n), in 64ths, times what a ``weight`` function says, so that repeated
lines do not outvote the rest. It votes with its weight, on each bit for or against as the bit of the term's hash is set. A fingerprint
bit is set where the votes for it prevail. The search cuts fingerprints into blocks and keeps one
table for every choice of blocks that a pair within the radius must share, in permuted order: equal keys are compared in full.

Defined results: a null text counts as empty; an empty text has the fingerprint zero; a text of fewer words than a shingle is
one term; very long texts are fingerprinted whole; null ids sort first, equal ids by text; repeated rows count each; the one row of a table is its own successor; an
empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import combinations
from math import cos, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import WORD, small_batches, stored, texts, width

BITS = 128
SHINGLE = 3
_WORDS = re.compile(WORD)
_BLOCK_TERMS = 16_384
_SCALE = 64
_MAX_KNOWN = 200_000
_MASK = (1 << 64) - 1
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class Fingerprinter:
    """Fingerprints of texts; ``weight`` maps the 64-bit hashes of terms to factors of their weights (default: one each)."""

    def __init__(self, bits: int = BITS, shingle: int = SHINGLE, weight=None):
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.bits, self.shingle, self.weight = bits, shingle, weight
        self._known: dict[str, int] = {}

    def _hashes(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > _MAX_KNOWN:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w.encode())
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def _votes(self, terms: np.ndarray) -> np.ndarray:
        terms, times = np.unique(terms, return_counts=True)
        weights = 1 + np.log(times)
        if self.weight is not None:
            weights *= self.weight(terms)
        # whole numbers: sums of a block are exact, and votes that cancel out give zero
        weights = np.rint(_SCALE * weights)
        votes = np.zeros(self.bits)
        for start in range(0, len(terms), _BLOCK_TERMS):
            part, weight = terms[start: start + _BLOCK_TERMS], weights[start: start + _BLOCK_TERMS]
            lanes = np.stack([_mixed(part ^ np.uint64(_MIX[i % 4] + i & _MASK)) for i in range(self.bits // 64)], axis=1)
            bits = np.unpackbits(lanes.astype(">u8").view(np.uint8).reshape(len(part), -1), axis=1)
            votes += 2 * (weight.astype(np.float32) @ bits.astype(np.float32)) - weight.sum()
        return votes

    def __call__(self, text: str) -> bytes:
        words = _WORDS.findall(text.lower())
        if not words:
            return bytes(self.bits // 8)
        h = self._hashes(words)
        n = min(self.shingle, len(h))
        with np.errstate(over="ignore"):
            terms = np.zeros(len(h) - n + 1, dtype=np.uint64)
            for i in range(n):
                terms = _mixed(terms * np.uint64(_MIX[0]) + h[i: len(h) - n + 1 + i])
        return np.packbits(self._votes(terms) > 0).tobytes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX[1])
        return x ^ (x >> np.uint64(32))


def likeness(a: bytes, b: bytes) -> float:
    """Estimated cosine of the weighted term vectors, from the share of bits that differ; 0 to 1."""
    differing = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return max(0.0, cos(pi * differing / (8 * len(a))))


def fingerprints(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (hexadecimal) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Fingerprinter(bits, shingle)
        for batch in small_batches(batches):
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fingerprint": pa.array([made(t).hex() for t in texts(batch)], pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def within(prints: DataFrame, radius: int = 3, blocks: int | None = None, bits: int = BITS) -> DataFrame:
    """``fingerprint, other``: pairs of different fingerprints with at most ``radius`` differing bits, each pair once.

    Of ``blocks`` blocks, at least ``blocks - radius`` agree; there is a table for every such choice, keyed by those blocks.
    Works on distinct fingerprints, so copies are not paired. More blocks give more tables with longer keys. A key of few bits
    puts many unlike fingerprints together; with as many blocks as differing bits, or fewer, no key would be sure to be shared.
    """
    blocks, digits = blocks or 2 * radius, bits // 4
    if not radius < blocks <= digits:
        raise ValueError(f"a radius of {radius} needs more than {radius} blocks, and {bits} bits allow {digits} at most")
    edges = [digits * i // blocks for i in range(blocks + 1)]
    piece = [F.substring("fingerprint", edges[i] + 1, edges[i + 1] - edges[i]) for i in range(blocks)]
    tables = [
        F.concat(F.lit(f"{number}:"), *[piece[i] for i in kept])
        for number, kept in enumerate(combinations(range(blocks), blocks - radius))
    ]
    keyed = prints.select("fingerprint").distinct().withColumn("key", F.explode(F.array(*tables)))
    other = keyed.select(F.col("fingerprint").alias("other"), "key")
    halves = [(16 * i + 1, 16) for i in range(bits // 64)]
    word = lambda c, at, n: F.conv(F.substring(c, at, n), 16, -10).cast("long")
    differing = sum((F.bit_count(word("fingerprint", *h).bitwiseXOR(word("other", *h))) for h in halves), F.lit(0))
    return keyed.join(other, "key").filter((F.col("fingerprint") < F.col("other")) & (differing <= radius)).select("fingerprint", "other").distinct()


def _parts(docs: DataFrame, parts: int) -> list[int]:
    """Ids that cut the table into parts of about equal size; their number is that of the parts."""
    share = [i / parts for i in range(1, parts)]
    row = docs.agg(F.percentile_approx("doc_id", share, 10_000).alias("cuts")).first() if share else None
    return sorted(set(row["cuts"] or [])) if row else []


def _position(cuts: list[int], at: Column) -> Column:
    """How many cuts lie below: first among every step-th cut, then among the step cuts behind it."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    listed = lambda values: F.array(*[F.lit(c).cast("long") for c in values]).cast("array<bigint>")
    below = lambda some: F.size(F.filter(some, lambda c: c < at))
    coarse = below(listed(cuts[step - 1:: step])) * step
    fine = below(F.slice(listed(cuts), coarse + 1, F.lit(step)))
    return F.when(at.isNull(), 0).otherwise(coarse + fine).cast("int")


def with_successor(docs: DataFrame, parts: int) -> DataFrame:
    """``doc_id, text, guest, part``, sorted within partitions; every partition ends with the first row of the next as guest.

    The text moves once. Only ids are looked at to choose the parts, and one row a part is read again as guest.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = _parts(docs.select("doc_id"), parts)
    placed = docs.withColumn("part", _position(cuts, F.col("doc_id")))
    first = placed.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first"))
    turn = Window.orderBy("part")  # one row a part
    heads = first.select(
        "first.doc_id", F.coalesce(F.lag("part").over(turn), F.max("part").over(Window.partitionBy())).alias("part")
    )
    named = stored(heads, "fingerprint-heads")
    guests = (
        docs.join(F.broadcast(named), docs["doc_id"].eqNullSafe(named["doc_id"]))  # bounded by the number of parts
        .groupBy(named["part"]).agg(F.min(docs["text"]).alias("text"), F.first(docs["doc_id"]).alias("doc_id"))
        .select("doc_id", "text", F.col("part").cast("int").alias("part"), F.lit(True).alias("guest"))
    )
    rows = placed.withColumn("guest", F.lit(False)).unionByName(guests)
    return rows.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_first(), "text")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


EDITS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def against_edits(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, parts: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near they are to it and to the next document's."""
    names = [field.split()[0] for field in EDITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Fingerprinter(bits, shingle)
        held = None
        for batch in small_batches(batches):
            rows = []
            for doc_id, text, guest in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("guest").to_pylist()):
                own = made(text)
                if held is not None:
                    before_id, before, print_ = held
                    changed = edited(before, text)
                    other = made(changed)
                    rows.append((
                        before_id, len(before), hashlib.sha256(changed.encode()).hexdigest(), print_.hex(), other.hex(),
                        likeness(print_, other), likeness(print_, own),
                    ))
                held = None if guest else (doc_id, text, own)
            columns = list(zip(*rows)) or [[] for _ in names]
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.record_batch({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})

    rows = with_successor(docs, parts or width(docs.sparkSession))
    return rows.select("doc_id", "text", "guest").mapInArrow(run, EDITS)
