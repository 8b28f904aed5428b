"""SimHash near-duplicates by multi-index hashing, and their connected components.

A fingerprint is two segments of 32 bits. Two fingerprints with at most two differing bits differ by at most one bit in one
of the segments, so each is found by looking up the Hamming ball of radius one around the other's segment. A segment alone is
a weak key where many fingerprints are alike, so every table is keyed by a block of the other segment as well; the other
segment has at most two, or one, differing bits left, hence one of three, or two, blocks of it is equal. Matches are verified
over all 64 bits. Copies share a fingerprint and are one row throughout; links are between distinct fingerprints.

Defined results: a null text counts as empty; a text without words has fingerprint zero and is linked like any other; null
ids are never the id of a component unless all its ids are null; repeated rows count each; an empty table gives an empty
result; further columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import WORD, small_batches, stored, texts

SEED = 42
SHINGLE = 3
RADIUS = 2
_WORDS = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BLOCK = 16_384


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 hashes of all shingles, as an unsigned number."""
    words = [w.encode() for w in _WORDS.findall(text.translate(_LOWER))]
    if not words:
        return 0
    n = min(shingle, len(words))
    total = len(words) - n + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, _BLOCK):
        stop = min(start + _BLOCK, total)
        shifted = [words[start + i: stop + i] for i in range(n)]
        hashes = np.array([digest(s, SEED) for s in map(b" ".join, zip(*shifted))], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def add_fingerprint(docs: DataFrame, column: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """All columns and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            prints = np.array([simhash(t, shingle) for t in texts(batch)], dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], names=[*batch.schema.names, column])

    schema = docs.schema
    return docs.mapInArrow(run, type(schema)([*schema.fields]).add(column, "long"))


def _segments(fp: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _blocks(segment: Column, bounds: tuple[int, ...]) -> list[Column]:
    edges = [0, *bounds, 32]
    return [
        F.shiftright(segment, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) for low, high in zip(edges, edges[1:])
    ]


def _key(table: int, segment: Column, block: Column) -> Column:
    """Table number, segment and block in one long: 4, 32 and at most 16 bits."""
    return F.lit(table << 48).bitwiseOR(F.shiftleft(segment, 16)).bitwiseOR(block).cast("long")


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: all pairs of the distinct fingerprints ``fp`` that differ in one or two bits, each pair once, a below b."""
    high, low = _segments(F.col("fp"))
    stored_keys, probe_keys = [], []
    for number, (own, other) in enumerate(((high, low), (low, high))):
        # this segment equal: two bits at most differ in the other one
        for i, block in enumerate(_blocks(other, (11, 22))):
            stored_keys.append(_key(5 * number + i, own, block))
            probe_keys.append(_key(5 * number + i, own, block))
    for i, block in enumerate(_blocks(low, (16,))):
        # one bit differs in the high segment: one at most in the low one
        stored_keys.append(_key(10 + i, high, block))
        probe_keys += [_key(10 + i, high.bitwiseXOR(F.lit(1 << bit)), block) for bit in range(32)]
    probes = prints.select(F.col("fp").alias("a"), F.explode(F.array(*probe_keys)).alias("key"))
    entries = prints.select(F.col("fp").alias("b"), F.explode(F.array(*stored_keys)).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return probes.join(entries, "key").filter((F.col("a") < F.col("b")) & (near <= RADIUS)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from every node of ``a, b``.

    Alternates two kinds of rounds until nothing changes: every node hands its larger neighbours its smallest neighbour,
    then its smaller ones. A chain of n nodes needs about log n rounds; only one row a link moves, and smallest neighbours
    are aggregated before the shuffle.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u <> v").distinct(), "links")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id, root``: component_id is the smallest doc_id of the component, root its smallest fingerprint."""
    marked = stored(add_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "fp"), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    linked = components(links(classes.select("fp")))
    rooted = classes.join(linked, classes["fp"] == linked["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def unsigned_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates of a smaller doc_id; of each component one row stays."""
    found = groups(docs)
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.fp").alias("_kept_fp"))
    rows = add_fingerprint(docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), "text"), "_fp").drop("text")
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_fp") == F.col("_kept_fp"))
    one = rows.join(kept, same, "left_semi").dropDuplicates(["_fp", "_id"])
    return one.select("row.*")
