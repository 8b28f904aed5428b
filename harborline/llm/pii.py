"""Personal data by fixed patterns, and further identifiers by bootstrapped contexts.

Fixed patterns find e-mail and network addresses, card and telephone numbers. These seeds induce lexical patterns: the two words
before a seed, together with its kind. Loose candidates are spans that look like a kind but that the fixed patterns turn down.
Patterns and instances form a graph that Spark scores in rounds. In every round, the trusted instances of a kind induce patterns. A
pattern is sure if it passes two tests. Its confidence, the share of trusted occurrences among these and the evidence against it, is
high; against it are its occurrences before anything that cannot be of its kind, or that is trusted as another kind only. And its
score F / N * log2(F) is high, with F the trust in its different instances together and N all its different candidates: a few
trusted instances among many unknown ones do not carry a pattern. Seeds are trusted by 1. An instance of sure patterns is trusted
from the next round on, by their confidences, damped in each round, and more if several patterns agree. Rounds go on until no more
instances are trusted. Occurrences are counted over all texts, so a common phrase before a few seeds stays unsure.

Defined results: a null text counts as empty; a document without spans has counts of 0 and empty strings; null ids and repeated
rows are kept; very long texts are scanned whole; ties in a start go by kind as listed; added spans never overlap base spans or each other; an empty table gives an
empty result; further columns are left out, or carried untouched by ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, stored, texts

#: Kinds of personal data, in the order of the result.
KINDS = ("email", "ip", "card", "phone")
#: A pattern is used from this share of trusted occurrences and this many different trusted instances on.
MIN_CONFIDENCE = 0.8
MIN_SUPPORT = 5
#: Least F / N * log2(F) of a pattern, and what is left of an instance's trust with every round it comes later.
MIN_SCORE = 0.5
DAMPING = 0.8
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What a kind may look like if its context says so.
_LOOSE = {
    "ip": re.compile(r"[0-9]{1,3}(?:[.:_-][0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[\x20.-]?[0-9]){12,18}"),
    "phone": re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}"),
}
_AT = re.compile(r"@|\(at\)|\[at\]")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]+)*")
_DIGIT = re.compile(r"[0-9]")
_BEFORE = re.compile(r"[^\x20\x09-\x0D]+")
_BLOOM_BITS = 24
_CONTEXT = 160
_SPAN = "array<struct<kind:int,start:int,end:int>>"
_FOUND = "array<struct<kind:int,start:int,end:int,context:bigint,piece:bigint,instance:bigint>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str, sign: re.Pattern = re.compile("@"), domain: re.Pattern = _DOMAIN) -> list[tuple[int, int, int]]:
    """Leftmost addresses, each sign looked at once: what stands before it is taken as far as it goes."""
    found, last = [], 0
    for at in sign.finditer(text):
        start = at.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        rest = domain.match(text, at.end()) if last <= start < at.start() else None
        if rest:
            last = rest.end()
            found.append((start, 0, last))
    return found


def _addresses(text: str) -> list[tuple[int, int, int]]:
    """Leftmost runs of four numbers of a dotted chain, kept if all are at most 255."""
    found = []
    for chain in _DOTTED.finditer(text):
        numbers, start = chain[0].split("."), chain.start()
        for i in range(0, len(numbers) - 3, 4):
            part = numbers[i: i + 4]
            end = start + sum(map(len, part)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in part):
                found.append((start, 1, end))
            start = end + 1
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order."""
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        found += _addresses(text)
        for m in _CARD.finditer(text):
            digits = "".join(_DIGIT.findall(m[0]))
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(found)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of every kind apart from all base spans, in order; those of different kinds may overlap."""
    met = []
    if _AT.search(text):
        met += _emails(text, _AT, _LOOSE_DOMAIN)
    if _DIGIT.search(text):
        met += [(m.start(), kind, m.end()) for kind in (1, 2, 3) for m in _LOOSE[KINDS[kind]].finditer(text)]
    starts = [start for start, _, _ in base]
    reach = list(accumulate((end for _, _, end in base), max))
    apart = lambda start, end: (n := bisect_left(starts, end)) == 0 or reach[n - 1] <= start
    return sorted(m for m in met if apart(m[0], m[2]))


def chosen(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of ``(start, kind, end, confidence)`` that overlap the first, then the longest, the surest, then by kind."""
    out, last = [], 0
    for start, minus_end, _, kind in sorted((s, -e, -c, k) for s, k, e, c in spans):
        if start >= last:
            out.append((start, kind, -minus_end))
            last = -minus_end
    return out


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower().encode())


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = first * np.uint64(0x9E3779B97F4A7C15) ^ second
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).astype(np.int64)


def contexts_of(text: str, starts: list[int]) -> list[tuple[int, int | None]]:
    """For every start the hash of the two words before it, and the hash of what of a word stands directly before it, if any.

    That piece is the second of the two words; nothing counts as an empty word, and of long words the last characters count.
    """
    if not starts:
        return []
    words = [m.span() for m in _BEFORE.finditer(text)]
    begins = [begin for begin, _ in words]
    name = lambda at, end: word_hash(text[max(words[at][0], end - _CONTEXT): end]) if at >= 0 else word_hash("")
    firsts, seconds, pieces = [], [], []
    for start in starts:
        at = bisect_left(begins, start) - 1
        end = min(start, words[at][1]) if at >= 0 else 0
        seconds.append(name(at, end))
        firsts.append(name(at - 1, words[at - 1][1]) if at > 0 else word_hash(""))
        pieces.append(_signed(seconds[-1]) if at >= 0 and start < words[at][1] else None)
    return list(zip(_pair(np.array(firsts, dtype=np.uint64), np.array(seconds, dtype=np.uint64)).tolist(), pieces))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _instance(text: str) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest("".join(text.lower().split()).encode())).astype(np.int64).item()


def scan(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text_hash, base, loose``: spans with contexts, one row a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_type = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")] + [(n, pa.int64()) for n in ("context", "piece", "instance")]))
        for batch in small_batches(batches):
            both: tuple[list, list] = ([], [])
            for text in texts(batch):
                base = base_spans(text)
                for out, spans in zip(both, (base, loose_spans(text, base))):
                    out.append([
                        {"kind": k, "start": s, "end": e, "context": c, "piece": p, "instance": _instance(text[s:e])}
                        for (s, k, e), (c, p) in zip(spans, contexts_of(text, [s for s, _, _ in spans]))
                    ])
            yield pa.record_batch({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "base": pa.array(both[0], as_type), "loose": pa.array(both[1], as_type),
            })

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"row long, doc_id long, text_hash long, base {_FOUND}, loose {_FOUND}")


def _bitmap(values: DataFrame, column: str) -> np.ndarray:
    bits = values.select(F.pmod(column, F.lit(1 << _BLOOM_BITS)).cast("int").alias("bit")).distinct()
    bitmap = np.zeros(1 << _BLOOM_BITS, dtype=bool)
    for r in bits.groupBy(F.shiftright("bit", 12).alias("block")).agg(F.collect_set("bit").alias("bits")).toLocalIterator():
        bitmap[r["bits"]] = True
    return np.packbits(bitmap)


def context_counts(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """``context, total``: how often each of ``context, piece`` occurs in all texts, before any word or, a piece, within one.

    Bitmaps of fixed size let tasks pass over most other word pairs and pieces; the join then decides.
    """
    pieces = contexts.filter("piece is not null")
    shared = docs.sparkSession.sparkContext.broadcast((_bitmap(contexts, "context"), _bitmap(pieces, "piece")))
    mask = (1 << _BLOOM_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, glued = (np.unpackbits(b).astype(bool) for b in shared.value)
        known: dict[str, tuple[int, list[int]]] = {}
        empty = word_hash("")
        for batch in small_batches(batches):
            counts: Counter = Counter()
            if len(known) > 200_000:
                known.clear()
            for text in texts(batch):
                hashes, firsts, seconds = [empty, empty], [], []
                for w in _BEFORE.findall(text):
                    met = known.get(w)
                    if met is None:
                        starts = (word_hash(w[max(0, end - _CONTEXT): end]) for end in range(1, len(w)))
                        met = known[w] = word_hash(w[-_CONTEXT:]), [h for h in starts if glued[h & mask]]
                    if met[1]:
                        firsts += hashes[-1:] * len(met[1])
                        seconds += met[1]
                    hashes.append(met[0])
                h = np.array(hashes, dtype=np.uint64)
                pairs = np.concatenate([_pair(h[:-2], h[1:-1]), _pair(np.array(firsts, dtype=np.uint64), np.array(seconds, dtype=np.uint64))])
                counts.update(pairs[wanted[pairs & mask]].tolist())
            yield pa.record_batch({"context": pa.array(list(counts), pa.int64()), "n": pa.array(list(counts.values()), pa.int64())})

    met = docs.select("text").mapInArrow(run, "context long, n long").groupBy("context").agg(F.sum("n").alias("total"))
    return met.join(contexts.select("context").distinct(), "context")


def sure_patterns(scanned: DataFrame, docs: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_support: int = MIN_SUPPORT,
                  min_score: float = MIN_SCORE, damping: float = DAMPING) -> DataFrame:
    """``kind, context, confidence``: patterns that are sure after the last round."""
    spans = lambda c: scanned.select(F.explode(c).alias("s"), F.lit(c == "base").alias("seed")).select("s.*", "seed")
    both = spans("base").unionByName(spans("loose"))
    met = stored(
        both.groupBy("kind", "context", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed"), F.max("piece").alias("piece")), "pii-met"
    )
    # no pattern can ever have more trusted instances than candidates, so these are all that may become sure in any round
    possible = met.groupBy("kind", "context").agg(F.count("*").alias("different"), F.sum("n").alias("candidates"), F.max("piece").alias("piece"))
    possible = stored(possible.filter(F.col("different") >= min_support), "pii-possible")
    totals = stored(context_counts(docs, possible.groupBy("context").agg(F.max("piece").alias("piece"))), "pii-totals")
    against = possible.join(totals, "context").select("kind", "context", "different", (F.col("total") - F.col("candidates")).alias("others"))
    graph = stored(met.select("kind", "context", "instance", "n").join(against, ["kind", "context"]), "pii-graph")
    trusted = stored(met.filter("seed").select("kind", "instance").distinct().withColumn("trust", F.lit(1.0)), "pii-trusted")
    before, late = trusted.count(), 1.0
    while True:
        late *= damping
        known = trusted.groupBy("instance").agg(F.map_from_entries(F.collect_list(F.struct("kind", "trust"))).alias("kinds"))
        trust = F.coalesce(F.try_element_at("kinds", F.col("kind")), F.lit(0.0))
        own = trust > 0
        scored = graph.join(known, "instance").groupBy("kind", "context").agg(
            F.sum(F.when(own, F.col("n")).otherwise(0)).alias("hits"), F.sum(F.when(own, 0).otherwise(F.col("n"))).alias("misses"),
            F.sum(own.cast("int")).alias("instances"), F.sum(trust).alias("f"), F.max("others").alias("others"), F.max("different").alias("different"),
        )
        scored = scored.withColumn("confidence", F.col("hits") / (F.col("hits") + F.col("misses") + F.greatest("others", F.lit(0))))
        score = F.col("f") / F.col("different") * F.log2("f")
        is_sure = (F.col("confidence") >= min_confidence) & (F.col("instances") >= min_support) & (F.round(score, 9) >= min_score)
        sure = stored(scored.filter(is_sure).select("kind", "context", "confidence"), "pii-sure")
        # several patterns confirm an instance; what is trusted stays so, hence the rounds come to an end
        doubt = F.sum(F.log(F.greatest(F.lit(1.0) - F.lit(late) * F.col("confidence"), F.lit(1e-12))))
        new = graph.join(sure, ["kind", "context"]).groupBy("kind", "instance").agg((F.lit(1.0) - F.exp(doubt)).alias("trust"))
        trusted = stored(trusted.unionByName(new).groupBy("kind", "instance").agg(F.max("trust").alias("trust")), "pii-trusted")
        now = trusted.count()
        if now == before:
            return sure
        before = now


def find(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_support: int = MIN_SUPPORT) -> DataFrame:
    """``row, doc_id, text_hash, base, added``: for every document the base spans and those that sure patterns add."""
    scanned = stored(scan(docs), "pii-scan")
    sure = sure_patterns(scanned, docs, min_confidence, min_support)
    loose = scanned.select("row", F.explode("loose").alias("s")).select("row", "s.kind", "s.start", "s.end", "s.context")
    added = loose.join(sure, ["kind", "context"]).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "confidence")).alias("met"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_type = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")]))
        for batch in small_batches(batches):
            picked = [chosen([(m["start"], m["kind"], m["end"], m["confidence"]) for m in met]) for met in batch.column("met").to_pylist()]
            spans = [[{"kind": k, "start": s, "end": e} for s, k, e in p] for p in picked]
            yield pa.record_batch({"row": batch.column("row"), "added": pa.array(spans, as_type)})

    added = added.mapInArrow(choose, f"row long, added {_SPAN}")
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.select("row", "doc_id", "text_hash", plain.alias("base")).join(added, "row", "left").select(
        "row", "doc_id", "text_hash", "base", F.coalesce("added", F.array().cast(_SPAN)).alias("added")
    )


def report(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = lambda spans: F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    shown = lambda spans: F.array_join(
        F.transform(ordered(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id", *[of(k) for k in range(len(KINDS))], F.sha2(shown("base").cast("binary"), 256).alias("base_sha256"),
        shown(F.concat("base", "added")).alias("spans"),
    )


def blanked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or what overlapping spans cover together, replaced by its kind in capitals."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += (text[at:start], f"[{KINDS[kind].upper()}]")
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_support: int = MIN_SUPPORT) -> DataFrame:
    """All columns; in ``text`` the personal data is replaced by its kind, and ``n_chars`` is the new length."""
    keys = {"_key_id": F.col("doc_id"), "_key_text": F.xxhash64("text")}
    found = find(docs.select("doc_id", "text"), min_confidence, min_support).filter(F.size("added") > 0)
    # equal rows have equal spans, so the id and the text's hash say which are meant
    added = found.select(F.col("doc_id").alias("_to_id"), F.col("text_hash").alias("_to_text"), "added").dropDuplicates(["_to_id", "_to_text"])
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in keys.items()])
    same = F.col("_key_id").eqNullSafe(F.col("_to_id")) & (F.col("_key_text") == F.col("_to_text"))
    spans = F.transform("added", lambda s: F.array(s["start"], s["kind"], s["end"]))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            columns = dict(zip(schema.names, batch.column("row").flatten()))
            new = []
            for text, more in zip(columns["text"].to_pylist(), batch.column("spans").to_pylist()):
                new.append(text if text is None else blanked(text, base_spans(text) + [tuple(s) for s in more or ()]))
            columns["text"] = pa.array(new, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in new], columns["n_chars"].type)
            yield pa.record_batch(columns)

    return rows.join(added, same, "left").select("row", spans.alias("spans")).mapInArrow(run, schema)

