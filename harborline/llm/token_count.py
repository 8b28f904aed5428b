"""Token counts by a byte-level BPE compiled to a deterministic transducer.

A token sequence is the encoding of a text exactly if every two neighbours encode to themselves, so after every prefix the
last token is decided by the last tokens of earlier prefixes. A state of the transducer holds what later bytes can still ask
for: the open vocabulary prefixes that end here, each with the token before it and the tokens counted since. A transition
reads one byte and emits the change of the count. States and transitions are compiled from the vocabulary when first met.

A text is cut into chunks anywhere. The state map of a chunk is the same for all entry states but for its head, up to the first
place where a word must end, and its tail behind the last such place: head, count, tail. Two maps compose by counting
what lies between them; that is associative, so the maps of a document's chunks are reduced in pairs.

Defined results: a null text counts as empty and has no tokens; null ids and repeated rows are kept; the string of the special
token inside a text is one token; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, texts

TOKENIZER = "byte_bpe_50k.json"
CHUNK = 1 << 16
LIMIT = 512
#: The pattern that byte-level BPE splits text by, as the vocabulary's library defines it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Between a character and the white space behind it every word ends.
_WORD_END = regex.compile(r"\S\s")
_LAST_WORD_END = regex.compile(r"(?r)\S\s")
_MAX_STATES = 300_000
_MAX_WORDS = 200_000
_NODE_BITS = 24

_COMPILED: dict[str, "TokenCounter"] = {}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Counts the tokens of words; states are compiled on first use and forgotten when they get too many.

    Tokens and their prefixes are nodes of a trie and stand for themselves as numbers; 0 is the empty prefix.
    """

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        made: dict[bytes, tuple[bytes, bytes, int]] = {}
        for i, (a, b) in enumerate(merges):
            made.setdefault(a + b, (a, b, i))
        self._next: dict[int, int] = {}
        self._inner: set[int] = set()
        nodes = {b"": 0}
        tokens = [t for t in vocab if len(t) == 1 or t in made]
        for token in tokens:
            for i in range(1, len(token) + 1):
                if token[:i] not in nodes:
                    above = nodes[token[: i - 1]]
                    nodes[token[:i]] = self._next[above << 8 | token[i - 1]] = len(nodes)
                    self._inner.add(above)
        self._tokens = {nodes[t] for t in tokens}
        self._rank = {nodes[a] << _NODE_BITS | nodes[b]: i for i, (a, b) in enumerate(merges) if a in nodes and b in nodes}
        self._parts = {nodes[t]: (nodes[a], nodes[b], i) for t, (a, b, i) in made.items() if t in nodes}
        self._borders: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self._fits: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self._states: list[tuple] = [((0, 0, 0),)]
        self._numbers = {self._states[0]: 0}
        self._moves: dict[int, tuple[int, int]] = {}

    def _border(self, token: int, side: int) -> list[tuple[int | None, int]]:
        """Pieces of a token at its right (side 1) or left (0) end, innermost first, each with the rank that merges it away."""
        known = self._borders[side].get(token)
        if known is None:
            known, gone, piece = [(None, token)], None, token
            while piece in self._parts:
                parts = self._parts[piece]
                piece, gone = parts[side], parts[2]
                known.append((gone, piece))
            known.reverse()
            self._borders[side][token] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, encode to themselves.

        They do not if a merge across the border would come before the merges that take the pieces on either side of it away.
        On equal terms the leftmost merge is first: one inside the left token, then one across, then one inside the right.
        """
        key = left << _NODE_BITS | right
        known = self._fits.get(key)
        if known is not None:
            return known
        if len(self._fits) > 4 * _MAX_STATES:
            self._fits.clear()
        a, b = self._border(left, 1), self._border(right, 0)
        i = j = 0
        known = True
        while True:
            gone_a, piece_a = a[i]
            gone_b, piece_b = b[j]
            across = self._rank.get(piece_a << _NODE_BITS | piece_b)
            if across is not None and (gone_a is None or across < gone_a) and (gone_b is None or across <= gone_b):
                known = False
                break
            if gone_a is None and gone_b is None:
                break
            if gone_b is None or (gone_a is not None and gone_a <= gone_b):
                i += 1
            else:
                j += 1
        self._fits[key] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        last = delta = 0
        opened = []
        inner, tokens, follow = self._inner, self._tokens, self._next
        for prefix, before, since in self._states[state]:
            node = follow.get(prefix << 8 | byte)
            if node is not None:
                if node in tokens and (not before or self.fits(before, node)):
                    last, delta = node, 1 - since
                if node in inner:
                    opened.append((node, before, since))
        # counts are kept relative to the count after this byte
        after = ((0, last, 0), *[(p, before, since + delta) for p, before, since in opened])
        if len(self._states) > _MAX_STATES:
            self._reset()
            raise _Forgotten
        number = self._numbers.get(after)
        if number is None:
            number = self._numbers[after] = len(self._states)
            self._states.append(after)
        move = self._moves[state << 8 | byte] = (number, delta)
        return move

    def count(self, word: bytes) -> int:
        while True:
            try:
                state = total = 0
                moves = self._moves
                for byte in word:
                    move = moves.get(state << 8 | byte)
                    state, delta = move or self._compile(state, byte)
                    total += delta
                return total
            except _Forgotten:
                continue


class _Forgotten(Exception):
    """The states were dropped; the word starts again."""


class TokenCounter:
    """Counts of texts, chunk maps and their composition for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        special = [t["content"] for t in content["added_tokens"]]
        plain = lambda token: bytes(letters[c] for c in token)
        vocab = {plain(t): i for t, i in content["model"]["vocab"].items() if t not in special}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        self.transducer = Transducer(vocab, [(plain(a), plain(b)) for a, b in pairs])
        self._split = regex.compile(PATTERN).findall
        self._special = special
        self._words: dict[str, int] = {}

    def count(self, text: str) -> int:
        """Tokens of a text that starts and ends where words end."""
        total = 0
        pieces = [text]
        for token in self._special:
            if token in text:
                pieces = [q for p in pieces for q in p.split(token)]
                total += text.count(token)
        words = self._words
        if len(words) > _MAX_WORDS:
            words.clear()
        for piece in pieces:
            for word in self._split(piece):
                n = words.get(word)
                if n is None:
                    n = words[word] = self.transducer.count(word.encode())
                total += n
        return total

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """Head, tokens between, tail; a chunk in which no word need end is all head and has no tail."""
        first = _WORD_END.search(chunk)
        if first is None:
            return chunk, 0, None
        start, end = first.start() + 1, _LAST_WORD_END.search(chunk).start() + 1
        return chunk[:start], self.count(chunk[start:end]) if start < end else 0, chunk[end:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[2] is None and b[2] is None:
            return self._joined(a[0] + b[0])
        if a[2] is None:
            head = self._joined(a[0] + b[0])
            return (head[0], head[1] + b[1], b[2]) if head[2] is None else (head[0], head[1] + self.count(head[2]) + b[1], b[2])
        if b[2] is None:
            tail = self._joined(a[2] + b[0])
            return (a[0], a[1], tail[0]) if tail[2] is None else (a[0], a[1] + self.count(tail[0]) + tail[1], tail[2])
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def _joined(self, text: str) -> tuple:
        """Map of two open pieces side by side: a word may have to end just between them."""
        return self.chunk_map(text) if _WORD_END.search(text) else (text, 0, None)

    def total(self, maps: list[tuple]) -> int:
        """Composes neighbours in pairs, level by level, and closes the ends."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i: i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, between, tail = maps[0]
        return self.count(head) + between + (self.count(tail) if tail else 0)


def counter(path: str) -> TokenCounter:
    """One compiled vocabulary a worker process, kept between tasks."""
    if path not in _COMPILED:
        _COMPILED[path] = TokenCounter(path)
    return _COMPILED[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.greatest(F.ceil(F.length(text) / chunk), F.lit(1)).cast("int").alias("chunks"),
    )
    cut = rows.select("row", "doc_id", "text", "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).select(
        "row", "doc_id", "chunk", F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("text")
    )

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(tokenizer_path)
        for batch in small_batches(batches):
            chunks = texts(batch)
            heads, between, tails = zip(*map(made.chunk_map, chunks)) if chunks else ((), (), ())
            yield pa.record_batch({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "chunk": batch.column("chunk"),
                "n_bytes": pa.array([len(c.encode()) for c in chunks], pa.int64()), "head": pa.array(heads, pa.string()),
                "between": pa.array(between, pa.int64()), "tail": pa.array(tails, pa.string()),
            })

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(tokenizer_path)
        for batch in small_batches(batches):
            counts = [made.total([(m["head"], m["between"], m["tail"]) for m in row]) for row in batch.column("maps").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(counts, pa.int64()),
                "over_limit": pa.array([c > limit for c in counts], pa.bool_()),
            })

    mapped = cut.mapInArrow(maps, "row long, doc_id long, chunk int, n_bytes long, head string, between long, tail string")
    whole = mapped.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("chunk", "head", "between", "tail"))).alias("maps"),
    )
    return whole.select("doc_id", "n_bytes", "maps").mapInArrow(totals, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
