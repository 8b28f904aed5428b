"""Packing documents into training sequences of several lengths.

A document is its token ids and an end id. Windows come in tiers, each a power of two long: a document goes to the shortest
tier that holds it, one longer than the longest window fills such windows first. The tiers are packed from long to short; the
gap that a window's first document leaves is filled with the longest waiting pieces that fit, of its own or shorter tiers, and
closed by cutting a piece. So every window is full; what is left of a partition, less than a window, is cut at powers of two.
Full windows of one tier are numbered in step groups of equal token count.

Packing runs where the documents lie: nothing is shuffled, and no more than ``BUFFER`` tokens and one document wait at a
time. Sequence ids hold the partition in the upper bits.

Defined results: a null or empty text is its end id alone; null ids and repeated rows are documents like any other; an empty
table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import small_batches, texts

TIERS = (4096, 2048, 1024, 512)
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
BUFFER = 1 << 20
#: Tokens of one step group.
STEP_TOKENS = 1 << 16
_ID = np.dtype("<u4")
_PART_BITS = 36
_MAX_KNOWN = 600_000
_AT_ONCE = 4096
_WORD_END = "</w>"
_MARKS = b".,;:!?$%&*"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, "
    "sequence_tokens long, step_group long"
)

_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of texts, for a tokenizer that never joins words across ASCII white space.

    The ids of a word do not depend on its surroundings, so words are looked up as they stand. A new word is taken apart into
    stem and mark where no token can cross, and only new stems go to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # for words that normalizing only turns into lower case
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self._known: dict[bytes, bytes] = {}
        self._stems: dict[bytes, bytes] = {}
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._ends = np.array([str(self._tokenizer.id_to_token(i)).endswith(_WORD_END) for i in range(size)])

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers."""
        known, stems = self._known, self._stems
        for held in (known, stems):
            if len(held) > _MAX_KNOWN:
                held.clear()
        # bytes are cut at ASCII white space alone
        words = [t.encode().split() for t in texts]
        taken = {w: _stem(w) for w in set().union(*words).difference(known)}
        new = [s.decode() for s in {s for parts in taken.values() for s in parts}.difference(stems)]
        letters = [s for s in new if s.isalpha() and max(s) < "\u0100"]
        other = list(set(new).difference(letters))
        for start in range(0, len(new), _AT_ONCE):
            for some, encode in ((letters, self._joined), (other, self._single)):
                part = some[start: start + _AT_ONCE]
                stems.update(zip([s.encode() for s in part], encode(part)))
        for word, parts in taken.items():
            known[word] = b"".join(map(stems.__getitem__, parts))
        return [b"".join(map(known.__getitem__, part)) for part in words]

    def _single(self, stems: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(stems, add_special_tokens=False)
        return [np.array(f.ids, dtype=_ID).tobytes() for f in found]

    def _joined(self, stems: list[str]) -> list[bytes]:
        """The same for words of Latin-1 letters, as one text: the last token of each is its only one that ends a word."""
        [found] = self._plain.encode_batch_fast([" ".join(stems).lower()], add_special_tokens=False)
        ids = np.array(found.ids, dtype=_ID)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(stems):
            return self._single(stems)
        data, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(edges, edges[1:])]


def _stem(word: bytes) -> tuple[bytes, ...]:
    """The word, ASCII words in lower case, apart from the marks behind its last letter.

    A word with a special token's opening stays as it is, since special tokens are matched as written.
    """
    if b"<|" in word:
        return (word,)
    if word.isascii():
        word = word.lower()
    stem = word.rstrip(_MARKS)
    if stem and stem != word and (stem[-1:].isalpha() or stem.decode()[-1].lower().isalpha()):
        return stem, word[len(stem):]
    return (word,)


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class Packer:
    """Packs documents as they come; yields rows of pieces."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, buffer: int = BUFFER, first_sequence: int = 0):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.buffer = buffer
        self._waiting: list[tuple[int, int]] = []  # (length, piece), ascending
        self._pieces: dict[int, tuple] = {}
        self._names = count()
        self._next = first_sequence
        self._first = first_sequence
        self._tokens = 0
        self._filled = dict.fromkeys(self.tiers, 0)

    def _wait(self, doc_id, ids: bytes, start: int, doc_tokens: int) -> None:
        name = next(self._names)
        self._pieces[name] = (doc_id, ids, start, doc_tokens)
        insort(self._waiting, (len(ids) // 4, name))
        self._tokens += len(ids) // 4

    def _take(self, at: int) -> tuple:
        length, name = self._waiting.pop(at)
        self._tokens -= length
        return self._pieces.pop(name)

    def _rows(self, pieces: list[tuple], window: int) -> Iterator[tuple]:
        total = sum(len(p[1]) // 4 for p in pieces)
        group = self._first + self._filled[window] // max(1, STEP_TOKENS // window) if total in self._filled else None
        if group is not None:
            self._filled[window] += 1
        offset = 0
        for doc_id, ids, start, doc_tokens in pieces:
            n = len(ids) // 4
            yield doc_id, start, n, zlib.crc32(ids), doc_tokens, self._next, offset, window, total, group
            offset += n
        self._next += 1

    def _fill(self, window: int) -> list[tuple]:
        """Waiting pieces, longest first, that make up one window exactly; the last one is cut."""
        gap, pieces = window, []
        while gap:
            at = bisect_right(self._waiting, (gap, float("inf")))
            if at:
                piece = self._take(at - 1)
            else:
                doc_id, ids, start, doc_tokens = self._take(0)
                piece = (doc_id, ids[: 4 * gap], start, doc_tokens)
                self._wait(doc_id, ids[4 * gap:], start + gap, doc_tokens)
            pieces.append(piece)
            gap -= len(piece[1]) // 4
        return pieces

    def _pack(self) -> Iterator[tuple]:
        longest = self.tiers[0]
        while self._tokens >= longest:
            most = self._waiting[-1][0]
            window = min((t for t in self.tiers if t >= most), default=longest)
            yield from self._rows(self._fill(window), window)

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, start, longest = len(ids) // 4, 0, self.tiers[0]
        while total - start >= longest:
            yield from self._rows([(doc_id, ids[4 * start: 4 * (start + longest)], start, total)], longest)
            start += longest
        if start < total:
            self._wait(doc_id, ids[4 * start:], start, total)
        if self._tokens >= self.buffer:
            yield from self._pack()

    def finish(self) -> Iterator[tuple]:
        yield from self._pack()
        while self._tokens:
            window = 1 << (self._tokens.bit_length() - 1)
            yield from self._rows(self._fill(window), self.tiers[0] if window not in self._filled else window)


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, buffer: int = BUFFER) -> DataFrame:
    """Rows of ``PIECES``: each id of each document in exactly one piece, sequences without padding."""
    names = [field.split()[0] for field in PIECES.split(", ")]
    end = np.array([end_id], dtype=_ID).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        packer = Packer(tiers, buffer, TaskContext.get().partitionId() << _PART_BITS)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[] for _ in names]
            return pa.record_batch({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns)})

        for batch in small_batches(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts(batch))):
                rows += packer.add(doc_id, ids + end)
            yield out(rows)
        yield out(list(packer.finish()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
