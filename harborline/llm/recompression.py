"""A run-length grammar of a sequence by recompression, and longest common extensions on it.

Rounds alternate. Block compression replaces every maximal run of one symbol by a symbol of its own. Pair compression splits
the alphabet in two and replaces every pair of neighbours that goes from the first half to the second. Equal stretches are
replaced alike but for their outermost symbols, so two positions are compared by a few symbols a round: upwards as long as what
lies before the next common boundary is equal, then downwards into the first two symbols that differ.

All queries of a batch are answered together, round by round. The sequence must begin and end with symbols that occur once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_MIX = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class _Round:
    """A sequence before a round, and where its symbols went: ``first`` has the first symbol of each symbol of the next sequence."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    blocks: bool


@dataclass
class Grammar:
    """Rounds from the sequence itself up to a single symbol."""

    rounds: list[_Round] = field(default_factory=list)

    @classmethod
    def of(cls, sequence: np.ndarray) -> Grammar:
        grammar, symbols = cls(), sequence.astype(np.int64)
        names, attempt = int(symbols.max(initial=0)) + 1, 0
        while len(symbols) > 1:
            starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
            if len(starts) < len(symbols):
                lengths = np.diff(starts, append=len(symbols))
                symbols, names = grammar._replace(symbols, starts, lengths > 1, lengths, names, True)
                continue
            low = _first_half(symbols, attempt)
            attempt += 1
            rising, falling = low[:-1] & ~low[1:], ~low[:-1] & low[1:]
            pairs = np.flatnonzero(rising if np.count_nonzero(rising) >= np.count_nonzero(falling) else falling)
            if len(pairs):
                kept = np.ones(len(symbols), dtype=bool)
                kept[pairs + 1] = False
                starts = np.flatnonzero(kept)
                changed = np.zeros(len(symbols), dtype=bool)
                changed[pairs] = True
                following = np.append(symbols[1:], 0)[starts]
                symbols, names = grammar._replace(symbols, starts, changed[starts], following, names, False)
        return grammar

    def _replace(self, symbols: np.ndarray, starts: np.ndarray, changed: np.ndarray, second: np.ndarray, names: int, blocks: bool):
        """The next sequence: changed symbols get one name for each (symbol, second), all others stay."""
        parent = np.zeros(len(symbols), dtype=np.int32)
        parent[starts[1:]] = 1
        self.rounds.append(_Round(symbols, np.cumsum(parent, dtype=np.int32), np.append(starts, len(symbols)).astype(np.int32), blocks))
        new = symbols[starts]
        found, named = np.unique(new[changed] << 32 | second[changed], return_inverse=True)
        new[changed] = names + named
        return new, names + len(found)

    def extension(self, x: np.ndarray, y: np.ndarray, step: int = 1) -> np.ndarray:
        """How many symbols from positions ``x`` and ``y`` (x below y) on are equal, forwards, or backwards for ``step`` -1."""
        met = []  # by round: the queries whose first different symbols were met there, and where
        query, a, b = np.arange(len(x)), x.astype(np.int64), y.astype(np.int64)
        for r in self.rounds:
            differ, a, b = _align(r, a, b, step)
            met.append((query[differ], a[differ], b[differ]))
            query, a, b = query[~differ], r.parent[a[~differ]].astype(np.int64), r.parent[b[~differ]].astype(np.int64)
            if not len(query):
                break
        for r, here in zip(self.rounds[len(met) - 1:: -1], reversed(met)):
            a, b = (r.first[p] if step > 0 else r.first[p + 1] - 1 for p in (a, b))
            a, b = _skip(r, a.astype(np.int64), b.astype(np.int64), step)
            query, a, b = (np.concatenate(two) for two in zip((query, a, b), here))
        length = np.zeros(len(x), dtype=np.int64)
        length[query] = (a - x[query]) * step
        return length


def _first_half(symbols: np.ndarray, attempt: int) -> np.ndarray:
    """Half of the alphabet, another one at each attempt."""
    with np.errstate(over="ignore"):
        mixed = (symbols.astype(np.uint64) + np.uint64(attempt + 1) * np.uint64(_MIX)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        return (mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(63) == 0


def _left_in_block(r: _Round, at: np.ndarray, step: int) -> np.ndarray:
    """Symbols from here to the end of the block, in the direction of the step."""
    up = r.parent[at]
    return (r.first[up + 1] - at if step > 0 else at - r.first[up] + 1).astype(np.int64)


def _align(r: _Round, a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Move both positions to a boundary of the next sequence that both have. True where different symbols were met instead."""
    up = r.parent[a], r.parent[b]
    if step > 0:
        inside = (r.first[up[0]] != a) | (r.first[up[1]] != b)
    else:
        inside = (r.first[up[0] + 1] - 1 != a) | (r.first[up[1] + 1] - 1 != b)
    differ = inside & (r.symbols[a] != r.symbols[b])
    move = np.flatnonzero(inside & ~differ)
    if len(move):
        a, b = a.copy(), b.copy()
        if r.blocks:
            left = _left_in_block(r, a[move], step), _left_in_block(r, b[move], step)
            length = np.minimum(*left)
            differ[move] = left[0] != left[1]
        else:
            length = 1
        a[move] += step * length
        b[move] += step * length
    return differ, a, b


def _skip(r: _Round, a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """From the first symbols of two different symbols of the next sequence to those where they differ."""
    same = np.flatnonzero(r.symbols[a] == r.symbols[b])
    if len(same):
        length = np.minimum(_left_in_block(r, a[same], step), _left_in_block(r, b[same], step)) if r.blocks else 1
        a[same] += step * length
        b[same] += step * length
    return a, b
