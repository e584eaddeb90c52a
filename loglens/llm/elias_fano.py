"""Elias-Fano n-gram trie: monotone pointers and quantised probabilities in flat levels.

A level holds the last words of its n-grams, those of one context next to each other and in
order. They become one monotone sequence when every context's words are counted from
the last value of the context before it; the places where the contexts of the next level
begin are monotone anyway. Both are coded in about two bits and the logarithm of the
mean gap a value. A search goes down level by level: within the range of a context it looks
for the first value that is not less than the word. All levels lie in one buffer, which
may be mapped memory, and are read where they lie; searches take arrays.
"""

from __future__ import annotations

import numpy as np

from loglens.llm.common import ship

U64 = np.uint64
ONE = U64(1)
HEADER = 8


def _ones_before(words: np.ndarray) -> np.ndarray:
    """Number of set bits before each 64-bit word, and after the last one."""
    return np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])


def _place_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` (from 0) in each word."""
    place = np.zeros(len(words), np.int64)
    rank, words = rank.copy(), words.copy()
    for width in (32, 16, 8, 4, 2, 1):
        held = np.bitwise_count(words & U64((1 << width) - 1)).astype(np.int64)
        up = rank >= held
        rank -= np.where(up, held, 0)
        place += np.where(up, width, 0)
        words = np.where(up, words >> U64(width), words)
    return place


class Monotone:
    """A sequence that never falls: low bits side by side, high parts in unary."""

    def __init__(self, n, low_bits, low, high):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.ones, self.zeros = _ones_before(high), _ones_before(~high)

    @staticmethod
    def arrays(values: np.ndarray) -> list[np.ndarray]:
        """``[header, low, high]`` of ``values``, all of 64-bit words."""
        values = values.astype(U64)
        n = len(values)
        gap = int(values[-1]) // n if n else 0
        bits = max(0, gap.bit_length() - 1)
        at = np.arange(n, dtype=U64) * U64(bits)
        low = np.zeros((n * bits + 63) // 64 + 1, U64)
        if bits:
            part = values & U64((1 << bits) - 1)
            word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + U64(bits) > U64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        place = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(place[-1]) if n else 0) // 64 + 1, U64)
        np.bitwise_or.at(high, place >> 6, ONE << (place & 63).astype(U64))
        return [np.array([n, bits, len(low), len(high)], U64), low, high]

    def _low_at(self, i):
        if not self.low_bits:
            return np.zeros(len(i), U64)
        at = i.astype(U64) * U64(self.low_bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        found = self.low[word] >> shift
        over = shift + U64(self.low_bits) > U64(64)
        rest = self.low[word + over] << ((U64(64) - shift) & U64(63))
        found |= np.where(over, rest, U64(0))
        return found & U64((1 << self.low_bits) - 1)

    def __getitem__(self, i):
        """Values at the places ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _place_in_word(self.high[word], i - self.ones[word])
        return ((place - i).astype(U64) << U64(self.low_bits) | self._low_at(i)).astype(np.int64)

    def _below(self, part):
        """Number of values whose high part is less than ``part``."""
        zeros = 64 * len(self.high) - self.n
        i = np.clip(part - 1, 0, max(0, zeros - 1))
        word = np.minimum(np.searchsorted(self.zeros, i, side="right"), len(self.high)) - 1
        place = word * 64 + _place_in_word(~self.high[word], i - self.zeros[word])
        # High parts beyond the last zero are beyond the last value.
        return np.where(part <= 0, 0, np.where(part > zeros, self.n, place - i))

    def successor(self, x, first, end):
        """``(places, equal)``: the first value in ``[first, end)`` that is not less than ``x``."""
        part = x >> self.low_bits
        low = np.maximum(self._below(part), first)
        high = np.maximum(np.minimum(self._below(part + 1), end), low)
        target = (x & ((1 << self.low_bits) - 1)).astype(U64)
        alike = high.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            less = self._low_at(middle) < target[active]
            low[active] = np.where(less, middle + 1, low[active])
            high[active] = np.where(less, high[active], middle)
            active = active[low[active] < high[active]]
        # Up to ``alike`` high parts are those of ``x``.
        equal = low < alike
        equal[equal] = self._low_at(low[equal]) == target[equal]
        return np.minimum(low, end), equal


class Trie:
    """Levels of words and pointers, and a code for each n-gram of the last level."""

    def __init__(self, levels, codes):
        self.levels, self.codes = levels, codes

    @staticmethod
    def parts(grams: np.ndarray, codes: np.ndarray) -> list[np.ndarray]:
        """Arrays of the trie of ``grams`` (rows in order, none twice) with their codes."""
        n, order = grams.shape
        parts = [np.array([order, len(codes)], U64)]
        new = np.zeros(n, bool)
        nodes = np.zeros(n, np.int64)
        for k in range(order):
            # A node begins where any word up to here differs from the row before.
            parents = nodes
            new[:1] = True
            new[1:] |= grams[1:, k] != grams[:-1, k]
            rows = np.flatnonzero(new)
            nodes = np.cumsum(new) - 1
            words, owner = grams[rows, k], parents[rows] if k else np.zeros(len(rows), np.int64)
            opens = np.diff(owner, prepend=-1) > 0
            begin = np.flatnonzero(opens)
            if len(words):
                # Each context counts from the last value of the one before it.
                last = words[np.append(begin[1:], len(words)) - 1]
                base = np.concatenate([[0], np.cumsum(last)])[:-1]
                words = words + base[np.cumsum(opens) - 1]
            parts += Monotone.arrays(words)
            parts += Monotone.arrays(np.append(begin, len(words)))
        padded = np.zeros(-(-len(codes) // 8) * 8, np.uint8)
        padded[: len(codes)] = codes
        return [*parts, padded.view(U64)]

    @staticmethod
    def size(parts) -> int:
        return sum(p.nbytes for p in parts)

    @staticmethod
    def write(parts, buffer) -> None:
        """Lays the arrays one after the other into ``buffer``, such as mapped memory."""
        flat, at = np.frombuffer(buffer, U64), 0
        for p in parts:
            flat[at : at + len(p)] = p
            at += len(p)

    @classmethod
    def mapped(cls, buffer) -> Trie:
        """The trie in ``buffer``; nothing is copied."""
        flat = np.frombuffer(buffer, U64)
        order, n = int(flat[0]), int(flat[1])
        at, levels = 2, []

        def monotone():
            nonlocal at
            count, bits, low, high = (int(v) for v in flat[at : at + 4])
            at += 4
            made = Monotone(count, bits, flat[at : at + low], flat[at + low : at + low + high])
            at += low + high
            return made

        for _ in range(order):
            levels.append((monotone(), monotone()))
        return cls(levels, flat[at : at + -(-n // 8)].view(np.uint8)[:n])

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Codes of the rows of ``grams``, 0 for those that are not there.

        Rows should be in order: equal beginnings are then searched once.
        """
        n, order = grams.shape
        found = np.zeros(n, np.uint8)
        if not n or not len(self.codes):
            return found
        new = np.zeros(n, bool)
        context, beginning = np.zeros(1, np.int64), np.zeros(n, np.int64)
        for k in range(order):
            # The range of each different context, then its next words.
            words, pointers = self.levels[k]
            present = context >= 0
            at = np.where(present, context, 0)
            first = pointers[at]
            end = np.where(present, pointers[at + 1], first)
            base = np.where(first > 0, words[np.maximum(first - 1, 0)], 0)
            new[:1] = True
            new[1:] |= grams[1:, k] != grams[:-1, k]
            rows = np.flatnonzero(new)
            at = beginning[rows]
            place, equal = words.successor(grams[rows, k] + base[at], first[at], end[at])
            context, beginning = np.where(equal, place, -1), np.cumsum(new) - 1
        context = context[beginning]
        there = context >= 0
        found[there] = self.codes[context[there]]
        return found


ship(__name__)
