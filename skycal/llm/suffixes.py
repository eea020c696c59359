"""Suffixes in order with their common prefixes, by induced sorting over disk-backed bucket queues, in numpy."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np

SEPARATOR, FIRST = 1, 2        # symbols: 0 ends the text, 1 ends a string, then bytes
ALPHABET = 256 + FIRST
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
FAR = np.int32(1 << 30)
PAIRS = 1 << 16                # whose common prefixes are looked for at once


class BucketQueue:
    """Priority queue of (symbol, arrival): what was put under a symbol is taken in the order of arrival. Tuples of a
    suffix and the prefix it shares with the one before it are kept in memory up to a limit, then go to files."""

    def __init__(self, memory: int) -> None:
        self.memory, self.size, self.folder = memory, 0, ""
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def put(self, symbol: int, suffix: np.ndarray, shared: np.ndarray) -> None:
        self.held.setdefault(symbol, []).append((suffix, shared))
        self.size += suffix.nbytes + shared.nbytes
        if self.size > self.memory:
            self.folder = self.folder or tempfile.mkdtemp(prefix="queue-")
            for s, parts in self.held.items():
                for name, k in (("suffix", 0), ("shared", 1)):
                    with open(f"{self.folder}/{s}-{name}", "ab") as f:
                        for part in parts:
                            f.write(part[k].tobytes())
            self.held, self.size = {}, 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts = self.held.pop(symbol, [])
        self.size -= sum(a.nbytes + b.nbytes for a, b in parts)
        if self.folder and os.path.exists(f"{self.folder}/{symbol}-suffix"):
            files = [f"{self.folder}/{symbol}-{name}" for name in ("suffix", "shared")]
            parts.insert(0, tuple(np.fromfile(f, np.int32) for f in files))
            for f in files:
                os.remove(f)
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])

    def close(self) -> None:
        if self.folder:
            shutil.rmtree(self.folder)


class Hashes:
    """Prefix hashes of a text; the common prefix of pairs of suffixes by bisection."""

    def __init__(self, text: np.ndarray) -> None:
        powers = np.full(len(text), _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        self.sums[1:] = text
        self.sums[1:] += np.uint64(7)
        self.sums[1:] *= powers
        np.cumsum(self.sums, out=self.sums)
        powers[1:] = _INVERSE
        powers[0] = 1
        self.back = np.multiply.accumulate(powers, out=powers)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def shared(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common prefix of the suffixes a[k] and b[k], at most `most`."""
        if len(a) > PAIRS:
            return np.concatenate([self.shared(a[k:k + PAIRS], b[k:k + PAIRS], most) for k in range(0, len(a), PAIRS)])
        n = len(self.back)
        low, high = np.zeros(len(a), np.int32), np.minimum(most, n - np.maximum(a, b)).astype(np.int32)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.of(a, a + middle) == self.of(b, b + middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low


def _induced(text: np.ndarray, wanted: np.ndarray, order: range, seeds: Callable, hashes: Hashes | None, most: int, memory: int
             ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(symbol, suffixes, shared prefix with the one before) of the wanted suffixes, symbol by symbol in `order`.

    Every sorted suffix puts the one that begins before it into the queue of its first symbol; in a queue, two
    neighbours share one symbol more than the least that their origins share. What falls into the symbol at hand
    is the next batch. After them come the seeds of the symbol, sorted by those who call."""
    queue, since = BucketQueue(memory), np.full(ALPHABET, FAR, np.int32)

    def put(suffix: np.ndarray, shared: np.ndarray, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        own = np.zeros(0, np.int32), np.zeros(0, np.int32)
        if not len(suffix):
            return own
        place = np.flatnonzero((suffix > 0) & wanted[suffix - 1])
        before = text[suffix[place] - 1]
        last = since if hashes is None else np.minimum(since, shared.min())
        for s in np.flatnonzero(np.bincount(before, minlength=ALPHABET)).tolist() if len(place) else []:
            at = place[before == s]
            if hashes is None:
                value = np.zeros(len(at), np.int32)
            else:
                value = np.empty(len(at), np.int32)
                value[0] = min(since[s], shared[: at[0] + 1].min())
                if len(at) > 1:
                    value[1:] = np.minimum.reduceat(shared[at[0] + 1: at[-1] + 1], at[:-1] - at[0])
                value = np.minimum(value + 1, most)
                last[s] = shared[at[-1] + 1:].min(initial=FAR)
            if s == symbol:
                own = suffix[at] - 1, value
            else:
                queue.put(s, suffix[at] - 1, value)
        since[:] = last
        return own

    try:
        for symbol in order:
            batch, found = queue.take(symbol), []
            if len(batch[1]):
                batch[1][0] = 0
            while len(batch[0]):
                found.append(batch)
                batch = put(*batch, symbol)
            suffix, shared = (np.concatenate(x) for x in zip(*found)) if found else batch
            yield symbol, suffix, shared
            own, own_shared = seeds(symbol)
            if len(own):
                own_shared = own_shared.copy()
                own_shared[0] = hashes.shared(suffix[-1:], own[:1], most)[0] if hashes is not None and len(suffix) else 0
                put(own, own_shared, symbol)
    finally:
        queue.close()


def _by_symbol(text: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Where each symbol begins among suffixes that are sorted by their first."""
    return np.searchsorted(text[suffixes], np.arange(ALPHABET + 1))


def _ranks(names: np.ndarray, span: int, most: int) -> np.ndarray:
    """Ranks of the suffixes of a string of names, by at least `most` of the symbols beneath, each name standing for
    half of `span` or more: names of pairs of neighbours, and so on."""
    if span >= 2 * most or names.max(initial=0) + 1 == len(names):
        return names
    other = np.zeros_like(names)
    step = span // 2
    other[: max(len(names) - step, 0)] = names[step:] + 1
    pair = names * (int(names.max()) + 2) + other
    order = np.argsort(pair)
    new = np.empty_like(names)
    new[order] = np.cumsum(np.diff(pair[order], prepend=pair[order[:1]]) != 0)
    return _ranks(new, 2 * span, most)


def repeated(strings: list[bytes], length: int, memory: int = 32 << 20) -> list[np.ndarray]:
    """For each string, which of its places begin `length` bytes that begin somewhere else in the strings, too.

    Suffixes are sorted by induction: the leftmost smaller ones first, by names of their pieces, then the larger
    and the smaller ones from them, with the prefix that neighbours share (`length` at most). Neighbours that
    share `length` bytes are the repeats."""
    sizes = np.array([len(s) for s in strings])
    if not len(sizes):
        return []
    body = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    text = np.empty(int(sizes.sum()) + len(sizes) + 1, np.uint16)
    inside = np.ones(len(text), bool)
    inside[ends] = inside[-1] = False
    text[inside], text[ends], text[-1] = body + np.uint16(FIRST), SEPARATOR, 0
    n = len(text)
    # A place is smaller (than what follows it) by the next symbol that differs from its own.
    change = np.flatnonzero(text[:-1] != text[1:])
    rise = text[change] < text[change + 1]
    smaller = np.append(np.repeat(rise, np.diff(change, prepend=-1)), True)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + 1
    hashes = Hashes(text)

    def sorted_suffixes(seeds: np.ndarray, seeds_shared: np.ndarray, use: Hashes | None):
        """(larger, its shared prefixes, smaller, its shared prefixes), each by symbol; seeds sorted by first symbol."""
        at = _by_symbol(text, seeds)
        larger = {c: (s, p) for c, s, p in _induced(text, ~smaller, range(ALPHABET), lambda c: (seeds[at[c]:at[c + 1]], seeds_shared[at[c]:at[c + 1]]), use, length, memory)}

        def down(c):
            s, p = larger[c]
            return s[::-1], np.append(p[1:], np.int32(0))[::-1]

        return larger, {c: (s, p) for c, s, p in _induced(text, smaller, range(ALPHABET - 1, -1, -1), down, use, length, memory)}

    # Pieces between leftmost smaller places, in order: seeds need only be sorted by symbol.
    seeds = leftmost[np.argsort(text[leftmost], kind="stable")]
    small = sorted_suffixes(seeds, np.zeros(len(seeds), np.int32), None)[1]
    in_order = np.concatenate([small[c][0][::-1] for c in range(ALPHABET)])
    del small
    is_left = np.zeros(n, bool)
    is_left[leftmost] = True
    in_order = np.append(np.int32(n - 1), in_order[is_left[in_order] & (in_order != n - 1)])
    number = np.zeros(n, np.int32)
    number[leftmost] = np.arange(len(leftmost))
    piece_end = np.append(leftmost[1:] + 1, n)
    start, end = in_order, piece_end[number[in_order]]
    key = hashes.of(start, end)
    new = np.append(False, (np.diff(key) != 0) | (np.diff(end - start) != 0))
    names = np.empty(len(leftmost), np.int64)
    names[number[in_order]] = np.cumsum(new)
    seeds = leftmost[np.argsort(_ranks(names, 2, length), kind="stable")]
    del in_order, is_left, number, piece_end, start, end, key, new, names
    shared = np.zeros(len(seeds), np.int32)
    shared[1:] = hashes.shared(seeds[:-1], seeds[1:], length)
    large, small = sorted_suffixes(seeds, shared, hashes)

    twice = np.zeros(n, bool)
    for c in range(FIRST, ALPHABET):
        (a, p), (b, q) = large[c], small[c]
        b, q = b[::-1], np.append(q[1:], np.int32(0))[::-1]
        if len(b):
            q = q.copy()
            q[0] = hashes.shared(a[-1:], b[:1], length)[0] if len(a) else 0
        suffix, both = np.concatenate([a, b]), np.concatenate([p, q])
        hit = np.flatnonzero(both >= length)
        twice[suffix[hit]] = True
        twice[suffix[hit - 1]] = True
    starts = np.append(0, ends[:-1] + 1)
    return [twice[s:s + max(m - length + 1, 0)] for s, m in zip(starts.tolist(), sizes.tolist())]
