"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words of a document that repeats with its smallest period
q (words q apart are equal), is at least ``max(least, 2 * q)`` words long and cannot be
extended on either side keeping q.

1. Ranks.  Words are numbered within their document, and the ranks of all blocks of 1, 2,
   4, ... words are made by doubling; they stop when no block occurs twice in its
   document.  The last ranks give the suffix array; the ranks of one level tell whether two
   blocks are equal, and the range of the suffix array that holds a block's occurrences.
2. Occurrences.  A period q from 2b - 1 to 4b - 2 has an aligned (dyadic) block of b words
   in its first q words, and the block occurs again q words on.  So every aligned block asks
   for its occurrences that start 2b - 1 to 4b - 2 words on: a range successor query, the
   next place not before p in a range of the suffix array, on a wavelet tree over it.
3. Candidates.  Where two neighbouring occurrences are at most b / 2 apart, they are part of
   an arithmetic progression whose end one comparison gives; a progression inside the
   block's own run is passed over, the others give a candidate period for each term.
4. Every candidate is extended to both sides as far as words q apart are equal, by
   descending the ranks.  Of candidates with one start and end the smallest period stays.

Everything is array work over slices of about ``CHUNK_BYTES`` of text and whole documents;
there is no shuffle, and what a task holds follows its largest document.

Defined results: words are runs of bytes other than ASCII white space; a null or empty text
has no words and no runs; rows with equal or null ids are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_chunks

LEAST = 12
OUT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
CHUNK_BYTES = 1 << 20


class Ranks:
    """Ranks of the blocks of 2**k words within each document, and the suffix array.

    ``levels[k][p]`` is the first place in suffix order of the words from p that agree in
    2**k words (with the end of the document counting as a word), so two places have the
    same rank exactly when their blocks are equal.
    """

    def __init__(self, symbols: np.ndarray, off: np.ndarray):
        n, self.off = len(symbols), off
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        order = np.argsort((doc << 32) | symbols, kind="stable")
        rank = np.empty(n, np.int32)
        key = doc[order] << 32 | symbols[order]
        first = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
        rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
        self.levels, self.doc, width = [rank], doc, 1
        end = off[1:][doc]
        while True:
            size = np.bincount(rank, minlength=n)
            open_ = np.flatnonzero(size[rank] > 1)  # blocks that occur again
            if not len(open_):
                break
            then = np.zeros(len(open_), np.int64)
            inside = open_ + width < end[open_]
            then[inside] = rank[open_[inside] + width] + 1
            key = rank[open_].astype(np.int64) << 32 | then
            order = np.argsort(key, kind="stable")
            key, at = key[order], open_[order]
            high = key >> 32
            group = np.flatnonzero(np.r_[True, high[1:] != high[:-1]])
            base = np.repeat(group, np.diff(np.r_[group, len(at)]))
            fresh = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            place = np.repeat(fresh, np.diff(np.r_[fresh, len(at)]))
            rank = rank.copy()
            rank[at] = high + place - base
            self.levels.append(rank)
            width *= 2
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[rank] = np.arange(n)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from a and from b (later in its document) that are equal."""
        return self._equal(a, b, False)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before a and before b that are equal."""
        return self._equal(a, b, True)

    def _equal(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        total, last = np.zeros(len(a), np.int64), len(self.doc) - 1
        low, high = self.off[:-1][self.doc[a]], self.off[1:][self.doc[a]]
        for k in range(len(self.levels) - 2, -1, -1):  # no block of the last level occurs twice, so each is passed once
            width, rank = 1 << k, self.levels[k]
            if back:
                x, y = a - total - width, b - total - width
                same = (x >= low) & (rank[np.maximum(x, 0)] == rank[np.maximum(y, 0)])
            else:
                x, y = a + total, b + total
                same = (y + width <= high) & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)])
            total[same] += width
        return total


class WaveletTree:
    """Range successor queries over a sequence of numbers below 2**bits (level by level, as a matrix)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.n = bits, len(values)
        self.zeros, self.before = [], []
        for b in range(bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            self.before.append(np.r_[0, np.cumsum(~one)].astype(np.int32))  # zeros before each place
            self.zeros.append(int(self.before[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def successor(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest number not below ``least`` among the places from left to right (exclusive), or -1."""
        over = least >= 1 << self.bits
        lo, hi, smaller = left.astype(np.int64), right.astype(np.int64), np.zeros(len(left), np.int64)
        for i, b in enumerate(range(self.bits - 1, -1, -1)):
            zlo, zhi = self.before[i][lo], self.before[i][hi]
            one = (least >> b) & 1 == 1
            smaller += np.where(one, zhi - zlo, 0)
            lo, hi = np.where(one, self.zeros[i] + lo - zlo, zlo), np.where(one, self.zeros[i] + hi - zhi, zhi)
        found = np.full(len(left), -1, np.int64)
        some = np.flatnonzero(~over & (smaller < right - left))
        lo, hi, k, value = left[some].astype(np.int64), right[some].astype(np.int64), smaller[some], np.zeros(len(some), np.int64)
        for i, b in enumerate(range(self.bits - 1, -1, -1)):
            zlo, zhi = self.before[i][lo], self.before[i][hi]
            one = k >= zhi - zlo
            k = np.where(one, k - (zhi - zlo), k)
            value |= one.astype(np.int64) << b
            lo, hi = np.where(one, self.zeros[i] + lo - zlo, zlo), np.where(one, self.zeros[i] + hi - zhi, zhi)
        found[some] = value
        return found


def candidates(ranks: Ranks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of candidates: an aligned block at the place occurs again a period on."""
    n, off, doc = len(ranks.doc), ranks.off, ranks.doc
    if not n:
        return
    longest = int(np.diff(off).max())
    # places within documents: a document's suffixes stand together in suffix order, as its words do
    tree = WaveletTree(ranks.suffixes - off[:-1][doc[ranks.suffixes]], max(1, longest.bit_length()))
    for k, rank in enumerate(ranks.levels):
        b = 1 << k
        if 2 * (2 * b - 1) > longest:
            break
        size = np.bincount(rank, minlength=n)
        inner = np.arange(n) - off[:-1][doc]
        at = np.flatnonzero((inner % b == 0) & (size[rank] > 1))
        start, left, low = inner[at], rank[at].astype(np.int64), off[:-1][doc[at]]
        right = left + size[rank[at]]
        cursor, last = start + 2 * b - 1, start + 4 * b - 2
        while len(at):
            p = tree.successor(left, right, cursor)
            live = (p >= 0) & (p <= last)
            at, start, left, right, low, last, p = (x[live] for x in (at, start, left, right, low, last, p))
            if not len(at):
                break
            step, terms = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
            if b > 1:
                then = tree.successor(left, right, p + 1)
                near = np.flatnonzero((then >= 0) & (then - p <= b // 2))
                step[near] = then[near] - p[near]
                reach = ranks.ahead(low[near] + p[near], low[near] + then[near])
                terms[near] = (step[near] + reach - b) // step[near] + 1
                # the block lies in the run that the progression lies in: its period is found from smaller blocks
                own = ((p[near] - start[near]) % step[near] == 0) & (ranks.ahead(at[near], at[near] + step[near]) + step[near] >= p[near] - start[near] + b)
                use = np.ones(len(at), bool)
                use[near[own]] = False
            else:
                use = np.ones(len(at), bool)
            some = np.minimum(terms, (last - p) // step + 1)
            many = np.where(use, some, 0)
            which = np.repeat(np.arange(len(at)), many)
            term = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            yield at[which], p[which] - start[which] + term * step[which]
            cursor = p + (terms - 1) * step + 1


def runs_of(ranks: Ranks, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, as places in the words of all documents, by start and period."""
    found = [np.zeros((0, 3), np.int64)]
    for at, q in candidates(ranks):
        ahead, behind = ranks.ahead(at, at + q), ranks.behind(at, at + q)
        long = np.flatnonzero(behind + ahead + q >= np.maximum(least, 2 * q))
        found.append(np.unique(np.stack([at - behind, at + q + ahead, q], axis=1)[long], axis=0))
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[first]
    return tuple(every[np.lexsort((every[:, 2], every[:, 0]))].T)


def _chunk(data: np.ndarray, off: np.ndarray, least: int) -> tuple:
    """Word counts, runs (document, start, length, period) and collapsed texts of a slice of documents."""
    raw, seen, words, symbols, ends = data.tobytes(), {}, [], [], [0]
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        own = raw[a:b].split()  # of bytes: at ASCII white space
        symbols += [seen.setdefault(w, len(seen)) for w in own]
        words += own
        ends.append(len(words))
    ends = np.array(ends, np.int64)
    start, end, period = runs_of(Ranks(np.array(symbols, np.int64), ends), least)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, end, -1)
    gone = np.cumsum(drop) > 0
    collapsed = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        own = words[a:b] if not gone[a:b].any() else [words[i] for i in (a + np.flatnonzero(~gone[a:b])).tolist()]
        collapsed.append(b" ".join(own))
    doc = np.searchsorted(ends, start, "right") - 1
    return np.diff(ends), doc, np.stack([start - ends[doc], end - start, period]), collapsed


def _of_batches(least: int, keep: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch, "text", CHUNK_BYTES):
                n_words, doc, columns, collapsed = _chunk(data, off, least)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"]))
                out = [*(batch.column(i).slice(lo, hi - lo) for i in range(keep)), pa.array(n_words), runs, pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.record_batch(out, names=[*batch.schema.names[:keep], "n_words", "runs", "collapsed"])

    return work


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), least: int = LEAST) -> DataFrame:
    """The ``keep`` columns, n_words, runs and collapsed of every row of ``docs``.

    ``runs`` holds (start, length, period) of every run, by start and period, in words;
    ``collapsed`` the words, joined by one space, that no run contains after its first period.
    """
    rows = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_of_batches(least, len(keep)), ", ".join(x for x in (kept, OUT) if x))
