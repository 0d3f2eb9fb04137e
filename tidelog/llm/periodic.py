"""Periodic runs of words by internal pattern matching: dyadic blocks, a suffix array and a wavelet matrix over it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# A run repeats its period at least so often and has at least so many words.
TIMES, LEAST = 4, 6
# Words handled at once; a longer document is handled alone.
WORDS = 1 << 19


class Blocks:
    """Names of all blocks of length 1, 2, 4, … of a sequence, its suffix array, and common extensions by those names.

    Prefix doubling: the name of a block is the first place of its group in the order of all blocks
    of that length, so the suffixes that begin with it are ``sa[name:name + size]``. Only
    positions whose block is not yet alone in its group are sorted again. Every suffix of
    ``symbols`` must be different (a closing symbol that occurs once).
    """

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        ordered = symbols[order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if n else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        names = np.empty(n, np.int32)
        names[order] = np.repeat(starts, np.diff(np.append(starts, n)))
        self.names, self.repeated = [names], []
        self.sizes = []
        self.sa = np.empty(n, np.int32)
        k = 0
        while True:
            size = np.zeros(n, np.int32)
            active = np.arange(n, dtype=np.int32) if k == 0 else active
            places = names[active]
            count = np.bincount(places, minlength=n)[places] if len(active) else np.zeros(0, np.int64)
            alone = count == 1
            self.sa[places[alone]] = active[alone]
            active = active[~alone]
            size[active] = count[~alone]
            self.sizes.append(size)
            self.repeated.append(active)
            if not len(active):
                break
            after = active.astype(np.int64) + (1 << k)
            # A block that ends behind the sequence is alone, so ``after`` lies inside.
            key = names[active].astype(np.int64) * (n + 1) + names[after]
            order = np.argsort(key, kind="stable")
            key, active = key[order], active[order]
            group = key // (n + 1)
            new_group = np.concatenate(([True], group[1:] != group[:-1]))
            new_block = np.concatenate(([True], key[1:] != key[:-1]))
            at = np.arange(len(key))
            in_group = at - np.maximum.accumulate(np.where(new_group, at, 0))
            name = np.maximum.accumulate(np.where(new_block, at, 0))
            names = names.copy()
            names[active] = group + in_group[name]
            self.names.append(names)
            k += 1
        self.top = k

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on are equal (i != j)."""
        got = np.zeros(len(i), np.int64)
        for k in range(self.top, -1, -1):
            x, y = i + got, j + got
            inside = np.maximum(x, y) < self.n
            same = inside & (self.names[k][np.where(inside, x, 0)] == self.names[k][np.where(inside, y, 0)])
            got += same.astype(np.int64) << k
        return got

    def extend_back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j are equal (i != j)."""
        got = np.zeros(len(i), np.int64)
        for k in range(self.top, -1, -1):
            x, y = i - got - (1 << k), j - got - (1 << k)
            inside = np.minimum(x, y) >= 0
            same = inside & (self.names[k][np.where(inside, x, 0)] == self.names[k][np.where(inside, y, 0)])
            got += same.astype(np.int64) << k
        return got


class WaveletMatrix:
    """Counts and order statistics of the values in any stretch of a sequence, a bit level at a time, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.ranks, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            ones = (values >> level) & 1 == 1
            rank = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=rank[1:])
            self.ranks.append(rank)
            self.zeros.append(int(rank[-1]))
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in places lo to hi - 1 are less than ``bound``."""
        found = np.zeros(len(lo), np.int64)
        beyond = bound >> self.bits > 0
        found[beyond] = (hi - lo)[beyond]
        for k, (rank, zeros) in enumerate(zip(self.ranks, self.zeros)):
            one = (bound >> (self.bits - 1 - k)) & 1 == 1
            l0, h0 = rank[lo], rank[hi]
            found += np.where(one & ~beyond, h0 - l0, 0)
            lo, hi = np.where(one, lo - l0 + zeros, l0), np.where(one, hi - h0 + zeros, h0)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """The smallest value in places lo to hi - 1 but for ``skip`` smaller ones: with ``below``, the range successor."""
        value = np.zeros(len(lo), np.int64)
        for rank, zeros in zip(self.ranks, self.zeros):
            l0, h0 = rank[lo], rank[hi]
            one = skip >= h0 - l0
            skip = np.where(one, skip - (h0 - l0), skip)
            value = value << 1 | one
            lo, hi = np.where(one, lo - l0 + zeros, l0), np.where(one, hi - h0 + zeros, h0)
        return value


def candidates(blocks: Blocks) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): every run of the sequence has a place among them with its smallest period.

    A run with period q, 2^k <= q < 2^(k+1), that repeats three times or more holds a block of
    length 2^k at a multiple of 2^k, and that block again q words later. The occurrences of a
    block in the window of starts 2^k to 2^(k+1) - 1 behind it are an arithmetic progression, so
    its first two members and their number give them all. Blocks of one word would find
    nearly nothing but chance: periods of 1 are found by blocks of two words.
    """
    if blocks.top < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    twice = np.zeros(blocks.n, bool)
    twice[blocks.repeated[1]] = True
    # Suffixes whose first two words occur elsewhere, in the order of the suffix array: all longer blocks' groups lie inside.
    held = twice[blocks.sa]
    place = np.concatenate(([0], np.cumsum(held)))
    successor = WaveletMatrix(blocks.sa[held].astype(np.int64))
    at, period = [], []
    for k in range(1, blocks.top + 1):
        b = blocks.repeated[k].astype(np.int64)
        b = b[b % (1 << k) == 0]
        if not len(b):
            continue
        name = blocks.names[k][b]
        lo, hi = place[name], place[name + blocks.sizes[k][b]]
        start = b + (1 << k if k > 1 else 1)
        skip = successor.below(lo, hi, start)
        n = successor.below(lo, hi, b + (2 << k)) - skip
        some = n > 0
        b, lo, hi, skip, n = b[some], lo[some], hi[some], skip[some], n[some]
        first = successor.smallest(lo, hi, skip)
        second = successor.smallest(lo, hi, skip + (n > 1))
        member = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at.append(np.repeat(b, n))
        period.append(np.repeat(first - b, n) + member * np.repeat(second - first, n))
    return (np.concatenate(at), np.concatenate(period)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def find_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period. All suffixes of ``symbols`` must be different."""
    blocks = Blocks(symbols)
    at, period = candidates(blocks)
    start = at - blocks.extend_back(at, at + period)
    stop = at + period + blocks.extend(at, at + period)
    good = stop - start >= np.maximum(LEAST, TIMES * period)
    start, stop, period = start[good], stop[good], period[good]
    # A multiple of the smallest period finds the same stretch again.
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def _symbols(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, equal only for equal words of one text, each text closed by a number of its own."""
    codes = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    total = int(ends[-1]) if len(ends) else 0
    owner = np.repeat(np.arange(len(texts)), sizes)
    symbols = np.empty(total, np.int64)
    symbols[np.arange(len(codes)) + owner] = codes * len(texts) + owner
    symbols[ends - 1] = (int(codes.max()) + 1 if len(codes) else 0) * len(texts) + np.arange(len(texts))
    return symbols, ends


RESULT = "n_words long, runs array<struct<start long, length long, period long>>, collapsed string"


def _described(texts: list[list[bytes]]):
    """(n_words, runs, collapsed) of every text."""
    symbols, ends = _symbols(texts)
    begins = ends - [len(words) + 1 for words in texts]
    start, length, period = find_runs(symbols)
    owner = np.searchsorted(ends, start, side="right")
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    # A word goes if a run holds it after its first period.
    marks = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, start + length, -1)
    gone = np.cumsum(marks) > 0
    for k, words in enumerate(texts):
        mine = slice(bounds[k], bounds[k + 1])
        runs = [{"start": s, "length": n, "period": q} for s, n, q in
                zip((start[mine] - begins[k]).tolist(), length[mine].tolist(), period[mine].tolist())]
        if runs:
            words = [words[i] for i in np.flatnonzero(~gone[begins[k]:begins[k] + len(words)]).tolist()]
        yield len(texts[k]), runs, b" ".join(words)


def _batches(rows):
    kinds = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                       ("collapsed", pa.string())])
    for batch in rows:
        words = [(text or "").encode("utf-8", "surrogatepass").split() for text in batch.column("text").to_pylist()]
        at = 0
        while at < len(words):
            stop, size = at + 1, len(words[at])
            while stop < len(words) and size + len(words[stop]) <= WORDS:
                size += len(words[stop])
                stop += 1
            n, runs, collapsed = zip(*_described(words[at:stop]))
            columns = [pa.array(n, kinds[0].type), pa.array(runs, kinds[1].type), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, stop - at), *columns], ["doc_id", *kinds.names])
            at = stop


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text): runs of repeated words and the text without the repeats.

    Words are stretches without ASCII white space. A run is a stretch with smallest period q and at
    least max(LEAST, TIMES * q) words that no neighbour extends; ``runs`` has (start, length,
    period) in words, by start, then period. ``collapsed`` keeps a run's first q words, words
    joined by one space. A null or empty text has no words, no runs and an empty collapsed text.
    Rows that repeat a doc_id, or have none, are rows of their own; other columns are ignored; an empty
    table gives no rows. Rows never move: memory grows with the longest single text alone.
    """
    return docs.select("doc_id", "text").mapInArrow(_batches, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RESULT}")
