"""Packs token pieces of documents into as few sequences as it can: bin completion over counts of lengths."""

from __future__ import annotations

import json
import random
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from itertools import combinations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.bpe import read_ranks
from tidelog.llm.chunks import ChunkMemory
from tidelog.llm.common import Scratch

CAPACITY, END_ID = 1024, 2
# Rows ranked together: a length with more pieces is dealt into more buckets, up to the second number.
RANKED_TOGETHER, MOST_BUCKETS = 500, 4096
# Bounds of the search, on steps and not on data: how many decisions it tries, and fillings it looks at in each.
DECISIONS, DEPTH, FILLINGS, TRIED, SAMPLES = 4_000, 400, 2_000, 12, 2
PATIENCE = (0, 1, 2, 4)

Plan = list[tuple[tuple[int, ...], int]]  # lengths of a sequence, and how many sequences are filled so


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing over counts: equal sequences are filled together."""
    room: dict[int, list[list]] = {}  # free space -> [lengths, times]
    frees: list[int] = []

    def put(free: int, lengths: tuple, times: int) -> None:
        if free not in room:
            room[free] = []
            insort(frees, free)
        room[free].append([lengths, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(frees, length)
            if at < len(frees):
                free = frees[at]
                lengths, times = room[free][-1]
                took = min(times, left)
                if took == times:
                    room[free].pop()
                    if not room[free]:
                        del room[free], frees[at]
                else:
                    room[free][-1][1] -= took
                put(free - length, (*lengths, length), took)
                left -= took
            else:
                each = capacity // length
                if full := left // each:
                    put(capacity - each * length, (length,) * each, full)
                if rest := left % each:
                    put(capacity - rest * length, (length,) * rest, 1)
                left = 0
    return [(tuple(lengths), times) for groups in room.values() for lengths, times in groups]


def sequences(plan: Plan) -> int:
    return sum(times for _, times in plan)


class _Search:
    """Depth-first bin completion around the largest length left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.counts = capacity, dict(counts)
        self.lengths = sorted(x for x, n in counts.items() if n)  # those with a count, ascending
        self.total = sum(x * n for x, n in counts.items())
        self.lower = -(-self.total // capacity)
        self.best = best_fit(counts, capacity)
        self.decisions = DECISIONS
        self.path: Plan = []

    def _change(self, filling: tuple[int, ...], times: int) -> None:
        """Take the lengths of ``filling`` out ``times`` times; back in if that is negative."""
        for x in filling:
            old = self.counts[x]
            new = self.counts[x] = old - times
            if new == 0:
                del self.lengths[bisect_left(self.lengths, x)]
            elif old == 0:
                insort(self.lengths, x)

    def _dominated(self, filling: tuple[int, ...], slack: int) -> bool:
        """Whether one unused length could stand for some of ``filling`` and fit: then that filling is as good."""
        for size in (1, 2):
            for part in combinations(filling, size):
                whole = sum(part)
                low = whole + 1 if size == 1 else whole
                for at in range(bisect_left(self.lengths, low), bisect_right(self.lengths, whole + slack)):
                    other = self.lengths[at]
                    if self.counts[other] > filling.count(other):
                        return True
        return False

    def fillings(self, space: int, waste: int, spare: int = 0, large: bool = False) -> list[tuple[int, ...]]:
        """Undominated fillings of ``space`` that waste at most ``waste``.

        Those that waste up to ``spare`` are looked for first, then up to more and more. In order of
        waste and number of pieces, or if ``large`` of the largest pieces.
        """
        lengths, counts, least = self.lengths, self.counts, self.lengths[0] if self.lengths else 0
        found, steps, spare = [], 0, min(spare, waste)

        def grow(chosen: tuple[int, ...], left: int, top: int, same: int) -> None:
            nonlocal steps
            if left <= spare and not self._dominated(chosen, left):
                found.append((left, len(chosen), chosen))
            if left < least:
                return
            at = bisect_right(lengths, min(left, top)) - 1
            while at >= 0 and steps > 0 and len(found) < TRIED:
                x = lengths[at]
                # What is left after x takes other lengths up to x: enough of them, or too much waste.
                if x != top or same < counts[x]:
                    steps -= 1
                    if left - x <= spare or left - x >= least:
                        grow((*chosen, x), left - x, x, same + 1 if x == top else 1)
                at -= 1

        while not found and spare <= waste:
            steps = FILLINGS
            grow((), space, space + 1, 0)
            if spare == waste:
                break
            spare = min(waste, max(4, spare * 4))
        by = (lambda f: [-x for x in f[2]]) if large else (lambda f: (f[0], f[1], [-x for x in f[2]]))
        return [chosen for _, _, chosen in sorted(found, key=by)]

    def _times(self, filling: tuple[int, ...], allowed: int) -> int:
        most = min(self.counts[x] // filling.count(x) for x in set(filling))
        waste = self.capacity - sum(filling)
        return min(most, allowed // waste) if waste else most

    def _around_largest(self, allowed: int, spare: int = 0, large: bool = False) -> list[tuple[int, ...]]:
        largest = self.lengths[-1]
        self._change((largest,), 1)
        options = self.fillings(self.capacity - largest, min(allowed, self.capacity), spare, large)
        self._change((largest,), -1)
        return [(largest, *rest) for rest in options]

    def sample(self, rng: random.Random, patience: float) -> bool:
        """One plan from the top without going back, mostly by the first filling; True at the lower bound.

        With ``patience`` a filling may waste so many times the mean of what may still be wasted
        if it takes large pieces; small ones are left for later.
        """
        used, left, path = 0, self.total, []
        while left:
            allowed = (sequences(self.best) - 1 - used) * self.capacity - left
            mean = allowed * self.capacity / max(1, left)
            options = self._around_largest(allowed, int(patience * mean), patience > 0) if allowed >= 0 else []
            if not options:
                break
            filling = options[min(int(rng.expovariate(1.5)), len(options) - 1)]
            times = max(1, self._times(filling, allowed))
            self._change(filling, times)
            path.append((filling, times))
            used, left = used + times, left - times * sum(filling)
        for filling, times in path:
            self._change(filling, -times)
        if not left and used < sequences(self.best):
            self.best = path
        return sequences(self.best) == self.lower

    def _dive(self, used: int, left: int) -> bool:
        """Try to complete with fewer sequences than the incumbent; True when nothing better is possible."""
        if left == 0:
            if used < sequences(self.best):
                self.best = list(self.path)
            return sequences(self.best) == self.lower
        allowed = (sequences(self.best) - 1 - used) * self.capacity - left  # what may still be wasted
        if allowed < 0 or self.decisions <= 0:
            return False
        if len(self.path) >= DEPTH:
            return False
        for filling in self._around_largest(allowed):
            for times in dict.fromkeys((self._times(filling, allowed), 1)):
                if times < 1 or self.decisions <= 0:
                    continue
                self.decisions -= 1
                self._change(filling, times)
                self.path.append((filling, times))
                done = self._dive(used + times, left - times * sum(filling))
                self.path.pop()
                self._change(filling, -times)
                if done:
                    return True
        return False


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """A plan for ``counts`` (length -> pieces) with as few sequences as the search finds.

    The best-fit plan is the first incumbent. Around the largest length left the undominated
    fillings are tried, those of least waste first and as often as the counts allow; a branch ends
    when the waste it may still make before it needs as many sequences as the incumbent is spent.
    Plans from the top that do not go back come first, then depth-first search. It stops at the lower bound (all ids / capacity), which proves the plan optimal, or
    when its decisions are used up.
    """
    full = [((capacity,), counts[capacity])] if counts.get(capacity) else []
    search = _Search({x: n for x, n in counts.items() if n and x < capacity}, capacity)
    if sequences(search.best) > search.lower:
        rng = random.Random(0)
        if not any(search.sample(rng, patience) for _ in range(SAMPLES) for patience in PATIENCE):
            search._dive(0, search.total)
    return full + search.best


def slots(plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the pieces of each length by rank: (key, first sequence, offset), keys ascending, key = length << 44 | first rank."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            rows.append((x << 44 | taken.get(x, 0), base, offset))
            taken[x] = taken.get(x, 0) + times
            offset += x
        base += times
    rows.sort()
    key, first, offset = np.array(rows, np.int64).reshape(-1, 3).T
    return key, first, offset


_MEMORY: dict[str, ChunkMemory] = {}


def _memory(ranks_path: str, pattern: str) -> ChunkMemory:
    if ranks_path not in _MEMORY:
        coder = tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})

        def encode(parts):
            return [np.array(coder.encode_ordinary(p), "<u4").tobytes() for p in parts]

        _MEMORY[ranks_path] = ChunkMemory(encode)
    return _MEMORY[ranks_path]


def added_tokens(json_path: str) -> dict[str, int]:
    """Texts that a tokenizer file names as tokens of their own, wherever they occur in a text."""
    with open(json_path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def with_added(encode, added: dict[str, int]):
    """``encode`` for texts that may hold ``added`` tokens: each is one id, and what lies between is encoded alone."""
    if not added:
        return encode
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")

    def whole(text: str) -> bytes:
        parts = cut.split(text)
        if len(parts) == 1:
            return encode(text)
        return b"".join(int(added[p]).to_bytes(4, "little") if k % 2 else encode(p) if p else b"" for k, p in enumerate(parts))

    return whole


def pieces(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False, added: dict[str, int] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the ids of each text with ``end_id`` after them, cut if too long.

    Only documents longer than ``capacity`` are cut: what does not fill whole pieces comes first.
    Null text is empty text, one piece of ``end_id`` alone. The texts of ``added`` are single tokens.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    last = int(end_id).to_bytes(4, "little")

    def batches(rows):
        encode = with_added(_memory(ranks_path, pattern).ids, added or {})
        for batch in rows:
            out = [[] for _ in names]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text or "") + last
                total = len(ids) // 4
                starts = [0, *range(total % capacity or capacity, total, capacity)]
                for k, (start, stop) in enumerate(zip(starts, [*starts[1:], total])):
                    part = ids[4 * start:4 * stop]
                    row = (doc_id, k, start, stop - start, zlib.crc32(part), part)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, schema)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with sequence_id and offset; it needs doc_id, piece, ids_crc32 and a length of 1 to ``capacity``, and is read three times.

    The plan depends only on how many pieces each length has, at most ``capacity`` numbers, whatever
    the size of the table: only they reach the driver. Pieces are then numbered within their length
    in buckets of bounded size, and each takes the place that its number has in the plan.
    """
    counts = {int(r[0]): int(r[1]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    key, first, offset = slots(bin_completion(counts, capacity))
    dealt = {x: min(-(-n // RANKED_TOGETHER), MOST_BUCKETS) for x, n in counts.items()}
    buckets = F.element_at(F.array(*[F.lit(dealt.get(x, 1)) for x in range(1, capacity + 1)]), F.col("length").cast("int"))
    order = ["doc_id", "piece", "ids_crc32"]
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64(*order), buckets.cast("long")))
    before = cut.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).select(
        "length", "_bucket", (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    ranked = cut.withColumn("_place", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)) - 1)
    ranked = ranked.join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_place"))

    names = [c for c in cut.columns if c != "_bucket"]

    def batches(rows):
        for batch in rows:
            wanted = batch.column("length").to_numpy() << 44 | batch.column("_rank").to_numpy()
            at = np.searchsorted(key, wanted, side="right") - 1
            sequence, place_at = first[at] + (wanted - key[at]), offset[at]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(sequence), pa.array(place_at)],
                                             [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema if f.name != "_bucket")
    return ranked.select(*names, "_rank").mapInArrow(batches, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False, name: str = "packing", added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece of every document with its place: sequence_id and offset, gapless from 0.

    ``docs`` needs doc_id and text; other columns are ignored. Rows with a null or a repeated doc_id
    are documents like any other. Equal pieces may take any of their places. An empty table gives
    no rows.
    """
    scratch = Scratch(docs.sparkSession, name)
    return place(scratch.store(pieces(docs, ranks_path, pattern, capacity, end_id, with_ids, added), "pieces"), capacity)
