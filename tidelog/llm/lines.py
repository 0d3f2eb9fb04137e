"""Line dedup: MinHash of character shingles, banding, exact Jaccard, distributed union-find, one line kept per component."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.bloom import blocks_for, with_maybe
from tidelog.llm.buckets import bucket_links
from tidelog.llm.common import Scratch, free_name
from tidelog.llm.components import components

SHINGLE, JACCARD = 5, 0.8
# Bins of the signature: 21 bands of 6 miss a pair at Jaccard 0.8 once in 500.
BANDS, ROWS = 21, 6
BINS = 128
FULL = 70  # different values a signature must have for its sketch to be used; bits of shorter lines repeat and vary too much
PIECE = 1 << 16  # characters hashed at once
SEEN = 200_000  # lines a task remembers so as not to place them again; a bound on memory only
PACK = 1 << 32
# Entries a task packs at once, entries of a bucket, and lines of one cell in a chunk that go apart.
CHUNK_ENTRIES, BUCKET_ENTRIES, HEAVY = 1 << 20, 1 << 21, 64
# Blocks of the filter that keeps texts from moving: at most 10 MB; with more lines it only lets more through.
FILTER_BLOCKS = 1 << 18

# Characters of the lines whose shingles are held at once, and those a shingle's number has no room for.
HELD, _BEYOND = 1 << 20, re.compile("[\u0800-\U0010ffff]")
_PLACES = np.uint64(1) << np.arange(11 * (SHINGLE - 1), -1, -11, dtype=np.uint64)
# Shingles of a block compared at once.
COLUMNS = 2048

_SPACES = bytes.maketrans(b"\t\v\f\r", b"    ")
_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(1, 2 ** 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BAND = _RNG.integers(1, 2 ** 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_EMPTY = np.uint64(2 ** 64 - 1)
# How far on or back an empty bin looks for a value, try by try.
_STEPS = np.random.default_rng(12).integers(0, BINS, (64, BINS)) - np.arange(BINS)


def normalised(line: str) -> str:
    """Lower case, ASCII white space as one space, none at the ends."""
    return b" ".join(line.lower().encode("utf-8", "surrogatepass").split()).decode("utf-8", "surrogatepass")


def shingles(line: str) -> set[str]:
    """The character shingles of a normalised line; of a shorter one the line itself."""
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def near(xs: list[str], ys: list[str], least: float) -> np.ndarray:
    """Which pairs of lines have a Jaccard of ``least`` or more over their shingles.

    A line that comes again is cut into shingles once, within limits. Shingles of characters below
    2,048 are numbers, exactly; other lines and those shorter than a shingle are compared as sets.
    """
    out = np.zeros(len(xs), bool)
    known: dict[str, np.ndarray | None] = {}
    held = 0
    for k, pair in enumerate(zip(xs, ys)):
        if held >= HELD:
            known.clear()
            held = 0
        for line in pair:
            if line not in known:
                known[line] = _numbers(line)
                held += len(line)
        a, b = map(known.__getitem__, pair)
        if a is None or b is None:
            out[k] = jaccard(*map(shingles, pair)) >= least
        elif min(len(a), len(b)) >= least * max(len(a), len(b)):
            # Two sorted runs, which a stable sort only merges.
            met = np.sort(np.concatenate((a, b)), kind="stable")
            both = np.count_nonzero(met[1:] == met[:-1])
            out[k] = both / (len(met) - both) >= least
    return out


def _numbers(line: str) -> np.ndarray | None:
    """The different shingles of a line as numbers of five characters of 11 bits, sorted; none of a line that is shorter or has characters beyond."""
    if len(line) < SHINGLE or not line.isascii() and _BEYOND.search(line):
        return None
    chars = np.frombuffer(line.encode("utf-16-le"), "<u2").astype(np.uint64)
    h = np.correlate(chars, _PLACES)
    h.sort()
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _windows(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of lines of at least a shingle, one after the other; for each place a shingle could start at its line and whether it ends in it."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    inside = np.ones(len(chars), bool)
    for k in range(1, SHINGLE):
        inside[np.cumsum(sizes) - k] = False
    places = max(0, len(chars) - SHINGLE + 1)
    return chars, np.repeat(np.arange(len(lines)), sizes)[:places], inside[:places]


def signatures(lines: list[str]) -> np.ndarray:
    """One-permutation MinHash, lines x BINS: each shingle falls into a bin, which keeps its smallest hash.

    An empty bin takes the value of another, found in an order that depends on the bin alone, so
    equal sets have equal signatures and similar ones agree in a share of bins near their Jaccard.
    """
    chars, owner, inside = _windows([line.ljust(SHINGLE, "\0") for line in lines])
    least = np.full(len(lines) * BINS, _EMPTY, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(inside), PIECE):
            whole = inside[at:at + PIECE]
            part = chars[at:at + len(whole) + SHINGLE - 1].astype(np.uint64)
            h = _mixed(np.correlate(part, _FACTORS)[whole])
            np.minimum.at(least, owner[at:at + PIECE][whole] * BINS + (h >> np.uint64(57)).astype(np.int64), h)
    full, empty = least.copy(), np.flatnonzero(least == _EMPTY)
    for steps in _STEPS:
        if not len(empty):
            break
        value = least[empty + steps[empty % BINS]]
        got = value != _EMPTY
        full[empty[got]] = value[got]
        empty = empty[~got]
    if len(empty):
        full[empty] = least.reshape(len(lines), BINS).min(axis=1)[empty // BINS]
    return full.reshape(len(lines), BINS)


def bands(lines: list[str], values: np.ndarray | None = None) -> np.ndarray:
    """64-bit bucket numbers, lines x BANDS."""
    values = signatures(lines) if values is None else values
    values = values[:, :BANDS * ROWS].reshape(len(lines), BANDS, ROWS)
    with np.errstate(over="ignore"):
        return _mixed((values * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def sketches(values: np.ndarray) -> np.ndarray:
    """One bit of every bin, as two 64-bit numbers a line."""
    return np.packbits(values.astype(np.uint8) & 1, axis=1, bitorder="little").view("<i8")


def different(values: np.ndarray) -> np.ndarray:
    """How many different values each signature has: those in the bin they fell into."""
    return (values >> np.uint64(57) == np.arange(BINS, dtype=np.uint64)).sum(axis=1)


def numbered_lines(text: str | None):
    """(line, normalised line in UTF-8) for lines that are not blank."""
    if text is None:
        return []
    text = text.lower().encode("utf-8", "surrogatepass").translate(_SPACES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return [(at, norm) for at, line in enumerate(text.split(b"\n")) if (norm := line.strip(b" "))]


def numbers(norms: list[bytes]) -> np.ndarray:
    """Of each normalised line its 64-bit number, and another one to tell lines apart that share the first."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(norm, 42) for norm in norms]), ">u8").astype(np.int64).reshape(-1, 2)


def _lines(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, list[bytes]]:
    """The row of each line of a batch of texts, its place and the line."""
    found = [numbered_lines(text) for text in batch.column("text").to_pylist()]
    rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
    ats, norms = zip(*chain.from_iterable(found)) if len(rows) else ((), ())
    return pa.array(rows), np.array(ats, np.int32), list(norms)


def _placed(rows):
    """Every line with its numbers and, unless the task has lately placed the same line, its buckets, as bytes, and, of a line of many shingles, its sketch."""
    seen: set[int] = set()
    names = ["doc_id", "key", "line", "v", "check", "bands", "s0", "s1"]
    for batch in rows:
        docs, ats, norms = _lines(batch)
        vs, checks = numbers(norms).T
        firsts = {}
        for k, v in enumerate(vs.tolist()):
            if v not in seen:
                firsts.setdefault(v, k)
        if len(seen) + len(firsts) > SEEN:
            seen.clear()
        seen.update(firsts)
        # The buckets of the fresh lines lie one after the other; those of the others are null.
        new, sure = np.zeros(len(vs), bool), np.zeros(len(vs), bool)
        bits, cells = np.zeros((len(vs), 2), np.int64), np.empty(0, np.int64)
        if firsts:
            where = list(firsts.values())
            fresh = [norms[k].decode("utf-8", "surrogatepass") for k in where]
            values = signatures(fresh)
            new[where], sure[where], bits[where], cells = True, different(values) >= FULL, sketches(values), bands(fresh, values)
        ends = np.append(0, np.cumsum(new) * (BANDS * cells.itemsize)).astype(np.int32)
        placed = pa.Array.from_buffers(pa.binary(), len(vs), [pa.py_buffer(np.packbits(new, bitorder="little")), pa.py_buffer(ends), pa.py_buffer(cells)])
        columns = [batch.column("doc_id").take(docs), batch.column("key").take(docs), pa.array(ats), pa.array(vs), pa.array(checks), placed]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(bits[:, k], mask=~sure) for k in (0, 1))], names)


def _cells(bands: pa.Array) -> np.ndarray:
    """The buckets of lines, one after the other, from lists or their bytes."""
    return np.frombuffer(b"".join(bands.to_pylist()), np.uint64) if pa.types.is_binary(bands.type) else bands.flatten().to_numpy().view(np.uint64)


def _packed(cells: np.ndarray, vs: np.ndarray, buckets: int):
    """Rows (bucket, cells, vs) of entries: those of a bucket as numbers in a row. Cells with many lines go on apart, and only their least and greatest line into the bucket."""
    cells = (cells % np.uint64(buckets)) << np.uint64(32) | cells >> np.uint64(32)
    order = np.argsort(cells)
    cells, vs = cells[order], vs[order]
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    sizes = np.diff(np.append(starts, len(cells)))
    many, wide = sizes > HEAVY, np.repeat(sizes > HEAVY, sizes)
    out = []
    if many.any():
        out.append((-1 - int(cells[0] >> np.uint64(1)), cells[wide].tobytes(), vs[wide].tobytes()))
        ends = [f.reduceat(vs, starts)[many] for f in (np.minimum, np.maximum)]
        cells, vs = np.concatenate([cells[~wide], cells[starts[many]], cells[starts[many]]]), np.concatenate([vs[~wide], *ends])
        order = np.argsort(cells)
        cells, vs = cells[order], vs[order]
    bucket, low = (cells >> np.uint64(32)).astype(np.int64), cells.astype(np.uint32)
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    out += [(int(bucket[a]), low[a:b].tobytes(), vs[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], ["bucket", "cells", "vs"])


def _shared_cells(key: tuple, table: pa.Table) -> pa.Table:
    """(cell, v, head, n) of the cells of a bucket that hold different lines; of entries that went apart only (cell, v)."""
    bucket = key[0].as_py()
    vs = np.frombuffer(b"".join(table.column("vs").to_pylist()), np.int64)
    low = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.uint64 if bucket < 0 else np.uint32)
    if bucket < 0:
        none = pa.nulls(len(vs), pa.int64())
        return pa.table({"cell": low.view(np.int64), "v": vs, "head": none, "n": none})
    # Each with its place in one number, as numbers alone are sorted fastest.
    order = np.sort(low.astype(np.uint64) << np.uint64(32) | np.arange(len(low), dtype=np.uint64))
    low = (order >> np.uint64(32)).astype(np.uint32)
    same = low[1:] == low[:-1]
    several = np.append(same, False) | np.append(False, same)
    low, vs = low[several], vs[order[several] & np.uint64(PACK - 1)]
    order = np.lexsort((vs, low))
    low, vs = low[order], vs[order]
    once = np.append(True, (low[1:] != low[:-1]) | (vs[1:] != vs[:-1]))[:len(low)]
    low, vs = low[once], vs[once]
    starts = np.flatnonzero(np.append(True, low[1:] != low[:-1])[:len(low)])
    sizes = np.diff(np.append(starts, len(low)))
    heads, sizes = np.repeat(vs[starts], sizes), np.repeat(sizes, sizes)
    kept = sizes > 1
    return pa.table({"cell": low[kept].astype(np.int64) + (bucket << 32), "v": vs[kept], "head": heads[kept], "n": sizes[kept]})


def _members(scratch: Scratch, placed: DataFrame, entries: int) -> DataFrame:
    """(cell, v, head, n) of every entry of a cell with different lines. A cell is 32 bits of its number inside a bucket, and lines that meet by chance in so few are compared in vain.

    The entries move once, packed by bucket, and the buckets are as many as keep them small. A cell
    with many lines in a task's chunk of entries is no group: its entries get its head by a join.
    """
    buckets = max(64, -(-entries // BUCKET_ENTRIES))

    def batches(rows):
        held, n = [], 0
        for batch in rows:
            held.append((_cells(batch.column("bands")), np.repeat(batch.column("v").to_numpy(), BANDS)))
            if (n := n + len(held[-1][0])) >= CHUNK_ENTRIES:
                yield _packed(*map(np.concatenate, zip(*held)), buckets)
                held, n = [], 0
        if n:
            yield _packed(*map(np.concatenate, zip(*held)), buckets)

    packed = placed.where("bands IS NOT NULL").select("v", "bands").mapInArrow(batches, "bucket long, cells binary, vs binary")
    found = scratch.store(packed.groupBy("bucket").applyInArrow(_shared_cells, "cell long, v long, head long, n long"), "found")
    apart = found.where("head IS NULL")
    if apart.isEmpty():
        return found
    heads = found.where("head IS NOT NULL").groupBy("cell").agg(F.min("head").alias("head"), F.max("n").alias("n"))
    apart = apart.select("cell", "v").join(heads, "cell").withColumn("n", F.col("n") + HEAVY)
    members = scratch.store(found.where("head IS NOT NULL").unionByName(apart), "members")
    scratch.drop("found")
    return members


def _texts(rows):
    """(doc_id, line, key, norm) of every line."""
    for batch in rows:
        docs, ats, norms = _lines(batch)
        columns = [batch.column("doc_id").take(docs), pa.array(ats), pa.array(numbers(norms)[:, 0]), pa.array(norms, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line", "key", "norm"])


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    def batches(rows):
        for batch in rows:
            linked = near(batch.column("x").to_pylist(), batch.column("y").to_pylist(), least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked))

    # Sketches first, as they are short: of long lines at Jaccard ``least`` more bits differ less than once in 10^11 pairs. Lines without one go on.
    apart = BINS * (1 - least) / 2
    most = apart + 7 * (apart * (1 - apart / BINS)) ** 0.5
    sides = [texts.select(F.col("v").alias(v), F.col("s0").alias(f"{v}0"), F.col("s1").alias(f"{v}1")) for v in "ab"]
    bits = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))) + F.bit_count(F.col("a1").bitwiseXOR(F.col("b1")))
    pairs = pairs.join(sides[0], "a").join(sides[1], "b").where(F.coalesce(bits <= most, F.lit(True))).select("a", "b")
    x = texts.select(F.col("v").alias("a"), F.col("norm").alias("x"))
    y = texts.select(F.col("v").alias("b"), F.col("norm").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(batches, "a long, b long")


def _links_in_blocks(table: pa.Table, least: float) -> pa.Table:
    """Of each left line one link to every component it meets among the right ones."""
    # A line may be on both sides, and is looked at once.
    vs, first, line = np.unique(table.column("v").to_numpy(), return_index=True, return_inverse=True)
    sides = np.array(table.column("left").to_pylist(), bool)
    left, right = (np.bincount(line[side], minlength=len(vs)) > 0 for side in (sides, ~sides))
    _, comps = np.unique(table.column("comp").to_numpy()[first], return_inverse=True)
    row, column = _numbered_shingles(table.column("norm").take(pa.array(first)).to_pylist())
    sizes = np.bincount(row, minlength=len(vs))
    # Lines of the largest component meet only those of others.
    most = comps == np.bincount(comps).argmax()
    a, b = [], []
    for x, y in ((left & ~most, right), (left & most, right & ~most)):
        both = _in_common(row, column, x, y)
        linked = both / (sizes[x][:, None] + sizes[y] - both) >= least
        i, j = np.nonzero(linked & (comps[x][:, None] != comps[y]))
        _, first = np.unique(i * (comps.max() + 1) + comps[y][j], return_index=True)
        a.append(vs[x][i[first]])
        b.append(vs[y][j[first]])
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def _numbered_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line, number of a shingle) for the different shingles of every line."""
    numbers = [_numbers(line) for line in lines]
    if all(h is not None for h in numbers):
        row, h = np.repeat(np.arange(len(lines)), [len(h) for h in numbers]), np.concatenate(numbers)
        order = np.argsort(h)
        h = h[order]
        return row[order], np.cumsum(np.append(False, h[1:] != h[:-1]))
    vocabulary: dict[str, int] = {}
    ids = [[vocabulary.setdefault(s, len(vocabulary)) for s in shingles(line)] for line in lines]
    return np.repeat(np.arange(len(ids)), [len(x) for x in ids]), np.concatenate(ids)


def _in_common(row: np.ndarray, column: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many shingles each line of ``x`` shares with each other line of ``y``."""
    both = np.zeros((x.sum(), y.sum()), np.float32)
    if not both.size:
        return both.astype(np.float64)
    # Only shingles of several lines and of both sides count, and these some columns at a time.
    common = np.logical_and(*(np.bincount(column[side[row]], minlength=column.max() + 1) > 0 for side in (x, y)))
    common &= np.bincount(column, minlength=len(common)) > 1
    cut = common[column] & (x | y)[row]
    row, column = row[cut], (np.cumsum(common) - 1)[column[cut]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        has = []
        for side in (x, y):
            mine = side[row[a:b]]
            has.append(np.zeros((side.sum(), COLUMNS), np.float32))
            has[-1][(np.cumsum(side) - 1)[row[a:b][mine]], column[a:b][mine] - start] = 1
        both += has[0] @ has[1].T
    return both.astype(np.float64)


def _keepers(scratch: Scratch, docs: DataFrame, least: float) -> DataFrame:
    """(doc_id, key, line, k_doc, k_line) of every line: key is a hash of its whole text, the others are the place of the line that stands for it.

    Only lines move, not texts: the entries (cell, v) once, packed, to find cells with different lines,
    then the texts of those lines, which a Bloom filter tells before they move. Each table is dropped
    when the next ones are there.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    placed = scratch.store(narrow.mapInArrow(_placed, "doc_id long, key long, line int, v long, check long, bands binary, s0 long, s1 long"), "placed")
    entries, low, high = placed.agg(F.count("bands") * BANDS, F.min("doc_id"), F.max("doc_id")).first()
    # Document and line as one number: decimals, many times slower, only if there are documents beyond 31 bits.
    short = low is None or -(1 << 31) <= low and high < 1 << 31
    if short:
        place = F.col("doc_id") * F.lit(PACK) + F.col("line")
        k_doc, k_line = F.shiftright("keeper", 32), F.col("keeper").bitwiseAND(F.lit(PACK - 1))
    else:
        pack = F.lit(PACK).cast("decimal(11,0)")
        place = (F.col("doc_id").cast("decimal(20,0)") * pack + F.col("line")).cast("decimal(38,0)")
        k_line = F.pmod(F.col("keeper"), pack)
        k_doc = (F.col("keeper") - k_line) / pack
    firsts = placed.groupBy("v").agg(F.min(place).alias("first"), F.min("check").alias("low"), F.max("check").alias("high"),
                                     F.max("s0").alias("s0"), F.max("s1").alias("s1"), F.count("*").alias("n"))
    # Different lines of one 64-bit hash would be taken for one: they are left as they are.
    firsts = scratch.store(firsts.where("low = high").select("v", "first", "s0", "s1", "n"), "firsts")
    lines = scratch.store(placed.select("doc_id", "key", "line", "v"), "lines")
    members = _members(scratch, placed, entries)
    scratch.drop("placed")
    # A line that comes once and shares no bucket stands for itself and is looked at no more.
    shared = members.select("v").distinct().withColumn("shared", F.lit(True))
    firsts = scratch.store(firsts.join(shared, "v", "left").where("n > 1 OR shared").drop("n"), "repeated")
    scratch.drop("firsts")
    # Only lines that share a bucket with another are compared, so only their texts move.
    wanted = firsts.where("shared").drop("shared")
    maybe = with_maybe(narrow.select("doc_id", "text").mapInArrow(_texts, "doc_id long, line int, key long, norm string"), wanted.select(F.col("v").alias("key")),
                       min(FILTER_BLOCKS, blocks_for(wanted.count())))
    texts = maybe.where("_maybe").withColumnRenamed("key", "v").join(wanted, "v").where(F.col("first").isNull() | (place == F.col("first")))
    texts = scratch.store(texts.dropDuplicates(["v"]).select("v", "norm", "s0", "s1"), "texts")
    links = bucket_links(scratch, members.withColumn("own", F.lit(True)), texts, lambda pairs: _verified(pairs, texts, least), lambda t: _links_in_blocks(t, least))
    comps = scratch.store(components(scratch, links, "line-links"), "comps")
    for done in ("members", "found", "texts", "stars", "open"):
        scratch.drop(done)
    named = firsts.join(comps.withColumnRenamed("id", "v"), "v", "left").select("v", "first", F.coalesce("component", "v").alias("comp"))
    keepers = named.groupBy("comp").agg(F.min("first").alias("keeper"))
    keepers = scratch.store(named.join(keepers, "comp").select("v", "keeper"), "keepers")
    scratch.drop("repeated")
    found = lines.join(keepers, "v", "left")
    return found.select("doc_id", "key", "line", k_doc.cast("long").alias("k_doc"), k_line.cast("int").alias("k_line"))


def _kept(found: DataFrame) -> DataFrame:
    """``found`` with keeper_doc_id, keeper_line and kept."""
    own = F.col("doc_id").isNull() | F.col("k_doc").isNull()
    found = found.select("doc_id", "key", "line", F.when(own, F.col("doc_id")).otherwise(F.col("k_doc")).alias("keeper_doc_id"),
                         F.when(own, F.col("line")).otherwise(F.col("k_line")).alias("keeper_line"))
    return found.withColumn("kept", F.coalesce((F.col("doc_id") == F.col("keeper_doc_id")) & (F.col("line") == F.col("keeper_line")), F.lit(True)))


def near_lines(docs: DataFrame, least: float = JACCARD, name: str = "lines") -> DataFrame:
    """(doc_id, line, keeper_doc_id, keeper_line, kept): every line that is not blank, and the line that stands for it.

    Lines link if their normalised texts are equal or have a Jaccard of ``least`` or more over
    character shingles; components over all documents keep their first line (smallest doc_id, then
    line, counted from 0 in the text cut at line feeds). ``docs`` needs doc_id and text; other
    columns are ignored. Null, empty and blank texts give no rows. Lines of documents without an id
    link, but are kept and stand for no other. Equal rows that repeat a doc_id keep the same lines. An empty table gives no rows.
    """
    return _kept(_keepers(Scratch(docs.sparkSession, name), docs, least)).drop("key")


def without_repeats(docs: DataFrame, least: float = JACCARD, name: str = "line-dedup") -> DataFrame:
    """``docs`` with the lines that are not kept taken out of their texts, columns as given, whatever they are called; n_chars follows the text.

    A document that loses all its lines stays with an empty text; null and empty texts stay as they are. Rows that repeat a
    doc_id with the same text lose the same lines, with different texts each its own. Lines of rows without a doc_id
    stay. An empty table gives no rows.
    """
    doc, key, gone = (free_name(docs, c) for c in ("_doc", "_key", "_gone"))
    found = _kept(_keepers(Scratch(docs.sparkSession, name), docs.select("doc_id", "text"), least)).where("NOT kept")
    lost = found.groupBy(F.col("doc_id").alias(doc), F.col("key").alias(key)).agg(F.collect_set("line").alias(gone))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(gone, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    joined = docs.join(lost, (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return joined.select(docs.columns)
