"""Collocations: suffixes of words routed by their leading words and counted by multikey three-way quicksort."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch

LEAST, LONGEST, TOP = 100, 5, 2000
# Distinct words or suffixes a task adds up before it hands them on; a bound on memory only.
HELD = 200_000
# Bits of a filter of frequent words or pairs, at most 16 MB: with more keys it only lets more through.
FILTER_BITS = 1 << 27
# Occurrences in one bucket, and of one pair of leading words before it is split over buckets.
BUCKET = 1 << 16
SPREAD = 64

_BREAKS = re.compile(rb"[.,;:!?\x0A-\x0D]+")
# No byte of a UTF-8 text.
_BREAK = b"\xff"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _by_lang(batch: pa.RecordBatch):
    """(lang, dictionary of words, numbers of all words in order); number of _BREAK between pieces, 0 in every dictionary."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        tokens = texts.setdefault(lang, [_BREAK])
        tokens += _BREAKS.sub(b" \xff ", text.encode("utf-8", "surrogatepass").lower()).split()
        tokens.append(_BREAK)
    for lang, tokens in texts.items():
        words = pa.array(tokens, pa.binary()).dictionary_encode()
        yield lang, words.dictionary.to_pylist(), words.indices.to_numpy()


def _flushed(held: dict[str, Counter], names: list[str]):
    """Rows (lang, phrase, n) of what a task has added up."""
    rows = [(lang, phrase, n) for lang, counts in held.items() for phrase, n in counts.items()]
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.int64()))], names)


def _count_words(rows):
    """(lang, word, n); a row with a null word has the number of all words."""
    held: dict[str, Counter] = {}
    for batch in rows:
        for lang, words, codes in _by_lang(batch):
            counts = held.setdefault(lang, Counter())
            found = np.bincount(codes, minlength=len(words))
            counts.update(dict(zip(words[1:], found[1:].tolist())))
            counts[None] += int(found[1:].sum())
        if sum(map(len, held.values())) > HELD:
            yield _flushed(held, ["lang", "word", "n"])
            held = {}
    yield _flushed(held, ["lang", "word", "n"])


class Filter:
    """A Bloom filter of two bits a key, small enough to be sent to every task."""

    def __init__(self, keys: DataFrame, count: int):
        """``keys`` has a 64-bit hash ``key``. At most FILTER_BITS / 64 numbers reach the driver, however many keys there are."""
        self.bits = min(FILTER_BITS, 1 << max(10, (16 * count).bit_length()))
        places = F.explode(F.array(*[p.bitwiseAND(F.lit(self.bits - 1)) for p in (F.col("key"), F.shiftrightunsigned("key", 32))]))
        words = keys.select(places.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("set"))
        found = words.toArrow()
        self.words = np.zeros(self.bits // 64, np.uint64)
        self.words[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that are not in the filter."""
        out = np.ones(len(keys), bool)
        for key in (keys, keys >> np.uint64(32)):
            at = key & np.uint64(self.bits - 1)
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def _pairs(lang: str, words: list[bytes], codes: np.ndarray, frequent: Filter) -> tuple[np.ndarray, np.ndarray]:
    """(whether the word and the next one may both be frequent, 64-bit numbers of these pairs), for every word but the last."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)
    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)
    good = frequent.maybe(hashes)
    good[0] = False
    both = good[codes[:-1]] & good[codes[1:]]
    first, second = hashes[codes[:-1][both]], hashes[codes[1:][both]]
    with np.errstate(over="ignore"):
        key = (first ^ (first >> np.uint64(29))) * _MIX + second
        key = (key ^ (key >> np.uint64(32))) * _MIX
    return both, key ^ (key >> np.uint64(31))


def _count_pairs(rows, frequent):
    """(key, n) of neighbouring words that may both be frequent."""
    held, size = [], 0
    kinds = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def added_up():
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)
        return keys, n

    for batch in rows:
        for lang, words, codes in _by_lang(batch):
            _, keys = _pairs(lang, words, codes, frequent.value)
            keys, n = np.unique(keys, return_counts=True)
            held.append((keys, n))
            size += len(keys)
        if size > 8 * HELD:
            held = [added_up()]
            if len(held[0][0]) > 4 * HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], schema=kinds)
                held = []
            size = sum(len(k) for k, _ in held)
    if held:
        keys, n = added_up()
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], schema=kinds)


def _suffixes(rows, frequent, pairs, route, longest: int):
    """(bucket, lang, split, suffixes, counts): from each word on up to ``longest`` words, cut before the first pair that cannot be frequent.

    The pair of leading words names the bucket; a suffix of a ``split`` pair is dealt by all its words. A row
    holds all suffixes that a task has for a bucket, one a line, and how often it has each.
    """
    held: dict[tuple, Counter] = {}
    hot, buckets = route.value
    for batch in rows:
        for lang, words, codes in _by_lang(batch):
            both, keys = _pairs(lang, words, codes, frequent.value)
            both = np.flatnonzero(both)
            maybe = pairs.value.maybe(keys)
            good = np.zeros(len(codes) + longest, np.int64)
            good[both[maybe]] = 1
            more = np.zeros(len(codes), np.int64)
            for k in range(longest - 2, -1, -1):
                more = good[k:k + len(codes)] * (1 + more)
            at = np.flatnonzero(more)
            padded = np.concatenate((codes, np.zeros(longest, codes.dtype)))
            columns = padded[at[:, None] + np.arange(longest)]
            columns[np.arange(longest) > more[at][:, None]] = -1
            different, first, n = np.unique(columns, axis=0, return_index=True, return_counts=True)
            lead = keys[maybe][first]
            split = np.isin(lead, hot)
            for row, count, bucket, is_split in zip(different.tolist(), n.tolist(), (lead % np.uint64(buckets)).tolist(), split.tolist()):
                suffix = b" ".join([words[c] for c in row if c >= 0])
                if is_split:
                    bucket = xxhash.xxh64_intdigest(suffix, bucket) % buckets
                held.setdefault((bucket, lang, is_split), Counter())[suffix] += count
        if sum(map(len, held.values())) > HELD:
            yield _packed(held)
            held = {}
    yield _packed(held)


def _packed(held: dict[tuple, Counter]) -> pa.RecordBatch:
    keys = [pa.array([k[i] for k in held], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.bool_()))]
    suffixes = pa.array([b"\n".join(counts) for counts in held.values()], pa.binary())
    counts = pa.array([np.fromiter(counts.values(), "<i8", len(counts)).tobytes() for counts in held.values()], pa.binary())
    return pa.RecordBatch.from_arrays([*keys, suffixes, counts], ["bucket", "lang", "split", "suffixes", "counts"])


def multikey_counts(suffixes: np.ndarray, weights: np.ndarray, least: int, shortest: int = 2):
    """(row, length, count) of all prefixes of ``shortest`` words or more that rows of ``suffixes`` with weight ``least`` or more begin with.

    Multikey three-way quicksort of the rows' numbers: a stretch whose rows agree in their first
    words is split by the next word of a middle row into smaller, equal and larger. The weight of the
    equal part is the count of its prefix; it goes on with the next word. Parts lighter than
    ``least`` hold no frequent phrase and are abandoned unsorted. -1 ends a row.
    """
    stack = [(np.arange(len(weights)), 0)] if len(weights) else []
    while stack:
        rows, depth = stack.pop()
        words = suffixes[rows, depth]
        tried = np.sort(words[:: max(1, len(words) // 64)])
        pivot = int(tried[len(tried) // 2])
        for part, deeper in ((rows[words < pivot], 0), (rows[words == pivot], 1), (rows[words > pivot], 0)):
            weight = int(weights[part].sum())
            if weight < least or not len(part):
                continue
            if deeper:
                if pivot < 0:
                    continue
                if depth + 1 >= shortest:
                    yield int(part[0]), depth + 1, weight
                if depth + 1 == suffixes.shape[1]:
                    continue
            stack.append((part, depth + deeper))


def _sorted_bucket(least: int, longest: int):
    def counts(table: pa.Table) -> pa.Table:
        out = []
        for lang in pc.unique(table.column("lang")).to_pylist():
            for split in (False, True):
                part = table.filter((pc.field("lang") == lang) & (pc.field("split") == split))
                if not part.num_rows:
                    continue
                lists = [s.split(b" ") for held in part.column("suffixes").to_pylist() for s in held.split(b"\n")]
                words = pa.array([w for s in lists for w in s], pa.binary()).dictionary_encode()
                sizes = np.array([len(s) for s in lists])
                matrix = np.full((len(lists), longest), -1, np.int32)
                matrix[np.arange(longest) < sizes[:, None]] = words.indices.to_numpy()
                weights = np.frombuffer(b"".join(part.column("counts").to_pylist()), "<i8")
                # Elsewhere there may be more of a split pair: nothing of it can be abandoned here.
                for row, length, n in multikey_counts(matrix, weights, 1 if split else least):
                    out.append((lang, b" ".join(lists[row][:length]), length, n))
        langs, phrases, sizes, f = zip(*out) if out else ([], [], [], [])
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                         "size": pa.array(sizes, pa.int32()), "f": pa.array(f, pa.int64())})

    return counts


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, name: str = "phrases") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of 1 to ``longest`` words with f >= ``least`` occurrences, (lang, n) words in all).

    Words and pairs that are not frequent cut the suffixes, as no frequent phrase holds one; they
    are told by filters of bounded size that at worst cut less. Suffixes go to buckets by their
    first two words. A pair with very many occurrences is split over buckets by the whole suffix,
    and its counts are added up afterwards. There are at most 65,536 such pairs.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, name)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    kinds = "lang string, {} binary, n long"
    words = texts.mapInArrow(_count_words, kinds.format("word")).groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = scratch.store(words.where(f"word IS NULL OR f >= {least}").withColumn("word", F.col("word").cast("string")), "words")
    totals, words = words.where("word IS NULL").select("lang", F.col("f").alias("n")), words.where("word IS NOT NULL")
    frequent = spark.sparkContext.broadcast(Filter(words.select(F.xxhash64("lang", "word").alias("key")), words.count()))
    pairs = texts.mapInArrow(lambda rows: _count_pairs(rows, frequent), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    pairs = scratch.store(pairs.where(f"n >= {least}"), "pairs")
    in_pairs = spark.sparkContext.broadcast(Filter(pairs.select("key"), pairs.count()))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    hot = pairs.where(F.col("n") > max(BUCKET, total >> 16)).select("key").toArrow().column("key").to_numpy().view(np.uint64)
    route = spark.sparkContext.broadcast((hot, max(SPREAD, total // BUCKET)))
    routed = texts.mapInArrow(lambda rows: _suffixes(rows, frequent, in_pairs, route, longest),
                              "bucket long, lang string, split boolean, suffixes binary, counts binary")
    sort = _sorted_bucket(least, longest)
    found = routed.groupBy("bucket").applyInArrow(sort, "lang string, phrase string, size int, f long")
    found = found.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.sum("f").alias("f")).where(f"f >= {least}")
    ones = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    return scratch.store(ones.union(found), "phrases"), totals


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words or more: the cut that scores lowest, the first of several."""
    def exact(c: str) -> Column:
        return F.col(c).cast("decimal(19,0)")

    cuts = phrases.where("size > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    known = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    known = known.withColumn("top", F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n")).withColumn("under", exact("l") * exact("r"))
    best = known.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr("top div under").alias("score"), "k", "l", "r")).alias("b"),
                                               F.first("a").alias("a"), F.first("n").alias("n"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, name: str = "collocations") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by their association score, ties to larger a, then the phrase's bytes.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at
    spaces and tabs. A phrase has 2 to ``longest`` words and a >= ``least`` occurrences within pieces.
    n counts the language's words; l and r count the two parts of the cut with the lowest score
    1000 * a * n // (l * r). Phrases inside a longer one with as many occurrences are left out. A null
    lang is ``und``, a null text empty; repeated rows count as often as they are there; other columns are
    ignored; an empty table gives no rows. Counts cover all rows.
    """
    phrases, totals = phrase_counts(docs, least, longest, name)
    # A longer phrase occurs no more often than what it holds: if any one has as many occurrences, one that is a word longer has.
    inside = phrases.where("size > 2").select("lang", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring(phrase, instr(phrase, ' ') + 1)"))).alias("phrase"), F.col("f").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    open_ = _scored(phrases, totals).join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").drop("longer")
    order = "ORDER BY score DESC, a DESC, phrase"
    # First the best of parts of a language, then the best of these: no task sorts a whole language.
    parts = open_.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    parts = parts.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, part {order})")).where(f"rank <= {top}")
    ranked = parts.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})")).where(f"rank <= {top}")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
