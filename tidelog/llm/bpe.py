"""Byte-level BPE with a rank queue on hierarchical bitmaps: encoding to ids and back."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.chunks import ChunkMemory, Recent, groups

TOGETHER = 1 << 16  # characters of pre-tokens that are merged together; a bound on memory only
REMEMBERED = 200_000  # pre-tokens that stand inside chunks, as marks and words after a line feed
WORD = 8  # bits of a rank that choose the place in a bitmap word
MASK = (1 << WORD) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBPE:
    """Encodes and decodes by one rank file and one split pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        # White space as Unicode has it, whatever the library's shorthand includes.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                   .replace(r"\S", r"\P{White_Space}")).findall
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # Ranks of two single bytes, the first pairs of every pre-token.
        self.two = np.array([self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)], np.int32)
        self.one = np.array([self.ranks[bytes((a,))] for a in range(256)], np.uint32)
        self.words = [0] * ((max(self.tokens) >> WORD) + 1)
        self.inner = Recent(REMEMBERED)
        self.memory = ChunkMemory(self._chunks)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, none of them empty: merge its pair of lowest rank, leftmost first, until no pair has a rank.

        All pre-tokens are merged together: no pair crosses a border, so each has its own order of
        merges. The tokens are a linked list (``end``, ``before``); ``buckets`` holds the positions
        of pairs by rank. Two levels of bitmaps tell which ranks have positions: ``words`` has a bit
        per rank, ``top`` one per word of 2^8 ranks, and find-first-set on both gives the next rank.
        Its positions are taken from the left until a merge makes a pair of a lower rank, which goes first.
        Entries are not removed when a merge makes them stale: they are skipped when taken, as ``pair`` no longer has
        their rank. A merge costs the same wherever it is, so pre-tokens of n bytes take n log n steps.
        """
        get, data = self.ranks.get, b"".join(pieces)
        n, borders = len(data), np.cumsum([len(p) for p in pieces])
        border = bytearray(n + 1)
        for at in (0, *borders.tolist()):
            border[at] = 1
        codes = np.frombuffer(data, np.uint8)
        first = np.full(n, -1, np.int32)
        first[:-1] = self.two[codes[:-1].astype(np.int32) << 8 | codes[1:]]
        first[borders - 1] = -1
        order = np.argsort(first, kind="stable")[np.count_nonzero(first < 0):]
        kinds, at = np.unique(first[order], return_index=True)
        buckets = {rank: places.tolist() for rank, places in zip(kinds.tolist(), np.split(order, at[1:]))}
        pair, token, end, before = first.tolist(), self.one[codes].tolist(), [*range(1, n + 1), 0], [*range(-1, n)]
        words, top = self.words, 0
        for rank in buckets:
            words[rank >> WORD] |= 1 << (rank & MASK)
            top |= 1 << (rank >> WORD)
        while top:
            high = (top & -top).bit_length() - 1
            word = words[high]
            rank = high << WORD | (word & -word).bit_length() - 1
            words[high] = word = word & word - 1
            if not word:
                top &= top - 1
            bucket, lower = buckets.pop(rank), False
            bucket.sort()
            for k, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale
                j = end[i]
                stop = end[j]
                end[i], end[j], before[stop], token[i], pair[i], pair[j] = stop, 0, i, rank, -1, -1
                # The merged token makes a new pair with each neighbour.
                if not border[stop] and (made := get(data[i:end[stop]])) is not None:
                    pair[i] = made
                    if made in buckets:
                        buckets[made].append(i)
                    else:
                        buckets[made] = [i]
                        words[made >> WORD] |= 1 << (made & MASK)
                        top |= 1 << (made >> WORD)
                        lower = made < rank
                if not border[i]:
                    h = before[i]
                    pair[h] = made = get(data[h:stop], -1)
                    if made in buckets:
                        buckets[made].append(h)
                    elif made >= 0:
                        buckets[made] = [h]
                        words[made >> WORD] |= 1 << (made & MASK)
                        top |= 1 << (made >> WORD)
                        lower = lower or made < rank
                if lower:
                    if rest := bucket[k + 1:]:
                        buckets[rank] = rest
                        words[high] |= 1 << (rank & MASK)
                        top |= 1 << high
                    break
        starts = np.nonzero(end[:-1])[0]
        ids = np.array(token, "<u4")[starts].tobytes()
        cuts = [0, *(4 * np.searchsorted(starts, borders)).tolist()]
        return [ids[x:y] for x, y in zip(cuts, cuts[1:])]

    def _place(self, piece: str) -> tuple[Recent, str]:
        """Where a pre-token is remembered; with a space before it it is a chunk."""
        return (self.memory.known, piece[1:]) if piece[0] == " " and not piece.isspace() else (self.inner, piece)

    def _merged(self, pieces: list[str]) -> list[bytes]:
        texts = [p.encode("utf-8") for p in pieces]
        rest = [t for t in texts if t not in self.ranks]
        merged = iter(self.merge(rest) if rest else ())
        return [self.ranks[t].to_bytes(4, "little") if t in self.ranks else next(merged) for t in texts]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        # A word with a space before it is one match of the pattern.
        cut = {c: self.split(c) for c in chunks if c[0] != " " or not c[1:].isalpha()}
        ids: dict[str, bytes | None] = dict.fromkeys(c for c in chunks if c not in cut)
        places = {p: self._place(p) for pieces in cut.values() for p in pieces if p not in ids}
        ids.update((p, known.get(key)) for p, (known, key) in places.items())
        for group in groups([p for p, found in ids.items() if found is None], TOGETHER):
            ids.update(zip(group, self._merged(group)))
        self.inner.make_room(sum(known is self.inner for known, _ in places.values()))
        for p, (known, key) in places.items():
            known.new[key] = ids[p]
        return [b"".join(map(ids.__getitem__, cut[c])) if c in cut else ids[c] for c in chunks]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian unsigned 32-bit."""
        return self.memory.ids(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; what they have in common is encoded once."""
        return self.memory.many(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_MADE: dict[tuple[str, str], ByteBPE] = {}


def coder(path: str, pattern: str) -> ByteBPE:
    """One encoder per worker process, so that tasks share what it remembers."""
    if (path, pattern) not in _MADE:
        _MADE[path, pattern] = ByteBPE(path, pattern)
    return _MADE[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids binary) for every row: the ids of the whole text as little-endian unsigned 32-bit numbers."""
    def batches(rows):
        bpe = coder(path, pattern)
        for batch in rows:
            ids = bpe.encode_all([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, "doc_id long, ids binary")


def decoded(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes binary) for rows of (doc_id, ids)."""
    def batches(rows):
        bpe = coder(path, pattern)
        for batch in rows:
            back = [bpe.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(back, pa.binary())], ["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(batches, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``: its ids, and what they decode to.

    Null text is empty text: no ids, the digests of nothing. Null and repeated doc_ids each give a
    row; other columns are ignored; an empty table gives no rows. Texts of any length are encoded
    whole, and one pre-token of any length in one run of the rank queue.
    """
    def batches(rows):
        bpe = coder(path, pattern)
        for batch in rows:
            ids = bpe.encode_all([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        batches, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
