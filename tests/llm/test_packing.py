"""Plans against the optimum by trying everything, pieces against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelog.llm import packing
from tidelog.llm.queries import QUERIES

FILES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def optimum(items, capacity):
    """Fewest bins, by depth-first search over all placements."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for free in {b for b in bins if b >= items[k]}:
            rest = list(bins)
            rest.remove(free)
            go(k + 1, [*rest, free - items[k]])
        go(k + 1, [*bins, capacity - items[k]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_small_plans_are_optimal(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 50, 100])
    items = [rng.randint(max(1, capacity // rng.choice([3, 5, 100])), capacity) for _ in range(rng.randint(1, 11))]
    plan = packing.bin_completion(Counter(items), capacity)
    assert all(sum(p) <= capacity for p, _ in plan)
    assert sum((Counter({x: n * t for x, n in Counter(p).items()}) for p, t in plan), Counter()) == Counter(items)
    assert packing.sequences(plan) == optimum(items, capacity)


def test_search_beats_best_fit():
    items = Counter({44: 4, 31: 4, 25: 8, 26: 2, 30: 2, 48: 2, 52: 2})
    assert packing.sequences(packing.bin_completion(items, 100)) <= packing.sequences(packing.best_fit(items, 100))


def test_no_lengths():
    assert packing.bin_completion({}, 10) == []
    assert [len(a) for a in packing.slots([])] == [0, 0, 0]


def check(rows, texts, capacity=1024):
    """Everything the contract says of ``rows``; the number of sequences."""
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    places = defaultdict(list)
    by_doc = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = [*coder.encode(text, add_special_tokens=False).ids, 2]
        parts = sorted(by_doc.pop(doc_id), key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert all(p.length == capacity for p in parts[1:]) and len(parts) == -(-len(ids) // capacity)
        at = 0
        for p in parts:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert not by_doc
    return len(places)


def test_whole_table(lspark, sf):
    texts = {r.doc_id: r.text for r in lspark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_packing"](lspark, sf).collect()
    lower = -(-sum(r.length for r in rows) // 1024)
    assert lower <= check(rows, texts) <= lower + 1


def test_odd_rows(lspark):
    rows = [(1, None, 3), (2, "", 4), (None, "one two", 5), (3, "word " * 20_000, 6), (4, " ", 7)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack(docs, *FILES, with_ids=True).collect()
    check(got, {d: t or "" for d, t, _ in rows})
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    twice = packing.pack(docs.union(docs), *FILES).collect()
    assert len(twice) == 2 * len(got) and len({(r.sequence_id, r.offset) for r in twice}) == len(twice)
    assert packing.pack(docs.limit(0), *FILES).count() == 0
