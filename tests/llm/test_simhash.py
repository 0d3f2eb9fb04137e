"""SimHash groups against all pairs, and the odd rows."""

import re

import xxhash

from tidelog.llm import simhash
from tidelog.llm.queries import QUERIES


def brute(rows):
    """component_id per position, all pairs compared, by a plain union-find."""
    prints = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return prints, [least.get(g) for g in group]


def test_whole_table(lspark, sf):
    rows = [tuple(r) for r in lspark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    prints, groups = brute(rows)
    want = sorted((d, f"{p:016x}", g) for (d, _), p, g in zip(rows, prints, groups))
    got = sorted(tuple(r) for r in QUERIES["op8_simhash"](lspark, sf).select("doc_id", "fingerprint", "component_id").collect())
    assert got == want


def test_links_of_flipped_bits(lspark):
    base = 0x0123456789ABCDEF
    flips = [0, 1, 1 << 63, 3, (1 << 40) | (1 << 5), 7 << 20, (1 << 63) | 1, 0b1111 << 50]
    values = [base ^ f for f in flips]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(lspark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in links)
    joined = {frozenset((r.a, r.b)) for r in links}
    reach = {signed[0]}
    for _ in signed:
        reach |= {v for pair in joined if pair & reach for v in pair}
    assert reach == {v for v in signed if v not in (signed[5], signed[7])}


def test_odd_rows(lspark):
    rows = [(5, None, "a"), (3, "", "b"), (None, "  \t\n", "c"), (9, "x y z w", "d"), (7, "X Y\nz w", "e"), (7, "X Y\nz w", "e"),
            (1, "word " * 60_000, "f"), (None, "lone unrelated words here", "g")]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, fp string")  # a column with a clashing name
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (None, 3), (9, 7), (7, 7), (7, 7), (1, 1), (None, None)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.fp) for r in kept.collect()) == [("1", "f"), ("3", "b"), ("7", "e"), ("None", "c"), ("None", "g")]


def test_empty_table(lspark):
    assert simhash.near_duplicates(lspark.createDataFrame([], "doc_id long, text string")).count() == 0
