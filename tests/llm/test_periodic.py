"""Runs against a brute-force definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import periodic
from tidelog.llm.queries import QUERIES


def brute(words):
    """(start, length, period) straight from the definition."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def found(*texts):
    symbols, ends = periodic._symbols([t.encode().split() for t in texts])
    return [tuple(map(int, r)) for r in zip(*periodic.find_runs(symbols))]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_small_alphabet(parts):
    word = "".join(p * n for p, n in parts)
    assert found(" ".join(word)) == brute(list(word))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 9))
def test_long_periods(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randint(1, 6)):
        q = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60])
        base = [rng.choice("abcd" if rng.random() < .5 else "ab") for _ in range(q)]
        n = rng.randint(1, 6 * q)
        words += (base * 6)[:n]
    assert found(" ".join(words)) == brute(words)


def test_words_of_different_texts_are_never_one_run():
    assert found("a a a", "a a a", "b") == []
    assert found("a a a a a a", "a a a a a a") == [(0, 6, 1), (7, 6, 1)]


def test_occurrences_in_a_window(monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.permutation(500)
    tree = periodic.WaveletMatrix(values.astype(np.int64))
    lo = rng.integers(0, 500, 300)
    hi = np.minimum(500, lo + rng.integers(1, 80, 300))
    bound = rng.integers(0, 600, 300)
    below = tree.below(lo, hi, bound)
    for a, b, x, n in zip(lo, hi, bound, below):
        inside = sorted(values[a:b])
        assert n == sum(v < x for v in inside)
        if n < len(inside):
            assert tree.smallest(np.array([a]), np.array([b]), np.array([n]))[0] == inside[n]


def test_whole_table(lspark, sf):
    rows = QUERIES["op11_periodic_runs"](lspark, sf).collect()
    docs = {r.doc_id: r.text for r in lspark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        words = planted(r.doc_id, docs[r.doc_id])
        if len(words) > 1500:  # brute force grows with the square
            continue
        runs = brute(words)
        assert r.n_runs == len(runs)
        if runs:
            s, n, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
        text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(collapsed(words, runs)).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in rows) > 5


@pytest.mark.parametrize("size", [1, 7, 1 << 19])
def test_odd_rows(lspark, monkeypatch, size):
    monkeypatch.setattr(periodic, "WORDS", size)
    long = "x y " * 30_000
    rows = [(1, None, "t"), (2, "", "t"), (3, " \t\n\x0b\x0c\r", "t"), (4, "a b a b", "t"), (5, "go " * 9 + "on", "t"), (5, "go " * 9 + "on", "t"),
            (None, "no no no no no no", "t"), (6, long, "t"), (7, "a b a b a b a b c", "t")]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].runs == [] and by[k].collapsed == "" and by[k].n_words == 0 for k in (1, 2, 3))
    assert by[4].n_words == 2
    assert [tuple(r) for r in by[5].runs] == [(0, 9, 1)] and by[5].collapsed == "go on"
    assert by[None].collapsed == "no" and [tuple(r) for r in by[6].runs] == [(0, 60_000, 2)] and by[6].collapsed == "x y"
    assert by[7].collapsed == "a b c"
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
