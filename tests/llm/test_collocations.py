"""Phrases and scores against brute force."""

import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import collocations
from tidelog.llm.queries import QUERIES, SQL


def brute(rows, least, longest=5, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i:i + size])] = counts.get((lang, tuple(words[i:i + size])), 0) + 1
    kept = {k: n for k, n in counts.items() if n >= least}
    out = {}
    for (lang, words), a in kept.items():
        if len(words) < 2:
            continue
        n = totals[lang]
        score, _, l, r = min((1000 * a * n // (kept[lang, words[:k]] * kept[lang, words[k:]]), k, kept[lang, words[:k]], kept[lang, words[k:]])
                             for k in range(1, len(words)))
        inside = any(f >= a and lg == lang and len(w) > len(words) and any(w[i:i + len(words)] == words for i in range(len(w) - len(words) + 1))
                     for (lg, w), f in kept.items())
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r, n))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n, -s) for lang, found in out.items() for k, (s, a, p, l, r, n) in enumerate(sorted(found)[:top]))


def random_rows(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "city", "São", "Paulo", "a\xa0b", "x\x00", "日本", "-"]
    return [(rng.choice(["en", "en", "de", None, "und"]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"])
             for _ in range(rng.randint(0, 60)))) for _ in range(n)] + [("en", None), ("en", ""), ("fr", " . , ")]


def result(spark, rows, least, **more):
    docs = spark.createDataFrame([(k % 5, *r) for k, r in enumerate(rows)], "n long, lang string, text string").repartition(5)
    return sorted(map(tuple, collocations.collocations(docs, least, **more).collect()))


def test_random_texts(lspark):
    rows = random_rows(1)
    assert result(lspark, rows, 7) == brute(rows, 7)


def test_split_pairs_small_buckets_and_flushes(lspark, monkeypatch):
    monkeypatch.setattr(collocations, "BUCKET", 20)
    monkeypatch.setattr(collocations, "HELD", 30)
    rows = random_rows(2) + [("en", "new york city the of " * 50)] * 3
    assert result(lspark, rows, 5) == brute(rows, 5)


def test_full_filters_change_nothing(lspark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    rows = random_rows(3)
    assert result(lspark, rows, 9) == brute(rows, 9)


def test_top(lspark):
    rows = random_rows(4)
    assert result(lspark, rows, 5, top=3) == brute(rows, 5, top=3)


def test_empty(lspark):
    assert collocations.collocations(lspark.createDataFrame([], "lang string, text string")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=4), st.integers(1, 9)), max_size=40), st.integers(1, 20))
def test_multikey_counts(rows, least):
    matrix = np.array([w + [-1] * (4 - len(w)) for w, _ in rows], np.int32).reshape(-1, 4)
    want = Counter()
    for words, n in rows:
        for k in range(2, len(words) + 1):
            want[tuple(words[:k])] += n
    got = {tuple(matrix[row, :k].tolist()): n for row, k, n in collocations.multikey_counts(matrix, np.array([n for _, n in rows], np.int64), least)}
    assert got == {k: n for k, n in want.items() if n >= least}


def test_whole_table(lspark, duck, sf):
    got = sorted(map(tuple, QUERIES["op13_collocations"](lspark, sf).collect()))
    want = sorted(duck.execute(SQL["op13_collocations"]).fetchall())
    assert got == want and got
