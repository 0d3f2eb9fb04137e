"""Line groups against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa

from tidelog.llm import buckets, lines
from tidelog.llm.queries import QUERIES


def norm(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")


def brute(docs, least=0.8):
    """{(doc_id, line): keeper} by comparing all different lines."""
    places = {}
    for doc_id, text in docs:
        for k, raw in enumerate((text or "").split("\n") if text is not None else []):
            if norm(raw):
                places.setdefault(norm(raw), []).append((doc_id, k))
    texts = sorted(places)
    sets = [lines.shingles(t) for t in texts]
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    order = sorted(range(len(texts)), key=lambda i: len(sets[i]))
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if len(sets[i]) < least * len(sets[j]):
                break
            if lines.jaccard(sets[i], sets[j]) >= least:
                group[root(i)] = root(j)
    keeper = {}
    for i, t in enumerate(texts):
        keeper[root(i)] = min([keeper.get(root(i), (1 << 60, 0)), *places[t]])
    return {place: keeper[root(i)] for i, t in enumerate(texts) for place in places[t]}


def test_whole_table(lspark, sf):
    docs = [(r.doc_id, r.text) for r in lspark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {(r.doc_id, r.line): (r.keeper_doc_id, r.keeper_line) for r in QUERIES["op5_line_dedup"](lspark, sf).collect()}
    want = brute(docs)
    assert got.keys() == want.keys()
    assert sum(got[k] != want[k] for k in want) <= 0.002 * len(want)
    assert any(k != v for k, v in want.items())


def test_banding_recall():
    rng = random.Random(0)
    found = total = 0
    for _ in range(300):
        a = "".join(rng.choices("abcdefghij klmnop", k=rng.randint(30, 300)))
        b = list(a)
        for _ in range(max(1, len(a) // 60)):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        b = "".join(b)
        if lines.jaccard(lines.shingles(a), lines.shingles(b)) >= 0.8:
            total += 1
            x, y = lines.bands([a, b])
            found += (x == y).any()
    assert total > 100 and found >= 0.99 * total


def test_signature_depends_on_the_line_alone(monkeypatch):
    many = ["short", "", "a", "the same line " * 40, "漢字 and é" * 30, "x" * 5000]
    whole = lines.bands(many)
    monkeypatch.setattr(lines, "PIECE", 64)
    for k, line in enumerate(many):
        assert (lines.bands([line])[0] == whole[k]).all()
    assert len(np.unique(whole)) == whole.size


def test_large_bucket_in_blocks(lspark, monkeypatch):
    monkeypatch.setattr(buckets, "SMALL", 4)
    monkeypatch.setattr(buckets, "BLOCK", 8)
    rng = random.Random(1)
    base = ["".join(rng.choices("abcdefgh ", k=200)) for _ in range(3)]
    docs = []
    for k in range(90):
        line = list(base[k % 3])
        for _ in range(rng.randint(0, 9)):
            line[rng.randrange(200)] = "z"
        docs.append((k, "".join(line)))
    got = lines.near_lines(lspark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute(docs)
    assert sum((r.keeper_doc_id, r.keeper_line) != want[r.doc_id, r.line] for r in got) <= 2


def test_odd_rows(lspark):
    rows = [(3, "One  line\nAll rights reserved.\n\n \nend", "a", 1), (1, "one line\nx", "b", 2), (1, "one line\nx", "b", 2), (None, "x\nONE line", "c", 3), (4, None, "d", 4),
            (5, "", "e", 5), (-2, "all RIGHTS reserved.", "f", 6), (6, "ab " * 60_000, "g", 7)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, line string, n_chars long")
    got = {(r.doc_id, r.line): (r.keeper_doc_id, r.keeper_line, r.kept) for r in lines.near_lines(docs).collect()}
    assert got == {(3, 0): (1, 0, False), (3, 1): (-2, 0, False), (3, 4): (3, 4, True), (1, 0): (1, 0, True), (1, 1): (1, 1, True), (None, 0): (None, 0, True),
                   (None, 1): (None, 1, True), (-2, 0): (-2, 0, True), (6, 0): (6, 0, True)}
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    texts = {r.line: (r.text, r.n_chars) for r in kept.collect()}
    assert texts["a"] == ("\n \nend", 6) and texts["b"] == ("one line\nx", 2) and texts["d"] == (None, 4) and texts["c"] == ("x\nONE line", 3)
    assert kept.count() == len(rows)
    assert lines.near_lines(docs.limit(0)).count() == 0


def near_pairs(sizes, most=0.825):
    """Pairs of lines at Jaccard 0.8 to ``most``."""
    rng = random.Random(7)
    out = []
    while len(out) < 1500:
        a = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=rng.randint(*sizes))).strip()
        b = a
        while (j := lines.jaccard(lines.shingles(a), lines.shingles(b))) > most:
            at = rng.randrange(len(b))
            b = b[:at] + rng.choice("xyz") + b[at + rng.randint(0, 1):]
        if j >= 0.8 and lines.normalised(a) == a and lines.normalised(b) == b:
            out.append((a, b))
    return out


def test_banding_recall_at_the_bound():
    for sizes in ((20, 40), (60, 120)):
        pairs = near_pairs(sizes)
        x, y = (lines.bands(list(side)) for side in zip(*pairs))
        assert (~(x == y).any(axis=1)).sum() <= 9


def test_sketches_reject_no_short_pairs(lspark):
    pairs = near_pairs((12, 16))
    x, y = (lines.signatures(list(side)) for side in zip(*pairs))
    far = np.unpackbits((lines.sketches(x) ^ lines.sketches(y)).view(np.uint8), axis=1).sum(axis=1) > 28
    shared = (lines.bands([a for a, _ in pairs], x) == lines.bands([b for _, b in pairs], y)).any(axis=1)
    hard = [pairs[k] for k in np.nonzero(far & shared)[0]]
    assert hard
    docs = [(2 * k + side, line) for k, pair in enumerate(hard) for side, line in enumerate(pair)]
    got = {r.doc_id: r.keeper_doc_id for r in lines.near_lines(lspark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[2 * k + 1] == 2 * k for k in range(len(hard)))


def test_pairs_as_numbers_and_as_sets():
    rng = random.Random(3)
    xs, ys = [], []
    for alphabet in ("ab", "abcdefghijkl ", "abcé߿", "abࠀ漢"):
        for _ in range(300):
            a = "".join(rng.choices(alphabet, k=rng.randint(1, 200)))
            b = list(a)
            for _ in range(rng.randint(0, 6)):
                b[rng.randrange(len(b))] = rng.choice("abz\0")
            xs.append(a)
            ys.append("".join(b))
    want = [lines.jaccard(lines.shingles(x), lines.shingles(y)) >= 0.8 for x, y in zip(xs, ys)]
    assert 0 < sum(want) < len(want) and lines.near(xs, ys, 0.8).tolist() == want


def test_entries_move_once_and_packed(lspark):
    rng = np.random.default_rng(4)
    bands = rng.integers(0, 400, (600, lines.BANDS)) * 0x1E3779B97F4A7C15
    bands[:300, 0] = 77
    placed = lspark.createDataFrame([(int(v) % 500, [int(c) for c in b]) for v, b in enumerate(bands)], "v long, bands array<long>")
    plans = []

    class Kept(lines.Scratch):
        def store(self, df, name):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().store(df, name)

    got = lines._members(Kept(lspark, "test"), placed, 600 * lines.BANDS).collect()
    cells, want = {}, {}
    for v, b in enumerate(bands):
        for c in b.astype(np.uint64).tolist():
            want.setdefault((c % 64, c >> 32), set()).add(v % 500)
    for r in got:
        cells.setdefault((r.cell >> 32, r.cell & (1 << 32) - 1), set()).add(r.v)
        assert r.n > 1
    assert cells == {c: vs for c, vs in want.items() if len(vs) > 1}
    assert all(len({r.head for r in got if r.cell == cell}) == 1 for cell in {r.cell for r in got})
    assert max(len(vs) for vs in cells.values()) >= 300 > lines.HEAVY
    assert "Generate" not in plans[0] and plans[0].count("Exchange") == 1


def test_documents_beyond_31_bits(lspark):
    docs = [(1 << 40, "A line to keep"), (-(1 << 50), "a LINE to keep\nother"), ((1 << 62) + 1, "other")]
    got = {(r.doc_id, r.line): (r.keeper_doc_id, r.keeper_line) for r in lines.near_lines(lspark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_a_line_is_cut_into_shingles_once(monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefgh é", k=120))
    texts = sorted({"".join(rng.choice("xyz") if rng.random() < 0.02 else c for c in base) for _ in range(40)})
    pairs = [(x, y) for x in texts for y in texts]
    want = [lines.jaccard(lines.shingles(x), lines.shingles(y)) >= 0.8 for x, y in pairs]
    cut, numbers = [], lines._numbers
    monkeypatch.setattr(lines, "_numbers", lambda line: cut.append(line) or numbers(line))
    assert 0 < sum(want) < len(want) and lines.near(*zip(*pairs), 0.8).tolist() == want
    assert sorted(cut) == texts
    cut.clear()
    n = len(texts)
    both = pa.table({"left": [True] * n + [False] * n, "v": [*range(n)] * 2, "comp": [*range(n)] * 2, "norm": texts * 2})
    links = lines._links_in_blocks(both, 0.8)
    assert set(zip(links["a"].to_pylist(), links["b"].to_pylist())) == {(i, j) for i in range(n) for j in range(n) if i != j and want[i * n + j]}
    assert sorted(cut) == texts
    monkeypatch.setattr(lines, "HELD", 300)
    assert lines.near(*zip(*pairs), 0.8).tolist() == want


def test_lines_that_come_once_are_joined_no_more(lspark, monkeypatch):
    stored = {}

    class Kept(lines.Scratch):
        def store(self, df, name):
            out = super().store(df, name)
            stored[name] = out.count()
            return out

    monkeypatch.setattr(lines, "Scratch", Kept)
    rng = random.Random(6)
    own = ["".join(rng.choices("abcdefghijkl ", k=80)).strip() for _ in range(30)]
    docs = [(k, f"{line}\nTwice" if k in (3, 7) else line) for k, line in enumerate(own)] + [(90, own[4] + "z"), (91, own[0].upper())]
    got = {(r.doc_id, r.line): (r.keeper_doc_id, r.keeper_line) for r in lines.near_lines(lspark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs) and got[90, 0] == (4, 0) and got[91, 0] == (0, 0) and got[7, 1] == (3, 1)
    assert stored["keepers"] == 4


def test_white_space_of_lines():
    for text in ("", " \n\t\n", "a\v\fb\r\n  c  d\t\te \x1c \x85  x", "\n\n a", " " * 1001 + "x" + "\t " * 333 + "Y", "漢字\0 \n \x1f  İ"):
        assert lines.numbered_lines(text) == [(at, line.encode()) for at, raw in enumerate(text.split("\n")) if (line := lines.normalised(raw))]
    assert lines.numbered_lines(None) == []
