"""Licences against SQL and all pairs."""

import random
import re

from check_queries import compare

from tidelog.llm import licenses
from tidelog.llm.queries import QUERIES, SQL


def test_whole_table(lspark, sf, duck):
    got = QUERIES["op10_licenses"](lspark, sf).toArrow()
    assert compare(got, duck.execute(SQL["op10_licenses"]).to_arrow_table()) == []
    assert got.num_rows > 5


def test_plan_has_no_python(lspark, sf):
    plan = QUERIES["op10_licenses"](lspark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_texts_are_read_once(lspark, sf):
    docs = lspark.read.parquet(f"{sf}/documents.parquet")
    read = licenses.licences(docs).inputFiles()
    assert not set(read) & set(docs.inputFiles())
    held = {r.doc_id for r in lspark.read.parquet(*read).select("doc_id").collect()}
    assert {r.doc_id for r in licenses.licences(docs).select("doc_id").collect()} <= held and 0 < len(held) < docs.count()


def test_necessary_words_are_rare(lspark):
    words = licenses.anchors(licenses.TEMPLATES | licenses.COMMON, 0.8)
    assert not {"by", "of", "the"}.intersection(words)
    texts = ["was made by them", "accord, succeed", "a CC", "(cc)", "cc0", "\u0130cc", "sublicenses", "\u24b8cc\u24b8", "_cc_"]
    frame = lspark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = frame.where(licenses._held(frame.text, licenses.TEMPLATES | licenses.COMMON, 0.8)).collect()
    assert {2, 3, 6, 7, 8} <= {r.doc_id for r in held} and not {0, 1, 4} & {r.doc_id for r in held}


def test_sizes_lose_nothing(lspark):
    rng = random.Random(3)
    docs, want = [], {}
    for k, (name, text) in enumerate(licenses.TEMPLATES.items()):
        words = text.split()
        for change in range(6):
            kept = [w for w in words if rng.random() > change / 20] + ["more"] * rng.randint(0, len(words) // 5)
            docs.append((100 * k + change, "\n".join(kept[:3]) + "\n" + " ".join(kept[3:]) if change % 2 else " ".join(kept)))
    for doc_id, text in docs:
        parts = {text, *text.split("\n")}
        for name, template in licenses.TEMPLATES.items():
            b = set(licenses.template_bigrams(template))
            scores = [2 * len(a & b) / (len(a) + len(b)) for a in (set(licenses.template_bigrams(p)) for p in parts) if a]
            if any(s >= 0.8 for s in scores):
                want[doc_id, name] = (max(scores), sum(s >= 0.8 for s in scores))
    got = licenses.scan(lspark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.licence): (r.dice, r.n_passages) for r in got} == want


def test_odd_rows(lspark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [(1, None, "a"), (2, "", "b"), (None, "intro\n\n" + mit + "\n \nend", "c"), (3, mit.replace(" ", "\t"), "d"), (4, "word " * 100_000, "e"),
            (5, "All rights reserved.", "f"), (5, "All rights reserved.", "f")]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, licence string")
    got = {(r.doc_id, r.licence): (round(r.dice, 6), r.n_passages) for r in licenses.scan(docs).collect()}
    assert got == {(None, "MIT"): (1.0, 2), (3, "MIT"): (1.0, 1), (5, "All rights reserved"): (1.0, 2)}
    assert licenses.scan(docs.limit(0)).count() == 0 and licenses.scan(docs, {}).count() == 0


def best_run(text, template):
    """The best Dice of any run of words, by trying all."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    grams, b, best = [f"{x} {y}" for x, y in zip(words, words[1:])], set(licenses.template_bigrams(template)), 0.0
    if len(b.intersection(grams)) < 0.6 * len(b):
        return best
    for i in range(len(grams)):
        seen, hits = set(), 0
        for g in grams[i:]:
            if g not in seen:
                seen.add(g)
                if len(seen) > 2 * len(b):
                    break
                hits += g in b
                best = max(best, 2 * hits / (len(seen) + len(b)))
    return best


def test_windows_against_all_runs(lspark):
    rng = random.Random(5)
    prose = [f"{rng.choice('abcdefgh')}{rng.randint(0, 60)}" for _ in range(150)] + "of the the license in the software all rights".split() * 4
    docs = []
    for k, text in enumerate((licenses.TEMPLATES | licenses.COMMON).values()):
        for change in range(2):
            words = [w for w in text.split() if rng.random() > change / 12]
            for at in sorted(rng.sample(range(len(words)), len(words) // 25), reverse=True):
                words[at:at] = rng.choices(prose, k=1)
            before, after = rng.choices(prose, k=rng.randint(0, 60)), rng.choices(prose, k=rng.randint(0, 60)) + ["more"] * rng.choice([0, 300])
            sep = rng.choice([" ", "\n", "\n\n"])
            docs.append((10 * k + change, sep.join(before + words + after)))
    got = {(r.doc_id, r.licence): r.dice for r in licenses.windows(lspark.createDataFrame(docs, "doc_id long, text string"), licenses.TEMPLATES | licenses.COMMON).collect()}
    want = {(doc_id, name): score for doc_id, text in docs for name, t in (licenses.TEMPLATES | licenses.COMMON).items() if (score := best_run(text, t)) >= 0.8}
    assert got == want and len(want) > 30


def test_licences_inside_texts(lspark):
    mit, header, gpl = (licenses.TEMPLATES[k] for k in ("MIT", "Apache-2.0 header", "GPL-3.0 header"))
    prose = " ".join(f"word{k}" for k in range(400))

    def split(text, *marks):
        for mark in marks:
            text = text.replace(mark, "\n\n" + mark)
        return f"{prose}\n\n{text}\n\n{prose}"

    docs = [(1, split(mit, "The above copyright", "THE SOFTWARE IS")), (2, split(header, "You may obtain", "Unless")), (3, split(gpl, "This program is distributed", "See the")),
            (4, f"{prose} {mit.replace(chr(10), ' ')} {prose}"), (5, f"{prose} {licenses.TEMPLATES['GPL-3.0 notice']} {prose}"),
            (6, split(licenses.COMMON["BSD-3-Clause"], "1. Redis", "2. Redis", "THIS\nSOFTWARE")), (7, prose), (8, f"{prose} all rights reserved. All Rights Reserved! {prose}")]
    frame = lspark.createDataFrame(docs, "doc_id long, text string")
    assert not {r.licence for r in licenses.scan(frame).collect()} & {"MIT", "Apache-2.0 header", "GPL-3.0 header"}
    got = {(r.doc_id, r.licence): (r.dice, r.n_passages) for r in licenses.licences(frame).collect()}
    for key in ((1, "MIT"), (2, "Apache-2.0 header"), (3, "GPL-3.0 header"), (4, "MIT"), (5, "GPL-3.0 notice"), (6, "BSD-3-Clause")):
        assert got[key] == (1.0, 1)
    assert got[8, "All rights reserved"] == (1.0, 2) and not any(d == 7 for d, _ in got)
    assert licenses.licences(frame.limit(0)).count() == 0 and licenses.licences(frame, {}).count() == 0
