"""Columns that clash with working names, and rows that repeat a doc_id or vec_id with other contents."""

import random

import numpy as np
from tokenizers import Tokenizer
import public_tokenizers

from tidelog.llm import lattice, lines, packing, simhash, topk, toxicity
from pyspark.sql import functions as F

NAMES = ["_doc", "_Gone", "_key", "_kept", "_score", "_own", "_own_", "key", "v", "fp", "line", "kept"]


def clashing(spark, rows):
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(*r, *NAMES) for r in rows], schema)


def test_columns_of_any_name(lspark):
    docs = clashing(lspark, [(1, "same line here\nown one"), (2, "same line here\nother two"), (3, None)])
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "same line here\nown one", 2: "other two", 3: None}
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns and one.count() == 3
    labels = lspark.createDataFrame([], "doc_id long, toxic int")
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and clean.count() == 3 and all(r["_score"] == "_score" for r in clean.collect())


def test_different_texts_under_one_id_lose_only_their_own(lspark):
    docs = lspark.createDataFrame([(1, "a line that repeats\nx"), (2, "a line that repeats\ny"), (2, "TOTALLY different line that must stay\nz")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in lines.without_repeats(docs).collect())
    assert got == [(1, "a line that repeats\nx"), (2, "TOTALLY different line that must stay\nz"), (2, "y")]
    rng = random.Random(0)
    long = [" ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(200)) for _ in range(2)]
    docs = lspark.createDataFrame([(1, long[0]), (1, long[1]), (1, long[0]), (2, long[1])], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == sorted(long)


def test_every_row_of_a_repeated_vector_id_is_a_candidate(lspark):
    rows = [(0, [1.0]), (3, [0.5]), (3, [0.9]), (3, [0.9]), (4, [0.25])]
    vectors = lspark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(vectors, F.col("id") == 0, 3, "test")
    assert sorted((r["rank"], r.vec_id, r.score) for r in got.collect()) == [(1, 3, 256 * 230), (2, 3, 256 * 230), (3, 3, 256 * 128)]


def test_tiny_and_huge_vectors(lspark):
    rows = [(1, [1e-200, 0.0]), (2, [0.0, 1e-200]), (3, [2e-200, 0.0]), (4, [1e200, 1e200]), (5, [2e200, 2e200]), (6, [5e-324, 0.0])]
    vectors = lspark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.component_id, r.n_links, r.kept) for r in lattice.near_duplicates(vectors).collect()}
    assert got == {1: (1, 2, True), 3: (1, 2, False), 6: (1, 2, False), 2: (2, 0, True), 4: (4, 1, True), 5: (4, 1, False)}


def test_block_products_agree_with_pairs():
    rng = np.random.default_rng(0)
    x = lattice.scaled(rng.normal(size=(40, 6)))
    y = np.vstack([lattice.scaled(x * 3), lattice.scaled(rng.normal(size=(40, 6)))])
    pairs = np.array([[lattice.pairs_close(x[i:i + 1], y[j:j + 1], 0.9)[0] for j in range(len(y))] for i in range(len(x))])
    assert (lattice.all_close(x, y, 0.9) == pairs).all()


def test_special_token_text(lspark):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "<|endoftext", ""]
    docs = lspark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True, added=added).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {
        k: [*coder.encode(t, add_special_tokens=False).ids, 2] for k, t in enumerate(texts)}


def test_a_repeated_labelled_document_is_one_example(lspark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "learn", lambda model, votes: seen.append(len(votes)) or model)
    hot = [(4, f"text {k}") for k in range(300)]
    docs = lspark.createDataFrame(hot + [(k, f"you idiot {k}") for k in range(100, 140)], "doc_id long, text string")
    labels = lspark.createDataFrame([(4, 0)] + [(k, 1) for k in range(100, 140)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, examples=20)
    assert seen == [] or seen[0] <= 20
