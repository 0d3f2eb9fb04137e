"""Held-out accuracy, and that nothing but the text decides."""

import zlib

import numpy as np
import pytest

from tidelog.llm import toxicity
from tidelog.llm.queries import QUERIES

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def found(lspark):
    return {r.doc_id: r for r in QUERIES["op4_toxicity"](lspark, LARGE).collect()}


def test_held_out_rows(lspark, found):
    docs = lspark.read.parquet(f"{LARGE}/documents.parquet")
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    labels = [r for r in lspark.read.parquet(f"{LARGE}/labels.parquet").collect() if r.toxic is not None and found[r.doc_id].held_out]
    right = [found[r.doc_id].predicted == r.toxic for r in labels]
    caught = [found[r.doc_id].predicted for r in labels if r.toxic]
    # Some toxic labels are on texts of repeated filler alone; no text-based score can find those.
    assert np.mean(right) > 0.98 and np.mean(caught) > 0.9


def test_held_out_labels_are_not_read(lspark, sf):
    from pyspark.sql import functions as F
    docs, labels = lspark.read.parquet(f"{sf}/documents.parquet"), lspark.read.parquet(f"{sf}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    got = [sorted(map(tuple, toxicity.scored(d, x).collect())) for d, x in ((docs, labels), (docs.drop("lang", "source"), other))]
    assert got[0] == got[1]


def test_label_model_trusts_voters_by_accuracy():
    rng = np.random.default_rng(0)
    truth = rng.random(2000) < 0.2
    votes = np.array([np.where(truth, rng.random(2000) < 0.8, rng.random(2000) < 0.02) for _ in range(5)]
                     + [rng.random(2000) < 0.3 for _ in range(3)]).T.astype(float)
    copies = np.repeat(votes[:, -1:], 10, axis=1)  # one useless voter ten times
    human = np.where(rng.random(2000) < 0.1, ~truth, truth)
    every = np.column_stack([human, votes, copies])
    posterior = toxicity.label_model(every).posterior(every)
    assert np.mean((posterior > 0.5) == truth) > 0.97
    weights, bias = toxicity.linear(votes, posterior)
    assert weights[:5].min() > 1 > np.abs(weights[5:]).max()


def test_odd_rows(lspark):
    docs = lspark.createDataFrame([(1, None, 9), (2, "", 8), (None, "you are a moron and an idiot, scum", 7), (3, "kind words", 6), (3, "kind words", 6),
                                   (4, "word " * 50_000, 5)], "doc_id long, text string, toxic int")
    none = lspark.createDataFrame([], "doc_id long, toxic int")
    nulls = lspark.createDataFrame([(None, 1), (2, None), (1, 0), (1, 0)], "doc_id long, toxic int")
    for labels in (none, nulls):
        got = toxicity.scored(docs, labels).collect()
        assert sorted((str(r.doc_id), r.predicted) for r in got) == [("1", 0), ("2", 0), ("3", 0), ("3", 0), ("4", 0), ("None", 1)]
        kept = toxicity.keep_clean(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 5
    assert toxicity.scored(docs.limit(0), none).count() == 0
