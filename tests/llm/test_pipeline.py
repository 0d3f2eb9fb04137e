"""The pipeline against its stages done by brute force, and on odd rows."""

import importlib.util
import os

import corpus_pipeline
from test_lines import brute as line_keepers
from test_packing import check
from test_simhash import brute as simhash_groups

from tidelog.llm import toxicity


def by_hand(spark, docs, sf):
    """{doc_id: text} that the stages before packing leave of (doc_id, text) rows; only the scores are taken as given."""
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    toxic = {r.doc_id for r in toxicity.scored(frame, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    docs = [(d, t) for d, t in docs if d not in toxic]
    keepers = line_keepers(docs)
    docs = [(d, "\n".join(x for k, x in enumerate(t.split("\n")) if keepers.get((d, k), (d, k)) == (d, k))) for d, t in docs]
    _, groups = simhash_groups(docs)
    return toxic, {d: t for (d, t), g in zip(docs, groups) if d == g}


def test_whole_table(lspark, sf):
    docs = [(r.doc_id, r.text) for r in lspark.read.parquet(f"{sf}/documents.parquet").collect()]
    toxic, texts = by_hand(lspark, docs, sf)
    rows = corpus_pipeline.run(lspark, sf).collect()
    left = {r.doc_id for r in rows}
    assert toxic and not toxic & left and left == texts.keys()
    check(rows, texts)


def test_stages_keep_the_columns(lspark, sf):
    docs = lspark.read.parquet(f"{sf}/documents.parquet")
    odd = lspark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a\n" * 9_000, None, "s", 18_000)], docs.schema)
    for given in (odd, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(lspark, given, sf)
            assert out.columns == docs.columns, name
            out.collect()
        assert (corpus_pipeline.STAGES[-1][1](lspark, given, sf).count() > 0) == (given is odd)
    assert corpus_pipeline.ORACLE_SQL is None


def test_is_registered():
    path = os.path.join(os.path.dirname(corpus_pipeline.__file__), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_again", path)
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
