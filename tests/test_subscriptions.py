"""Prefix and pattern tables against a check of every topic with every entry."""

import fnmatch
import random
import re

from tidelog.operators.subscriptions import matched_topics, selected, subscribed


def events(spark):
    rng = random.Random(3)
    topics = ["".join(rng.choices("ab.%_\\", k=rng.randint(0, 7))) for _ in range(120)] + [None]
    return topics, spark.createDataFrame(list(enumerate(topics)), "n INT, topic STRING")


def glob(pattern, topic):
    return re.fullmatch("".join({"*": "(?s:.*)", "?": "(?s:.)"}.get(c, re.escape(c)) for c in pattern), topic) is not None


def test_prefixes(spark):
    topics, ev = events(spark)
    rng = random.Random(4)
    wanted = [(f"s{k % 40}", "".join(rng.choices("ab.%_", k=rng.randint(0 if k == 7 else 1, 4)))) for k in range(150)] + [("null", None), ("all", "")]
    got = subscribed(ev, spark.createDataFrame(wanted, "subscriber STRING, prefix STRING"))
    want = {(n, t, s) for n, t in enumerate(topics) if t is not None for s, p in wanted if p is not None and t.startswith(p)}
    rows = [(r.n, r.topic, r.subscriber) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert subscribed(ev, spark.createDataFrame([], "subscriber STRING, prefix STRING")).count() == 0


def test_patterns(spark):
    topics, ev = events(spark)
    rng = random.Random(5)
    patterns = [("".join(rng.choices("ab.%_\\*?", k=rng.randint(1, 5))), k % 4 > 0) for k in range(60)] + [(None, True)]
    frame = spark.createDataFrame(patterns, "glob STRING, include BOOLEAN")
    pairs = {(r.topic, r.glob) for r in matched_topics(ev, frame).collect()}
    assert pairs == {(t, g) for t in topics if t is not None for g, _ in patterns if g is not None and glob(g, t)}
    got = {r.n for r in selected(ev, frame).collect()}
    want = {n for n, t in enumerate(topics) if t is not None and any(i and g and glob(g, t) for g, i in patterns) and not any(not i and glob(g, t) for g, i in patterns)}
    assert got == want and want
    only_out = frame.where("NOT include")
    assert {r.n for r in selected(ev, only_out).collect()} == {
        n for n, t in enumerate(topics) if t is None or not any(not i and glob(g, t) for g, i in patterns)}
    assert selected(ev, frame.limit(0)).count() == len(topics)
    assert fnmatch.fnmatchcase("ab", "a?") == glob("a?", "ab")
