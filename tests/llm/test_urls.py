"""Verdicts against SQL and plain Python."""

from check_queries import compare

from tidelog.llm import bloom, urls
from tidelog.llm.queries import QUERIES, SQL, URL_RULES


def test_whole_table(lspark, sf, duck):
    got = QUERIES["op1_url_filter"](lspark, sf).toArrow()
    assert compare(got, duck.execute(SQL["op1_url_filter"]).to_arrow_table()) == []
    assert {"allow", "block"} <= set(got.column("verdict").to_pylist())


def test_odd_urls(lspark):
    rows = [(1, None), (2, ""), (3, "no host"), (4, "HTTP://WWW.Example.ORG/es/x?y#z"), (5, "http://Example.org/en/12"), (6, "http://ample.org/en/12"),
            (7, "https://notexample.org/es/"), (8, "https://x.com/fr/"), (9, "x://com/de/a#b?c"), (10, "x://com?de/"), (11, "a://b://c/d"),
            (12, "https://É.COM/De/"), (13, "x://h/p?b=2&a=1&utm_x=1"), (14, "x://www.h/p/?a=1&b=2#t"), (14, "x://www.h/p/?a=1&b=2#t"), (None, "x://h/p"),
            (15, "x://org"), (16, "://h/p\nq?r"), (17, "x://big/" + "a" * 100_000)]
    pages = lspark.createDataFrame([(i, u, "k") for i, u in rows], "page_id long, url string, key string")
    listed = lspark.createDataFrame([("y://h/p?a=1&b=2",), (None,), ("bad",), ("y://h/p?a=1&b=2",)], "url string")
    got = {(r.page_id, r.url): (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, URL_RULES, listed).collect()}
    assert [got[k] for k in rows[:12]] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("www.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"), ("ample.org", "/en/12", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"),
        ("x.com", "/fr/", "com/fr/", "allow"), ("com", "/de/a", "com/de/", "block"), ("com", "", None, "allow"), ("b:", "//c/d", None, "allow"),
        ("É.com", "/De/", None, "allow")]
    assert got[rows[12]][3] == got[rows[13]][3] == "block" and got[rows[15]][3] == "allow"
    assert got[rows[16]] == ("org", "", None, "allow") and got[rows[17]] == ("h", "/p\nq", None, "allow")
    assert urls.judge(pages, URL_RULES, listed).count() == len(rows)
    assert urls.judge(pages, {}, listed.limit(0)).where("verdict != 'allow'").count() == 0
    assert urls.judge(pages.limit(0), URL_RULES, listed).count() == 0


def test_filter_lets_all_listed_through_and_few_others(lspark):
    keys = lspark.range(4000).selectExpr("concat('host', id, '/p') AS key")
    others = lspark.range(4000, 12_000).selectExpr("concat('host', id, '/p') AS key")
    got = urls.is_listed(keys.union(others), keys)
    assert got.where("listed").count() == 4000 and got.count() == 12_000
    blocks = bloom.bloom_blocks(keys, 250)
    assert blocks.count() <= 250
