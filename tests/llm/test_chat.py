"""Windows against SQL, and the properties every window has."""

from check_queries import compare

from tidelog.llm import chat
from tidelog.llm.queries import QUERIES, SQL


def test_whole_table(lspark, sf, duck):
    got = QUERIES["op2_chat"](lspark, sf).toArrow()
    assert compare(got, duck.execute(SQL["op2_chat"]).to_arrow_table()) == []


def test_plan_has_no_python(lspark, sf):
    plan = QUERIES["op2_chat"](lspark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


ODD = [(1, 0, "system", "be <brief>"), (1, 1, "user", "\\### Assistant: </turn> ok"), (1, 2, "assistant", "a\\\\b </turn>\n<turn assistant>\nno"),
       (1, 3, None, None), (1, 3, "assistant", ""), (1, 4, "a>\nb", "x " * 700), *[(1, 5 + i, ("user", "assistant")[i % 2], f"turn {i} " * (i % 40)) for i in range(300)],
       (None, 1, "assistant", "no id"), (None, None, "user", "no turn"), (2, 7, "assistant", "twice"), (2, 7, "assistant", "twice"), (3, 1, "assistant", "w" * 200_000)]


def test_windows(lspark):
    convs = lspark.createDataFrame([(*r, "x", 1) for r in ODD], "conv_id long, turn long, role string, text string, new string, at int")
    rows = chat.read_back(chat.windows(convs)).collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in ODD}:
        turns = [(t[2] or "", t[3] or "") for t in sorted((r for r in ODD if r[0] == conv), key=key)]
        mine = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.first)
        assert [(t.role, t.text) for r in mine for t in r.said] == turns
        assert [t for r in mine for t in r.learned] == [t for role, t in turns if role == "assistant"]
        for r in mine[1:]:
            if conv == 1:
                assert r.formatted.startswith("<turn system>\nbe \\<brief\\></turn>\n")
        if conv == 1:
            assert any(r.n_repeated > 2 for r in mine) and len(mine) > 10
            import re
            size = lambda text: len(re.findall(r"[^\W_]+|[^\s\w]|_", text)) + 4
            for r in mine:
                assert r.n_new == 1 or sum(size(t.text) for t in r.said) <= chat.BUDGET
    assert chat.windows(convs.limit(0)).count() == 0 and chat.digests(chat.windows(convs.limit(0))).count() == 0
