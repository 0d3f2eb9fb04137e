"""Main text of pages against the generator's template, broken markup, and importance on hosts."""

import html as html_lib
import math
import random
import re

import pytest

from tidelog.llm import sitetree
from tidelog.llm.queries import QUERIES
from tidelog.llm.sitetree import main_text


def text_of(html, low=()):
    return main_text(html, "h", set(low))


def plain(markup):
    """Text of simple markup whose blocks are h1, p and div."""
    blocks = re.split(r"</?(?:h1|p|div)\b[^>]*>", markup)
    return " ".join(" ".join(html_lib.unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks if b.strip())


def test_whole_table(lspark, sf):
    pages = lspark.read.parquet(f"{sf}/pages.parquet").collect()
    got = sorted(map(tuple, QUERIES["op12_html_extraction"](lspark, sf).collect()))
    want = []
    for r in pages:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)
        text = " ".join(plain(article[1]).split())
        want.append((r.page_id, r.url, text, len(text)))
    assert got == sorted(want)


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("a < b and c > d", "a < b and c > d"),
    ("<p>one<p>two<br>three\n\t four", "one two three four"), ("<p>&amp;lt;&#8364;&eacute;&nbsp;x&#x41;</p>", "&lt;€é xA"),
    ("<p>a<b>b</b>c <i>d", "abc d"), ("<ul><li>x<li>y</ul>z", "x y z"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("<script>if (a < b) '</p>'</script><p>t</p><style>p{}</style>", "t"), ("<SCRIPT>x</SCRIPT >y", "y"), ("<script>never closed <p>x", ""),
    ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", "yes"), ("<!-->x-->", "x-->"), ("<p title='a > b'>q</p>", "q"), ('<p title="open>q</p>', "q"),
    ("<head><title>t</title><p>body text", "body text"), ("<textarea><p>x</p></textarea>y", "y"), ("<p>x</div></span></p></p>y", "x y"),
    ("<b><p>x</b> y</p>", "x y"), ("<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p>yes", "yes"),
    ("<nav>n</nav><header><h1>Site</h1></header><main><h1>T</h1><p>x</p></main><aside>a</aside><footer>f</footer>", "T x"),
    ("<p>before</p><article><header><h1>T</h1></header><p>x</p><footer>f</footer><form>q <input></form></article><p>after</p>", "T x"),
    ("<article><h1 class='article-header'>T</h1><div class='social-share'>s</div><p>x <span class='ad'>buy</span>y</p></article>", "T x y"),
    ("<article><p>x</p></article><section id='comments'><article class=comment><p>hm</p></article><article><p>hm</p></article></section>", "x"),
    ("<form id='aspnetForm'><div class='page has-sidebar'><article><p>x</p></article><div class=sidebar>s</div></div></form>", "x"),
    ("<div id='content'><p>long text of the page</p></div><div class='cookieBanner'>c</div>", "long text of the page"),
    ("<div><a href=1>a</a></div><div><p>the text</p></div><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>", "a the text"),
    ("<div class='with-sidebar'><div class='entry'>text</div></div>", "text"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<span>" * 3000 + "deep", "deep"),
])
def test_markup(html, text):
    assert text_of(html) == text
    assert text_of(html.replace("<p>", "<P >")) == text


def obfuscated(rng, k, host_notice, body):
    """A page of a site that names nothing: a notice, a text, a closing line."""
    paragraphs = "".join(f"<div>{' '.join(rng.choices(WORDS, k=20))}</div>" for _ in range(rng.randint(1, 4)))
    return f"<body><div class=q1>{host_notice}</div><div class=q2>{body or paragraphs}</div><div class=q3><div>Made in {1990 + k}</div><div>all the same</div></div></body>", paragraphs


WORDS = [a + b for a in "bcdfgh" for b in ("ala", "ebe", "ino", "oru", "umi")]


def site(host, n, seed, copies=0):
    rng = random.Random(seed)
    rows, want = [], []
    for k in range(n):
        html, body = obfuscated(rng, k, "We keep crumbs of your visit. More about it.", None)
        for _ in range(1 + copies * (k == 0)):
            rows.append((len(rows), f"http://{host}/{len(rows)}", html))
            want.append(plain(body))
    return rows, want


def test_repeated_branches_of_a_host_go(lspark):
    rows, want = site("many.example.org", 12, 1, copies=30)
    few, _ = site("few.example.org", 3, 2)
    docs = lspark.createDataFrame(rows + few, "page_id long, url string, html string").repartition(4)
    got = {r.url: r.text for r in sitetree.extract(docs).collect()}
    assert [got[u] for _, u, _ in rows] == want
    assert all("crumbs" in got[u] for _, u, _ in few)


def test_copies_and_near_copies_keep_their_text(lspark):
    rng = random.Random(5)
    paragraphs = [" ".join(rng.choices(WORDS, k=30)) for _ in range(9)]
    copies = [(k, f"http://copies.example.org/{k}", "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"</article><footer>{k}</footer>") for k in range(20)]
    near = [(100 + k, f"http://near.example.org/{k}", "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"<p>{rng.random()}</p></article>") for k in range(20)]
    docs = lspark.createDataFrame(copies + near, "page_id long, url string, html string")
    assert all(" ".join(paragraphs) in r.text for r in sitetree.extract(docs).collect())


def test_importance_by_its_formulas(lspark):
    """A tree of two levels: importances computed by hand."""
    from tidelog.llm.common import Scratch
    root, style, a, b, other = 1, 2, 3, 4, 5
    marks = []
    for page in range(8):
        marks += [(page, page, 0, root, 0, 0, root), (page, page, 1, root, 0, 0, style if page < 4 else other)]
        if page < 4:
            marks += [(page, page, 0, a, style, 1, a), (page, page, 0, b, style, 1, b), (page, page, 2, a, 0, 0, 10), (page, page, 2, b, 0, 0, 20 + page)]
    frame = lspark.createDataFrame(marks, sitetree.MARKS)
    scratch = Scratch(lspark, "test-importance")
    low = {r.key for r in sitetree._importance(scratch, frame).collect()}
    assert low == {a, 10}
    levels = {r.node: r.importance for k in (0, 1) for r in lspark.read.parquet(f"{scratch.folder}/level-{k}").collect()}
    own = math.log(2) / math.log(8)
    assert levels[a] == pytest.approx(0) and levels[b] == pytest.approx(1)
    assert levels[root] == pytest.approx((1 - .81) * own + .81 * .5)


def test_odd_rows(lspark):
    rows = [(1, None, None, "x"), (2, "no host", "<p>a</p>", "x"), (2, "no host", "<p>a</p>", "x"), (None, "http://h/1", "<p>b</p>", "x"), (3, "http://h/2", "", "x"),
            (4, "http://h/3", "<p>" + "word " * 200_000, "x"), (5, "http://h/4", "<nav>only</nav>", "x")]
    docs = lspark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sitetree.extract(docs)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    assert sorted((r.page_id or 0, r.text[:9], r.n_chars) for r in got) == [
        (0, "b", 1), (1, "", 0), (2, "a", 1), (2, "a", 1), (3, "", 0), (4, "word word", 999_999), (5, "", 0)]
    assert sitetree.extract(docs.limit(0)).count() == 0
