"""Main text of pages: the cut against all labellings, the reader and the labels against pages with known text."""

import itertools
import random

import duckdb
import pytest

from varideck.llm import extract, queries
from varideck.llm.common import small_batches


def cost(gain, edges, content):
    return sum(-g if keep and g < 0 else g if not keep and g > 0 else 0 for g, keep in zip(gain, content, strict=True)) + sum(w for a, b, w in edges if content[a] != content[b])


@pytest.mark.parametrize("seed", range(6))
def test_cut_is_the_least_with_most_content(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        n = rnd.randint(1, 9)
        gain = [rnd.randint(-6, 6) for _ in range(n)]
        edges = [(a, b, rnd.randint(0, 4)) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.5]
        got = extract.minimum_cut(gain, edges)
        every = list(itertools.product([False, True], repeat=n))
        least = min(cost(gain, edges, x) for x in every)
        best = [x for x in every if cost(gain, edges, x) == least]
        assert cost(gain, edges, got) == least
        assert tuple(got) == max(best, key=sum)


BODY = "The river rose for three days before anyone in the valley thought of leaving it. Then the bridge went, and nobody could."
MORE = "Short."
SITE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="menu-open has-sidebar">
<header class="site-header"><h2>Daily Site</h2><p>News that is new, every single day of the week.</p></header><nav><ul><li><a href=/>Home</a><li><a href=/b>Sport</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this page better for you and everybody else who reads it.</p></div>
%s
<aside class="sidebar"><h3>Most read</h3><p>Another story that is long enough to look like one, with a full stop.</p></aside>
<section class="comments"><h2>Comments</h2><article class="comment"><p>I read this whole article and I agree with all of it, my friends.</p></article></section>
<form action=/s><label>Mail</label><input name=m><button>Sign up</button></form><footer><p>&copy; 2020 Daily Site. All rights reserved.</p></footer></body></html>"""
WHOLE = f"A title\n{BODY}\n{MORE}\none\ntwo & three\n{BODY} again"
PARTS = f"<h1>A title</h1><p>{BODY}</p><p>{MORE}</p><div class=ad><p>Buy this thing now, it is the best thing.</p></div><ul><li>one<li>two &amp; three</ul><p>{BODY}<br>again"


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main><article class='post has-comments'>{}</article></main>", "<main>{}</main>", "<div role=main class=content>{}</div>", "<div class='wrap menu-open'><div class=content><article>{}</article></div></div>", "<article><header>{}</article>"])
def test_article_without_its_surroundings(frame):
    parts = PARTS.replace("</h1>", "</h1><p>By someone</p></header>") if "<header>" in frame else PARTS
    assert extract.main_text(SITE % frame.format(parts)) == WHOLE


def test_page_without_article_is_cut_by_words():
    inner = f"<div class=story><h1>A long title about the river</h1><p>{BODY}</p><p>{MORE}</p><p>{BODY}</p></div>"
    assert extract.main_text(SITE % inner) == f"A long title about the river\n{BODY}\n{MORE}\n{BODY}"
    plain = f"<div><a href=1>Home</a> <a href=2>News</a></div><div><a href=3>Log in</a></div><div><p>{BODY}</p><p>{MORE}</p><p>{BODY}</p></div><div><a href=4>Terms of use</a> | <a href=5>Contact</a></div>"
    assert extract.main_text(plain) == f"{BODY}\n{MORE}\n{BODY}"
    assert extract.main_text(f"<div class='page with-sidebar'>{plain}</div>") == f"{BODY}\n{MORE}\n{BODY}"


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<article></article>", ""), ("<article>a<!-- b", "a"), ("<article>a<!-->b<!--->c", "abc"), ("<article>x<script>var t='</p>';</script>y<script>z", "xy"),
    ("<article><p>a &lt; b &amp;amp; c &#8364; &#x41; &nosuch; &am</p>", "a < b &amp; c € A &nosuch; &am"), ("<article>1 < 2 </> 3 <? x ?> 4", "1 < 2 3 4"), ('<article><a title="a > b">link</a> tail', "link tail"),
    ('<article><p title="open>in</p>out', "in\nout"), ("<ARTICLE><P>Up<BR/>per</P></ARTICLE>", "Up per"), ("<article>a<b>b</b>c <i> d</i>\n\n e</article>", "abc d e"), ("<article><p>a<p", "a"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<article><ul><li>a<div>b<li>c<ul><li>d</ul>e</ul><dl><dt>f<dd>g<dt>h", "a\nb\nc\nd\ne\nf\ng\nh"), ("<article><p>é ü&nbsp;x</p>", "é ü x"), ("<head><title>no</title><meta x><article>yes", "yes"), ("<article><style>s</style><noscript>n</noscript><template>t</template><p hidden>h</p>k", "k"),
])
def test_reader(page, text):
    assert extract.main_text(page) == text


def test_long_and_deep_pages_take_time_in_proportion():
    assert extract.main_text("<article>" + "<div>" * 50_000 + "deep" + "</div>" * 50_000) == "deep"
    assert extract.main_text("<article>" + "<div>" * 30_000 + "<li>x</li>" * 30_000) == "\n".join(["x"] * 30_000)
    for odd in ("<" * 200_000, "<a " * 100_000, "<a x=\"" * 50_001, "<!--" * 100_000, "</" * 100_000, "&" * 200_000):
        assert isinstance(extract.main_text("<article>" + odd), str)
    many = "<article>" + "<p>word.</p>" * 30_000
    assert extract.main_text(many) == "\n".join(["word."] * 30_000)
    mixed = "".join(f"<div><p>{BODY}</p></div><div><a href={i}>x</a></div>" for i in range(3000))
    assert BODY in extract.main_text(mixed)


def test_query_equals_sql_on_the_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    found = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in queries.op13_html(spark, sf).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    names = [d[0] for d in con.execute(queries.OP13_SQL).description]
    assert names == ["page_id", "url", "text", "n_chars"]
    assert found == {r[0]: r[1:] for r in con.fetchall()}


def test_nulls_repeats_and_clashing_columns(spark):
    small_batches(spark)
    rows = [(1, "u", SITE % "<article>x.</article>", "t"), (1, "u", SITE % "<article>x.</article>", "t"), (None, None, None, None), (2, None, "", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(map(tuple, extract.extract(pages, extract.fit(pages)).collect()), key=repr)
    assert found == sorted([(1, "u", "x.", 2), (1, "u", "x.", 2), (None, None, "", 0), (2, None, "", 0)], key=repr)
    assert extract.extract(pages.limit(0), extract.fit(pages.limit(0))).collect() == []
