import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.llm import extract as X
from eventlake.llm.markup import ARTICLE, CHROME, PLAIN, read_blocks


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), max_size=25), st.sampled_from([1 << 28, 8]))
def test_alignment_is_a_longest_common_subsequence(a, b, bits):
    before, X.ALIGN_BITS = X.ALIGN_BITS, bits
    try:
        pairs = X.aligned(a, b)
    finally:
        X.ALIGN_BITS = before
    assert len(pairs) == brute_lcs(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def texts(html, kind):
    return [t for t, k in read_blocks(html) if k == kind]


ARTICLES = [
    ("<body><nav>menu</nav><article><h1>T</h1><p>a  b&amp;c<br>d<p>e</article><footer>f</footer>", ["T", "a b&c d", "e"]),
    ("<nav><ul><li>menu<article><p>open menu before</article>", ["open menu before"]),
    ("<article><header><h1>Title</h1><p>by line</p></header><p>x<!-- y -->z <b>bold</b>.</p><aside>side</aside><form>q</form></article>", ["Title", "xz bold."]),
    ("<div class='page has-sidebar'><main><p>text</p><div class=newsletter>join</div></main><div id=sidebar>s</div></div>", ["text"]),
    ("<div class=sidebar><article><p>framed</p></article></div>", ["framed"]),
    ("<article><p>main text of the page</p></article><section class='comments'><article><p>a very long reader comment that is longer</p></article></section>",
     ["main text of the page"]),
    ("<article><p>main text</p><div class='reader-comments'><article class=comment><p>comment</p></article></div></article>", ["main text"]),
    ("<article><p>longer text here</p></article><article><p>teaser</p></article>", ["longer text here"]),
    ("<article><p>a<script>var t='</p>';</script>b<style>p{}</style></p><p hidden>h</p><p style='display: none'>n</p><p>cut off", ["ab", "cut off"]),
    ("<article>&lt;p&gt; &#233;&nbsp;&nbsp;x &notanentity; 1 < 2</article>", ["<p> é x ¬anentity; 1 < 2"]),
    ("<article><div role=navigation>n</div><div class='cookie-notice'>c</div><div class=ad>a</div><ul><li>one<li>two</ul></article>", ["one", "two"]),
    ("<article><p>a</b></i></p>b</div>c</article>d", ["a", "bc"]),
    ("<article><p>a <button>b</button><span class=ad>x</span>c<svg><text>t</text></svg></p></article>", ["a c"]),
    ("<ARTICLE><P CLASS=lead>Upper<TABLE><TR><TD>x<TD>y</TABLE></ARTICLE>", ["Upper", "x", "y"]),
]


@pytest.mark.parametrize("html, want", ARTICLES)
def test_article_blocks(html, want):
    assert texts(html, ARTICLE) == want


def test_hostile_markup_does_not_crash():
    rnd = random.Random(3)
    parts = ["<p", ">", "</", "article>", "<article>", "<nav>", "</nav>", "<!--", "-->", "&amp;", "&#x", "<script>", "</script", "'", '"', " class=ad", "<", "t", "<br/>", "\x00"]
    for _ in range(3000):
        for text, kind in read_blocks("".join(rnd.choices(parts, k=rnd.randint(0, 25)))):
            assert text == " ".join(text.split()) and text and kind in (CHROME, PLAIN, ARTICLE)
    assert read_blocks(None) == [] == read_blocks("")
    assert len(read_blocks("<div>" * 20_000 + "x" + "</div>" * 20_000)) == 1


def plain_page(title, *lines):
    body = "".join(f"<div>{x}</div>" for x in ("Home | News", title, *lines, "All rights reserved"))
    return f"<html><head><title>{title}</title></head><body>{body}</body></html>"


PAGES = [
    (1, "http://H.net/a/1", plain_page("One", "first text", "shared quote")),
    (2, "http://h.net/a/2", plain_page("Two", "second text")),
    (3, "http://h.net/b/9", plain_page("Three", "third text", "shared quote")),
    (4, "http://h.net/a/3", plain_page("Two", "second text")),
    (5, "http://other.net/a", plain_page("Lonely", "alone")),
    (6, "http://h.net/art", "<nav>Home | News</nav><article><p>first text</p><p>own</p></article>"),
    (7, None, None), (8, "", ""), (None, "http://h.net/a/2", plain_page("Null", "null id")),
    (9, "http://big.net/x", plain_page("Big", *(f"line {i % 7000}" for i in range(9000)))),
    (10, "http://big.net/y", plain_page("Big2", *(f"line {i}" for i in range(9000)))),
    (2, "http://h.net/a/2", plain_page("Two", "second text")),
]


def brute_extract(pages):
    """The definition, host by host."""
    import os

    def key(p):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", p[1] or "")
        return ((m[1].lower(), m[2]) if m else ("", "")) + ((p[0] is not None, p[0] or 0),)

    ordered = sorted(pages, key=key)
    runs = []  # neighbours of the same lines are one page
    for page in ordered:
        mine = [t for t, _ in read_blocks(page[2])]
        if runs and runs[-1][0] == key(page)[0] and runs[-1][1] == mine:
            runs[-1][2].append(page)
        else:
            runs.append((key(page)[0], mine, [page]))
    out = []
    for i, (host, mine, members) in enumerate(runs):
        best = None
        for j, before in ((i - 1, True), (i + 1, False)):
            if 0 <= j < len(runs) and runs[j][0] == host:
                ends = (runs[j][2][-1], members[0]) if before else (members[-1], runs[j][2][0])
                prefix = len(os.path.commonprefix([key(p)[1] for p in ends]))
                pairs = X.aligned(*((runs[j][1], mine) if before else (mine, runs[j][1])))
                if best is None or (prefix, before) > best[0]:
                    best = (prefix, before), {p[1 if before else 0] for p in pairs}
        gone = best[1] if best else set()
        for page in members:
            blocks = read_blocks(page[2])
            article = [t for t, k in blocks if k == ARTICLE]
            out.append((page[0], page[1], "\n\n".join(article or [t for n, (t, k) in enumerate(blocks) if k == PLAIN and n not in gone])))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_differencing_matches_brute_force(spark, partitions):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    df = df.withColumns({c: F.lit(f"mine-{c}") for c in ("host", "path", "uid", "lines", "n_chars")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = X.extract(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(((r["page_id"], r["url"], r["text"]) for r in rows), key=str) == brute_extract(PAGES)
    assert {r["n_chars"] for r in rows} == {"mine-n_chars"}
    text = {r["page_id"]: r["text"] for r in rows}
    assert "Home" not in text[1] and "One" in text[1]
    assert text[6] == "first text\n\nown" and "Home | News" in text[5]
    assert "Home" not in text[2] + text[4] and "second text" in text[2]    # copies lose their template too


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert X.extract(df).count() == 0


def test_sibling_articles_are_differenced_and_not_dropped(spark):
    page = lambda n: (
        f"<div>Home | News</div><article><p>part one of {n}, the longest of all</p></article><article><p>part two of {n}</p></article>"
        f"<article><p>Read our weekly letter</p></article><article class=related><p>other {n}</p></article>")
    rows = [(1, "http://s.net/a/1", page("x")), (2, "http://s.net/a/2", page("y"))]
    got = {r["page_id"]: r["text"] for r in X.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"part one of {n}, the longest of all\n\npart two of {n}" for i, n in ((1, "x"), (2, "y"))}


def bare(title, *lines):
    """A page whose menu, notice, sidebar and footer have no telling element,
    class, id or role; nor has its body."""
    around = ["Home", "World", "Sport", "We use cookies to make this site work", "Most read this week"], ["About us", "Contact", "All rights reserved"]
    body = "".join(f"<div><span>{x}</span></div>" for x in (*around[0], title, *lines, *around[1]))
    return f"<html><body>{body}</body></html>"


def test_pages_without_telling_markup_are_extracted_by_differencing(spark):
    rnd = random.Random(4)
    rows, want = [], {}
    for i in range(120):
        lines = [f"Sentence {j} of page {i}: {rnd.random()}." for j in range(rnd.randint(2, 9))]
        rows.append((i, f"http://s{i % 3}.net/news/{i:04d}", bare(f"Title {i}", *lines)))
        want[i] = "\n\n".join([f"Title {i}", *lines])
    # three and more copies beside each other, and a run of them over many tasks
    rows += [(1000 + k, f"http://s0.net/news/0060-{k:03d}", rows[60][2]) for k in range(50)]
    want |= {1000 + k: want[60] for k in range(50)}
    # copies with another page between them are not one run
    rows += [(2000 + k, f"http://s1.net/x/{k:03d}", rows[61 + k % 2][2]) for k in range(40)]
    want |= {2000 + k: want[61 + k % 2] for k in range(40)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = X.extract(df).collect()
        decided = X.decisions(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["page_id"]: r["text"] for r in got} == want
    assert {tuple(r)[1:] for r in decided} == {(8, 0, 0)} and len(decided) == len(rows)


def test_what_each_rule_decides_is_counted(spark):
    page = lambda n: (f"<nav>Home</nav><article><p>text {n}</p><p>A recurring sentence.</p></article>"  # noqa: E731
                      f"<div class=comment>a reader's view of {n}</div><footer>Rights</footer>")
    rows = [(i, f"http://q.net/{i}", page(i)) for i in (1, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n_marked", F.lit("mine"))
    got = X.extract(df).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"text {i}\n\nA recurring sentence." for i in (1, 2)}
    assert {tuple(r)[1:] for r in X.decisions(df).collect()} == {(2, 1, 1)} and {r["n_marked"] for r in got} == {"mine"}


def test_deep_and_unclosed_markup_is_read_in_seconds():
    import time

    hostile = ["<b>" * 90_000 + "<p>y</p>" * 90_000, "<article>" + "<span>" * 150_000 + "x", "<article>" + "<div>" * 90_000 + "x" + "</div>" * 90_000,
               "<article><header>" + "<p>y" * 200_000, "<li>" * 200_000, "<table>" + "<tr><td>" * 90_000]
    for html in hostile:
        assert len(html) > 700_000
        began = time.process_time()
        read_blocks(html)
        assert time.process_time() - began < 8, html[:30]
