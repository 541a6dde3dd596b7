from __future__ import annotations

import gc
import hashlib
import re
from datetime import date
from urllib.parse import unquote, urljoin

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.functions import calendar as C
from quillmill.functions import html as H
from quillmill.functions import text as X
from quillmill.functions import urls as U
from quillmill.queries import SOURCE
from quillmill.sources import pages as P


def values(spark, column, inputs, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], f"k int, x {kind}")
    return [r.v for r in rows.select("k", column.alias("v")).orderBy("k").collect()]


def slug(text: str) -> str:
    joined = re.sub(r"[^A-Za-z0-9._-]+", "-", " ".join(text.split()))
    return re.sub("-{2,}", "-", joined).strip("-").upper()


def test_slugs(spark):
    cases = ["ADJ-00040000", "IR - SC - 00001494", "IR - SC – 00001494", "  DEC-E2010-022 ", "ud1234/2010", "(a) b__c.d", "", "---", "straße 1"]
    assert values(spark, X.slug(F.col("x")), cases) == [slug(c) for c in cases]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_normalise_and_slug_like_python(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)] or [""]
    assert values(spark, X.normalise(F.col("x")), texts) == [" ".join(t.split()) for t in texts]
    assert values(spark, X.slug(F.col("x")), texts) == [slug(t) for t in texts]


def test_normalise_knows_all_white_space(spark):
    white = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
    assert len(white) == 29
    assert values(spark, X.normalise(F.col("x")), [f"{w}a{w}{w}b{w}" for w in white]) == ["a b"] * 29
    assert values(spark, X.normalise(F.col("x")), ["​a", None]) == ["​a", ""]


def test_totals_keep_three_states(spark):
    cases = ["Shows 1 to 10 of 1572 results", "Shows 1\n to  10 of\t1921 results", "There are NO search results fitting", "of many results", "", None]
    assert values(spark, X.parse_total(F.col("x")), cases) == [1572, 1921, 0, None, None, None]


def test_dates_are_day_first(spark):
    cases = ["05/04/2024", " 5/4/2024 ", "31/02/2024", "4/5/24", "", None, "2024-01-01"]
    assert values(spark, X.parse_date(F.col("x")), cases) == [date(2024, 4, 5)] * 2 + [None] * 5


def test_media_types_and_extensions(spark):
    assert values(spark, X.media_type(F.col("x")), ["text/html; charset=utf-8", " Text/HTML ", ";", "", None]) == ["text/html", "text/html", None, None, None]
    cases = [("text/html", "/a.pdf", "html", True), ("application/pdf;x", "/a", "pdf", True), ("image/png", "https://x.org/a.DOC?b=c.txt", "doc", True), (None, "https://x.org/a", "bin", False), (None, "https://x.org/a.exe", "bin", False), ("", "https://x.org/v1.2/a", "bin", False)]
    rows = spark.createDataFrame([(k, h, u) for k, (h, u, _, _) in enumerate(cases)], "k int, h string, u string")
    found = [tuple(r.e) for r in rows.select("k", X.extension(F.col("h"), F.col("u")).alias("e")).orderBy("k").collect()]
    assert found == [c[2:] for c in cases]
    assert values(spark, X.href_extension(F.col("x")), ["/a.b.HTML", "/a"]) == ["html", "(none)"]


def test_percent_decoding(spark):
    cases = ["a%20b", "a+b", "bad%zz", "%E2%80%93"]
    assert values(spark, X.unquote(F.col("x")), cases) == [unquote(c) for c in cases]


def test_comments_are_cut_from_bytes(spark):
    bodies = [b"a<!-- x\n -->b\xff\xfe", b"<!---->", b"<!-- open", "é<!--é-->é".encode()]
    found = values(spark, X.raw_hash(X.strip_comments(F.col("x"))), [bytearray(b) for b in bodies], "binary")
    assert found == [hashlib.sha256(re.sub(rb"<!--.*?-->", b"", b, flags=re.S)).hexdigest() for b in bodies]


def test_keys_and_paths(spark):
    path = X.file_path("b", X.object_key(*(F.lit(x) for x in ("s", "1", "2024-01", "N", "h", "html"))))
    assert values(spark, path, ["-"]) == ["s3://b/s/1/2024-01/N/h.html"]
    assert values(spark, X.key_of_path(F.col("x")), ["s3://b/s/1.html"]) == ["s/1.html"]
    assert values(spark, X.escape(F.col("x")), ["<a href=\"x\">'&amp;"]) == ["&lt;a href=&quot;x&quot;&gt;&#x27;&amp;amp;"]
    assert values(spark, X.url_suffix(F.col("x")), ["u"]) == ["~" + hashlib.sha256(b"u").hexdigest()[:8]]


def test_urls_resolve_like_a_browser(spark):
    bases = ["https://x.org/en/a/b.html?q=1#f", "https://x.org", "http://x.org/d/"]
    links = ["https://y.org/z", "//cdn.org/x", "/root?a=1", "rel/x.html", "../up", "./same", "?p=2", "#top", "a/../../b/./c", ""]
    rows = spark.createDataFrame([(b, x) for b in bases for x in links], "b string, x string")
    for r in rows.select("b", "x", U.resolve(F.col("b"), F.col("x")).alias("v")).collect():
        expected = urljoin(r.b, r.x) if r.x else r.b.split("#")[0]
        assert r.v == expected, (r.b, r.x)


PAGE = "<html><body><nav>menu</nav><!-- t=1 --><article><h1>A &amp; B</h1><p>One <b>two</b>.<script>x('</p>')</script></p></article></body></html>"


def test_fingerprint_ignores_chrome_and_comments(spark):
    same = [PAGE, PAGE.replace("menu", "other"), PAGE.replace("t=1", "t=2"), PAGE.replace("One ", "One\n  "), PAGE.replace("x('", "y('")]
    prints = values(spark, H.fingerprint(F.col("x"), F.lit("html"), "article", "h1"), same)
    assert len({p.file_hash for p in prints}) == 1 and {p.basis for p in prints} == {"content_text"}
    text = "A & B One two ."
    assert prints[0].file_hash == hashlib.sha256(f"A & B\n{text}".encode()).hexdigest()
    changed, missing = values(spark, H.fingerprint(F.col("x"), F.lit("html"), "article", "h1"), [PAGE.replace("One", "Two"), PAGE.replace("article", "section")])
    assert changed.file_hash != prints[0].file_hash and missing.basis == "document_minus_comments"
    (pdf,) = values(spark, H.fingerprint(F.col("x"), F.lit("pdf"), "article"), [PAGE])
    assert tuple(pdf) == (hashlib.sha256(PAGE.encode()).hexdigest(), "raw_bytes")


def test_extraction(spark):
    whole, fallback, empty = values(spark, H.extraction(F.col("x"), "article", "h1", F.lit("en")), [PAGE, PAGE.replace("article", "section"), "<article> <script>1</script></article>"])
    assert (whole.title, whole.extracted_with, whole.quality_flags, whole.text_chars) == ("A & B", "content", [], len("A & B One two ."))
    assert b"<title>A &amp; B</title>" in whole.html and b"script" not in whole.html
    assert fallback.extracted_with == "body" and fallback.quality_flags == ["extraction_fallback"]
    assert empty.quality_flags == ["extraction_failed"] and empty.title is None


def test_dom_selectors():
    page = H.parse('<div class="a b" id="i"><ul><li x="1">one<li>two <b>three</b></ul><br>four</div><div class="b"><p>five<p>six</div>')
    pick = lambda s: [" ".join(" ".join(n.texts()).split()) for n in H.select(page, s)]
    assert pick("div.a li") == ["one", "two three"]
    assert pick("#i > ul > li[x=1]") == ["one"]
    assert pick("div.b > p, b") == ["three", "five", "six"]
    assert pick("ul > b") == []
    assert H.text_of("<p>a</p>", "h1") is None
    with pytest.raises(ValueError):
        H.select(page, "p:first-child")


def test_references_count_with_their_semicolon(spark):
    texts = {"a &amp; b": "a & b", "cut &amp": "cut &amp", "&lt&amp;lt; &copy": "&lt&lt; &copy", "&#38;&#x26; &#38 &#x26": "&& &#38 &#x26", "&eacute;&ampx; &none; & &;": "é&ampx; &none; & &;", "a & b < c &": "a & b < c &"}
    for text, expected in texts.items():
        assert H.text_of(f"<h1>{text}</h1>", "h1") == expected
    # Only what a script holds stays as it is, and the text after it is read again.
    assert list(H.parse("<script>a &amp; b</script>c &amp; d").texts(())) == ["a &amp; b", "c & d"]
    assert H.text_of("<p>open &amp", "p") == "open &amp"
    table = spark.createDataFrame([(f"<article>{t}</article>",) for t in ("x &amp;&amp", "&quot &quot;", "&lt;&gt")], "html string").select(H.region_text(F.col("html"), "article").alias("a"), H.region_text_dom("article")("html").alias("b"))
    assert [(r.a, r.b) for r in table.collect()] == [(x, x) for x in ("x &&amp", '&quot "', "<&gt")]


def test_marked_sections_end_no_page():
    for section in ("<![ x ]>", "<![x[y]]>", "<![CDATA[y]]>", "<![if !x]>", "<![1]>", "<![>"):
        assert H.text_of(f"{section}<div>a {section}<b>b</b></div>", "div") == "a b"
        assert [n.tag for n in H.select(H.parse(f"<p>a</p>{section}<ul><li>b</ul>"), "*")] == ["p", "ul", "li"]


def test_texts_are_parted_by_elements_alone():
    texts = {"a<3 and b <= c": "a<3 and b <= c", "a<!-- c -->b<!-- d --> <!-- e -->c": "ab c", "a<script>x</script><style>y</style>b": "ab", "a<b>b</b>c<br>d": "a b c d", "a<b>b<script>x</script></b>c": "a b c", "a</i>b<!x>c<?y?>d": "a b c d", "<script>x</script>a": "a"}
    for text, expected in texts.items():
        assert H.text_of(f"<h1>{text}</h1>", "h1") == expected
        page = H.parse(f"<h1>{text}</h1>")
        H._without(page, H.HIDDEN)
        assert H.visible(page, ()) == expected
    assert P._first_text(H.parse("<li>a < b<!-- c --> c</li>"), "li") == "a < b c"
    assert H.text_of("a<!-- c -->b" + "<!-- c -->b" * 200_000, "a") is None


def test_dom_equals_native_regions(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(H.region_text(F.col("html"), "article").alias("a"), H.region_text_dom("article")("html").alias("b"))
    assert pages.filter("a = b").count() == pages.count()


def bounds(day: date, size: str) -> tuple[date, date, str]:
    from datetime import timedelta

    if size == "day":
        return day, day, day.isoformat()
    if size == "week":
        start = day - timedelta(days=day.weekday())
        return start, start + timedelta(days=6), "{}-W{:02}".format(*start.isocalendar()[:2])
    months = {"month": 1, "quarter": 3, "year": 12}[size]
    first = (day.month - 1) // months * months + 1
    start = date(day.year, first, 1)
    after = date(day.year + (first + months > 12), (first + months - 1) % 12 + 1, 1)
    key = {"month": f"{start:%Y-%m}", "quarter": f"{day.year}-Q{(first + 2) // 3}", "year": str(day.year)}[size]
    return start, after - timedelta(days=1), key


@pytest.mark.parametrize("size", C.SIZES)
def test_periods_like_python(spark, size):
    days = [date.fromordinal(date(2023, 12, 20).toordinal() + k) for k in range(0, 800, 3)] + [date(2024, 2, 29), date(2024, 12, 30), date(2021, 1, 1)]
    d = F.col("x")
    found = values(spark, F.struct(C.period_start(d, size).alias("a"), C.period_end(d, size).alias("b"), C.period_key(d, size).alias("c")), days, "date")
    assert [tuple(f) for f in found] == [bounds(x, size) for x in days]


@pytest.mark.parametrize(("start", "end", "size", "keys", "truncated"), [
    (date(2024, 1, 15), date(2024, 3, 10), "month", ["2024-01", "2024-02", "2024-03"], [True, False, True]),
    (date(2024, 12, 23), date(2025, 1, 5), "week", ["2024-W52", "2025-W01"], [False, False]),
    (date(2024, 1, 1), date(2024, 12, 31), "quarter", ["2024-Q1", "2024-Q2", "2024-Q3", "2024-Q4"], [False] * 4),
    (date(2023, 5, 1), date(2025, 2, 1), "year", ["2023", "2024", "2025"], [True, False, True]),
    (date(2024, 2, 28), date(2024, 3, 1), "day", ["2024-02-28", "2024-02-29", "2024-03-01"], [False] * 3),
])
def test_partitions(spark, start, end, size, keys, truncated):
    rows = C.partitions(spark, start, end, size).orderBy("start").collect()
    assert [r.key for r in rows] == keys and [r.truncated for r in rows] == truncated
    assert rows[0].start == start and rows[-1].end == end
    assert all((b.start - a.end).days == 1 for a, b in zip(rows, rows[1:], strict=False))
    assert sum(r.days for r in rows) == (end - start).days + 1


def test_reversed_ranges_and_unknown_sizes_are_errors(spark):
    with pytest.raises(ValueError, match="precedes"):
        C.partitions(spark, date(2024, 2, 1), date(2024, 1, 1), "month")
    with pytest.raises(ValueError):
        C.period_start(F.col("x"), "decade")


def sheet(content, title="DWT241", chrome="<nav>menu</nav>", comment=""):
    return f"<html>{comment}<head><script>t()</script><style>x{{}}</style></head><body>{chrome}<div class='wide col'><h1 class='page-title'>{title}</h1><div class='content main'>{content}</div><script>v</script></div><footer>f</footer></body></html>"


def test_regions_by_class_selectors(spark):
    prints = lambda pages, title="h1.page-title": [tuple(p) for p in values(spark, H.fingerprint(F.col("x"), F.lit("html"), "div.content", title), pages)]
    same = prints([sheet("<p>Award of 500 euro</p>"), sheet("<p>Award of <b>500</b> euro</p>", chrome="<p class='content'>no</p>"), sheet("<p>Award   of\n 500 euro</p><script>x('1')</script>", comment="<!-- Elapsed time: 1 -->")])
    assert len(set(same)) == 1 and same[0][1] == "content_text"
    assert len({p[0] for p in prints([sheet("<p>x</p>"), sheet("<p>y</p>"), sheet("<p>x</p>", title="Other")])}) == 3
    assert len({p[0] for p in prints([sheet("<p>x</p>"), sheet("<p>x</p>", title="Other")], None)}) == 1
    # Nested elements are whole, and a change after them is one.
    nested = prints([sheet("<div>inner one</div> tail text"), sheet("<div>inner one</div> tail changed"), sheet("<div>inner one</div> tail text".replace("div", "section"))])
    assert nested[0] == nested[2] != nested[1]
    texts = values(spark, H.region_text_dom("div.content")("x"), [sheet("<div><div>a</div> b</div> <p>c  d</p>"), sheet("e &amp; f&nbsp;g &eacute;"), "<p>none</p>"])
    assert texts == ["a b c d", "e & f g é", None]
    lost = prints(["<html><!-- t=1 --><body><p>no</p></body></html>", "<html><body><p>no</p></body></html>"])
    assert lost[0] == lost[1] and lost[0][1] == "document_minus_comments"


def test_extraction_by_class_selectors(spark):
    made = lambda pages, lang="en": values(spark, H.extraction(F.col("x"), "div.content", "h1.page-title", F.lit(lang)), pages)
    one, table, void = made([sheet("<p>The <b>decision</b>.</p><div>more</div><script>z</script><!-- c -->"), sheet("<table><tr><td>Award</td><td a='1&quot;2'>500</td></tr></table>"), sheet("a<br>b<img src=x>")])
    text = bytes(one.html).decode()
    assert one.title == "DWT241" and one.extracted_with == "content" and one.quality_flags == [] and one.text_chars == len("The decision . more")
    assert "<h1>DWT241</h1>" in text and "<p>The <b>decision</b>.</p><div>more</div>" in text and text.startswith("<!doctype html>") and '<html lang="en">' in text
    assert not any(gone in text for gone in ("menu", "t()", "<script", "<!--", "<footer>", "<style>"))
    assert '<td a="1&quot;2">500</td>' in bytes(table.html).decode() and 'a<br>b<img src="x">' in bytes(void.html).decode()
    lost, empty, marked = made(["<html><body><nav>m</nav><p>redesigned</p></body></html>", sheet("   "), sheet("<p>x</p>", title="A &amp; B &lt;C&gt;")], "ga")
    assert lost.extracted_with == "body" and lost.quality_flags == ["extraction_fallback"] and lost.title is None and b"redesigned" in bytes(lost.html)
    assert empty.quality_flags == ["extraction_failed"] and empty.text_chars == 0
    assert marked.title == "A & B <C>" and b"<title>A &amp; B &lt;C&gt;</title>" in bytes(marked.html) and b'<html lang="ga">' in bytes(marked.html)


def test_deep_and_broken_pages_are_no_failure(spark):
    deep = "<div>" * 5000 + "<div class='content'>x<b>y</b></div>" + "</div>" * 5000
    pages = [sheet(deep), deep, "<div class='content'>" + "<i>" * 3000 + "z", "<![x <div class='content'>q</div>", None, ""]
    assert values(spark, H.region_text_dom("div.content > b, div.content")("x"), pages)[1:3] == ["x y", "z"]
    made = values(spark, H.extraction(F.col("x"), "div.content", "h1", F.lit("en")), pages)
    assert [m.text_chars for m in made[:3]] == [3, 3, 1] and made[4].quality_flags == made[5].quality_flags == ["extraction_fallback", "extraction_failed"]


def elements_alive(monkeypatch, use):
    """Elements of other pages that are alive whenever use() parses one, without the collector."""
    alive, parse = [], H.parse
    monkeypatch.setattr(H, "parse", lambda html: (alive.append(sum(isinstance(o, H.Node) for o in gc.get_objects())), parse(html))[1])
    gc.collect()
    gc.disable()
    try:
        use()
    finally:
        gc.enable()
    return alive


MANY = [sheet("<ul><li><a href='/x'>a</a></li></ul><p>b<noscript><i>c</i></noscript></p>" * 20)] * 5


def test_listing_pages_are_held_one_at_a_time(spark, monkeypatch):
    assert elements_alive(monkeypatch, lambda: [P.parse_page(x, SOURCE.contract) for x in MANY]) == [0] * 5
    assert H.text_of("<b>" * 200_000 + "x", "b") == "x"


@pytest.mark.parametrize("made", [lambda: H.regions("div.content", "h1"), lambda: H._extracted("div.content", "h1"), lambda: H.region_text_dom("div.content")], ids=["fingerprint", "extraction", "region"])
def test_pages_are_held_one_at_a_time_in_small_batches(spark, monkeypatch, made):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        spark.conf.unset(name)
        function = made().func
        assert spark.conf.get(name) == str(H.BATCH_ROWS)
    finally:
        spark.conf.unset(name)
    found = []
    assert elements_alive(monkeypatch, lambda: found.append(function(pd.Series([*MANY, None, ""])))) == [0] * 7
    assert len(found[0]) == 7


def test_listing_pages_come_in_small_batches(spark):
    most = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000", "50"), "spark.sql.execution.arrow.maxBytesPerBatch": ("64m", str(4 << 20), "1m")}
    table = spark.createDataFrame([("<p>x</p>",)], "html string")
    try:
        for given, expected in ((0, 1), (2, 2)):  # smaller ones stay
            for name, values_ in most.items():
                spark.conf.set(name, values_[given])
            P.parsed(table, SOURCE.contract)
            assert [spark.conf.get(name) for name in most] == [values_[expected] for values_ in most.values()]
    finally:
        for name in most:
            spark.conf.unset(name)


def test_listing_pages_are_parsed_once(spark):
    table = spark.createDataFrame([("https://x.org/", "<p>x</p>")], "url string, html string")
    plan = P.listing_rows(table, SOURCE.contract)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_dates_by_a_sources_format(spark):
    cases = ["2024-01-31", "2024-1-5", "31/01/2024", "2024-02-31", "", None]
    assert values(spark, X.parse_date(F.col("x"), "%Y-%m-%d"), cases) == [date(2024, 1, 31), date(2024, 1, 5), None, None, None, None]
    assert values(spark, X.parse_date(F.col("x"), "%d %B %Y"), ["5 March 2024", "05 March 2024", "5/3/2024"]) == [date(2024, 3, 5)] * 2 + [None]
    assert values(spark, X.format_date(F.to_date("x"), "%-d.%-m.%Y at %Y%m%d"), ["2024-03-05"]) == ["5.3.2024 at 20240305"]
    with pytest.raises(ValueError):
        X.format_date(F.col("x"), "%q")
