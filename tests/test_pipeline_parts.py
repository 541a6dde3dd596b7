from __future__ import annotations

import json
from datetime import date, datetime

import pytest
import yaml
from pyspark.sql import functions as F

from quillmill import run, schemas
from quillmill.operators import checks, landing, reconcile, transform
from quillmill.plans import planner, spec
from quillmill.sources import logs, pages, settings
from quillmill.streaming import landing as stream

SOURCE = {
    "name": "web", "display_name": "Web", "jurisdiction": "IE", "language": "en", "base_url": "https://x.org/",
    "listing": {"path": "/s/", "page_size": 10, "pagination": "declared_total", "date_format": "%-d/%-m/%Y", "params": {"date_from": "from", "date_to": "to", "page": "p", "static": {"q": "a b", "n": 1}}},
    "facet": {"param": "body", "maps_to": "issuing_authority", "values": [{"id": 2, "name": "two", "active_from": date(2024, 2, 15)}, {"id": "1", "name": "one"}]},
    "document_contract": {"content": "article", "title": "h1"},
    "listing_contract": {
        "selectors": {"result_count": "div.head", "record": "li.item", "identifier": "h2 a", "published_date": "span.date", "description": "p.text", "doc_path": "p.path", "ref": "span.ref", "next_page": "a.next"},
        "patterns": {"total": "of (\\d+) results", "no_results": "no results"}, "published_date_format": "%d/%m/%Y", "doc_path_sources": ["identifier", {"selector": "doc_path", "attributes": ["title"]}],
    },
}


@pytest.fixture
def loaded(tmp_path):
    path = tmp_path / "source.yml"
    path.write_text(yaml.safe_dump(SOURCE, sort_keys=False))
    return spec.load(path)


def broken(tmp_path, change):
    raw = json.loads(json.dumps(SOURCE, default=str))
    change(raw)
    path = tmp_path / "broken.yml"
    path.write_text(yaml.safe_dump(raw, sort_keys=False))
    return path


def test_spec(loaded, spark):
    assert loaded.search_url == "https://x.org/s/" and [f.id for f in loaded.facets] == ["2", "1"]
    assert loaded.contract.extra_fields == ("ref",) and loaded.facet("1").name == "one"
    assert [f.id for f in loaded.selected(" 1 , 9")] == ["1"]
    with pytest.raises(ValueError):
        loaded.selected("9")
    with pytest.raises(KeyError):
        loaded.facet("9")
    assert loaded.facet_table(spark).count() == 2


@pytest.mark.parametrize(("change", "said"), [
    (lambda r: r["facet"].update(maps_to="color"), "maps_to"), (lambda r: r["listing"].update(pagination="guess"), "pagination"), (lambda r: r.update(document_contract={"content": " "}), "content"),
    (lambda r: r["listing_contract"]["selectors"].pop("record"), "selectors lacks record"), (lambda r: r["listing_contract"]["selectors"].update(record=" "), "selectors has nothing for record"),
    (lambda r: r["listing_contract"]["patterns"].pop("total"), "patterns lacks total"), (lambda r: r["listing_contract"].update(doc_path_sources=[]), "doc_path_sources is missing"), (lambda r: r["listing_contract"].update(doc_path_sources=["nope"]), "no selector finds"),
])
def test_broken_specs_fail_at_load(tmp_path, change, said):
    with pytest.raises(ValueError, match=said):
        spec.load(broken(tmp_path, change))


def test_follow_next_needs_no_patterns(tmp_path):
    path = broken(tmp_path, lambda r: (r["listing"].update(pagination="follow_next"), r["listing_contract"].pop("patterns")))
    assert spec.load(path).pagination == "follow_next"
    assert planner.strategy("follow_next") is False
    with pytest.raises(ValueError):
        planner.strategy("other")


def test_listing_urls_and_plan(loaded, spark):
    from quillmill.functions import calendar as C

    parts = C.partitions(spark, date(2024, 1, 10), date(2024, 3, 5), "month")
    plan = planner.facet_partitions(parts, loaded.facet_table(spark))
    assert {(r.facet_id, r.key) for r in plan.filter("covered").collect()} == {("1", "2024-01"), ("1", "2024-02"), ("1", "2024-03"), ("2", "2024-02"), ("2", "2024-03")}
    assert tuple(planner.plan_summary(plan).first()) == (5, 1, False)
    assert planner.plan_summary(plan.filter("key = 'x'")).first().empty
    url = parts.filter("key = '2024-01'").select(planner.listing_url(loaded, F.lit("2"), F.col("start"), F.col("end"), F.lit(3))).first()[0]
    assert url == "https://x.org/s/?q=a%20b&n=1&body=2&from=10/1/2024&to=31/1/2024&p=3"
    pages_of = planner.page_plan(spark.createDataFrame([("a", 21), ("b", 0), ("c", None)], "k string, declared bigint"), 10)
    assert sorted((r.k, r.page) for r in pages_of.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1)]


LISTING = """<div class="head">Shows 1 to 2 of <b>12</b> results</div><ul>
<li class="item"><h2><a href="/d/a%20b.html"> A -  1 </a></h2><span class="date">5/4/2024</span><p class="text">first  one</p><p class="path" title="/d/a b.html"></p><span class="ref">A 1</span></li>
<li class="item"><h2><a href="x.html">B</a></h2><span class="date">soon</span><p class="text">two</p><p class="path" title="/other.html"></p><span class="ref"></span></li>
<li class="item"><h2><a></a></h2><p class="text">none</p></li></ul><a class="next" href="?p=2">next</a>"""


def test_listing_pages(loaded, spark):
    table = spark.createDataFrame([("https://x.org/s/", "1", "2024-01", 1, LISTING), ("https://x.org/s/?p=9", "1", "2024-01", 9, None)], schemas.PAGES)
    page = pages.parsed(table, loaded.contract).orderBy("page").collect()
    assert page[0].link == "?p=2" and len(page[0].records) == 3 and page[1].records == [] and page[1].count_text is None
    from quillmill.functions.text import parse_total

    total = loaded.contract.patterns["total"]
    assert spark.createDataFrame([(page[0].count_text,)], "t string").select(parse_total(F.col("t"), total, "no results")).first()[0] == 12
    a, b, c = pages.listing_rows(table, loaded.contract).orderBy("row_pos").collect()
    assert (a.identifier, a.published_date, a.doc_url, a.path_conflict, a.source_metadata, a.reason, a.flags) == ("A - 1", date(2024, 4, 5), "https://x.org/d/a%20b.html", False, {"ref": "A 1"}, None, [])
    assert (b.doc_url, b.path_conflict, b.source_metadata, b.flags) == ("https://x.org/s/x.html", True, {}, ["missing:published_date"])
    assert c.reason == "missing:identifier,doc_path"


def test_documents_join_keeps_failures(spark):
    rows = spark.createDataFrame([("u1",), ("u2",)], "doc_url string")
    bodies = spark.createDataFrame([("u1", bytearray(b"x"), "text/html")], "doc_url string, body binary, header string")
    assert {r.doc_url: r.outcome for r in pages.documents(rows, bodies).collect()} == {"u1": "downloaded", "u2": "download_failed"}

    def fetch(url):
        if url == "u2":
            raise OSError
        return b"y", "text/html"

    found = rows.mapInPandas(lambda it: pages.fetched(it, fetch), "doc_url string, body binary, header string, error string").orderBy("doc_url").collect()
    assert [f.error for f in found] == [None, "OSError"]


def test_landing_twice_stores_nothing_new(spark):
    rows = spark.createDataFrame([(1, "s", "a", "h1"), (2, "s", "a", "h1"), (3, "s", "a", "h2"), (4, "t", "a", "h1")], "n int, source string, identifier string, file_hash string")
    key, order = list(landing.CONTENT_KEY), ["n"]
    first = landing.outcomes(rows, rows.limit(0), key, order)
    assert {r.n: r.outcome for r in first.collect()} == {1: "stored", 2: "unchanged", 3: "stored", 4: "stored"}
    again = landing.outcomes(rows, first.filter("outcome = 'stored'"), key, order)
    assert {r.outcome for r in again.collect()} == {"unchanged"}
    assert landing.unseen(rows, rows.filter("n = 1"), key).count() == 2 and landing.seen(rows, rows.filter("n = 1"), key).count() == 2


def test_first_of_a_key_with_many_rows(spark):
    rows = spark.range(2000).select((F.col("id") % 7 * F.col("id") % 2).alias("k"), ((F.col("id") * 7919) % 2003).alias("n"))
    flagged = landing.with_first(rows, ["k"], ["n"], "first")
    assert flagged.count() == 2000 and flagged.filter("first").exceptAll(rows.groupBy("k").agg(F.min("n").alias("n")).withColumn("first", F.lit(True))).count() == 0
    assert sorted(map(tuple, landing.first_of(rows, ["k"], ["n"]).collect())) == sorted((r.k, r.n) for r in flagged.filter("first").collect())


def test_landing_append_and_layout(spark, tmp_path):
    rows = spark.createDataFrame([("web", "2024-01", 1), ("web", "2024-02", 2)], "source string, partition_key string, n int")
    landing.append(rows, str(tmp_path / "t"))
    landing.append(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    assert landing.layout_matches(["a"], ["a"], derived=False) and not landing.layout_matches(["a"], ["b"], derived=True)
    with pytest.raises(ValueError):
        landing.layout_matches(["a"], ["b"], derived=False)


def test_sightings_and_reuse(spark):
    rows = spark.createDataFrame([("f", "p", 1, 1, "u1", "A"), ("f", "p", 1, 2, "u2", "A"), ("f", "p", 2, 1, "u1", "A"), ("f", "q", 1, 1, "u1", "A")], "facet_id string, partition_key string, page int, row_pos int, doc_url string, identifier string")
    assert sorted((r.partition_key, r.page, r.row_pos, r.first) for r in landing.first_sightings(rows).collect()) == [("p", 1, 1, True), ("p", 1, 2, True), ("p", 2, 1, False), ("q", 1, 1, True)]
    assert sorted((r.partition_key, r.doc_url, r.reused) for r in landing.reuse_flags(rows).collect()) == [("p", "u1", False), ("p", "u2", True), ("q", "u1", False)]


def test_latest_names_and_upsert(spark):
    t = lambda d: datetime(2024, 1, d)
    rows = spark.createDataFrame([("s", "A", "u1", t(1), "h1", "A", "html"), ("s", "A", "u1", t(2), "h2", "A", "html"), ("s", "A", "u2", t(1), "h3", "A", "pdf"), ("s", "B", "u3", t(1), None, "B", "html")], "source string, identifier string, doc_url string, scraped_at timestamp, file_hash string, identifier_slug string, extension string").withColumn("partition_date", F.lit(date(2024, 1, 1)))
    latest = transform.candidates(rows, "s", [date(2024, 1, 1)])
    assert sorted((r.doc_url, r.file_hash) for r in latest.collect()) == [("u1", "h2"), ("u2", "h3")]
    names = {r.doc_url: r.file_name for r in transform.file_names(latest).collect()}
    assert names["u1"].startswith("A~") and names["u1"].endswith(".html") and names["u2"].endswith(".pdf") and names["u1"][:10] != names["u2"][:10]
    current = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, transform.upserted(current, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_overwrite_replaces_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame(list(rows), "source string, partition_key string, n int")
    transform.overwrite(make(("w", "1", 1), ("w", "2", 2)), path)
    transform.overwrite(make(("w", "2", 3)), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3]


def test_extracted_and_summary(spark):
    rows = spark.createDataFrame([("a", "html", "<article><h1>T</h1>x</article>", "en", ["f"]), ("b", "pdf", "raw", None, None), ("c", "html", "<p>y</p>", "en", None)], "k string, extension string, body string, language string, quality_flags array<string>")
    out = {r.k: r for r in transform.extracted(rows, "article", "h1").collect()}
    assert out["a"].title == "T" and out["a"].quality_flags == ["f"] and out["a"].file_size == len(out["a"].output)
    assert bytes(out["b"].output) == b"raw" and out["b"].title is None and out["c"].quality_flags == ["extraction_fallback"]
    done = spark.createDataFrame([("transformed", None, ["x"]), ("unchanged", None, ["x"]), ("failed", "OSError", None)], "outcome string, reason string, quality_flags array<string>")
    row = transform.summary(done).first()
    assert (row.candidates, row.failed, row.complete, row.failure_reasons, row.flags) == (3, 1, False, {"OSError": 1}, {"x": 1})


def test_reconciliation(spark):
    events = [("1", "p", o) for o in ["scraped"] * 3 + ["skipped"] + ["downloaded"] * 3 + ["stored"] * 2 + ["unchanged"]] + [("1", "q", "scraped")] + [("2", "p", "scraped"), ("2", "p", "download_failed")]
    outcomes = spark.createDataFrame(events, "facet_id string, partition_key string, outcome string")
    declared = spark.createDataFrame([("1", "p", 4, 1, 1), ("1", "q", None, None, 1), ("2", "p", 1, 1, 1), ("3", "p", 0, 0, 1), ("4", "p", 7, 1, 0)], schemas.DECLARED)
    report = {(r.facet_id, r.partition_key): r for r in reconcile.partitions(outcomes, declared).collect()}
    assert report["1", "p"].complete and report["1", "p"].records_unaccounted == 0
    assert report["1", "q"].records_found_source == "observed" and report["1", "q"].records_unaccounted is None and not report["1", "q"].complete
    assert not report["2", "p"].complete and report["3", "p"].complete and not report["4", "p"].complete
    total = reconcile.run_summary(reconcile.partitions(outcomes, declared), spark.createDataFrame([("missing:identifier",)], "reason string"))
    row = total.first()
    assert (row.partitions_processed, row.records_found, row.found_is_declared, row.complete, row.skip_reasons) == (5, 13, False, False, {"missing:identifier": 1})
    with pytest.raises(RuntimeError, match="incomplete"):
        reconcile.require_complete(total)
    none = reconcile.run_summary(reconcile.partitions(outcomes.limit(0), declared.limit(0)))
    assert reconcile.require_complete(none)["complete"] and none.first().found_is_declared
    with pytest.raises(RuntimeError, match="nothing"):
        reconcile.require_complete(none, planned=0)
    assert run.main(lambda: none) == 0 and run.main(lambda: total) == 1


def test_run_stops_at_an_incomplete_month(spark):
    assert run.months("2023-12", "2024-02") == [("2023-12", date(2023, 12, 1), date(2023, 12, 31)), ("2024-01", date(2024, 1, 1), date(2024, 1, 31)), ("2024-02", date(2024, 2, 1), date(2024, 2, 29))]
    seen = []

    def asset(session, first, last):
        seen.append(first)
        return session.createDataFrame([(1, first.month != 1)], "records_found int, complete boolean")

    with pytest.raises(RuntimeError):
        run.run(spark, {"landing": asset, "transformed": asset}, "2023-12", "2024-02")
    assert len(seen) == 3


def test_checks(spark):
    rows = spark.createDataFrame([("a", "a", False, "/x.html"), ("b", "b", False, None)], "identifier string, ref_no string, path_conflict boolean, doc_path string")
    assert not checks.selector_contract(rows).first().ok and checks.selector_contract(rows.limit(1)).first().ok
    pages_ = spark.createDataFrame([("first", "a"), ("deep", "b"), ("deep", "a")], "page string, identifier string")
    assert not checks.statelessness(pages_).first().ok and checks.statelessness(pages_.limit(2)).first().ok
    combined = checks.collect(checks.selector_contract(rows), checks.statelessness(pages_))
    assert "| selector_contract | FAIL | 2 |" in checks.markdown(combined)
    counts = spark.createDataFrame([(2000, "a", 5), (2001, "a", 5), (2000, "b", None)], "year int, facet string, records bigint")
    found = {r.facet: r for r in checks.bounds(counts.na.fill(0)).collect()}
    assert (found["a"].peak_year, found["a"].first_year, found["b"].first_year) == (2000, 2000, None)
    assert checks.coverage(counts).filter("level = 3").first().records == 10
    probe = spark.createDataFrame([("/en/cases/x", 301, "https://x.org/en/Cases/X"), ("/en/cases/x", 200, None)], "p string, s int, l string")
    assert sorted(r[0] for r in probe.select(checks.canonical(F.col("p"), F.col("s"), F.col("l"))).collect()) == [False, True]


def test_exports(spark, tmp_path):
    checks.write_tsv(spark.createDataFrame([(2001, "10"), (2000, "2"), (2000, "10")], "year int, body string"), ["year", "body"], str(tmp_path / "tsv"))
    (part,) = (tmp_path / "tsv").glob("part-*")
    assert part.read_text().split() == ["year", "body", "2000", "10", "2000", "2", "2001", "10"]
    events = spark.createDataFrame([("run_summary", date(2024, 1, 2), None)], "event string, day date, note string")
    logs.write_lines(events, str(tmp_path / "log"))
    (line,) = (r.value for r in spark.read.text(str(tmp_path / "log")).collect())
    assert json.loads(line) == {"event": "run_summary", "day": "2024-01-02"}
    log = spark.createDataFrame([(1, "text"), (2, "{broken"), (3, ' {"event": "other"}'), (4, '{"event": "run_summary", "n": 1}'), (5, '{"event": "run_summary", "n": 2}')], "line_no bigint, line string")
    assert [r.line_no for r in logs.find_first(log, "run_summary").collect()] == [4] and logs.find_first(log, "none").count() == 0


def test_settings(spark, tmp_path):
    assert settings.read({"QUILLMILL_MAX_RECOVERY_PAGES": "7", "HOME": "/"}).max_recovery_pages == 7
    for wrong in ({"QUILLMILL_MAX_RECOVERY_PAGES": "x"}, {"QUILLMILL_TYPO": "1"}):
        with pytest.raises(ValueError):
            settings.read(wrong)
    assert settings.probe(spark, str(tmp_path))


def test_page_source(spark):
    from quillmill.sources.connector import PageSource

    spark.dataSource.register(PageSource)
    requests = json.dumps([{"url": u, "facet_id": f, "partition_key": "p", "page": 1} for u, f in (("a", "1"), ("b", "2"), ("", "1"))])
    found = spark.read.format("listing_pages").option("requests", requests).option("transport", "tests.test_pipeline_parts:transport").load()
    assert sorted((r.url, r.html, r.error) for r in found.collect()) == [("", None, "ValueError"), ("a", "<a>", None), ("b", "<b>", None)]
    pushed = spark.read.format("listing_pages").option("requests", requests).option("transport", "tests.test_pipeline_parts:transport").option("push", "true").load()
    assert [r.url for r in pushed.filter("facet_id = '2'").collect()] == ["b"]


def transport(url: str) -> str:
    if not url:
        raise ValueError
    return f"<{url}>"


def test_streamed_landing_is_unique_across_restarts(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, n int")
    for _ in range(2):
        rows.write.mode("append").parquet(str(source))
        stream.land(stream.incoming(spark, str(source), rows.schema), table, str(tmp_path / "state"), ["key"], ["n"]).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [("a", 1), ("b", 3)]


def test_windowed_counts(spark):
    events = spark.createDataFrame([(datetime(2024, 1, 1, 0, 10), "x"), (datetime(2024, 1, 1, 0, 50), "x"), (datetime(2024, 1, 1, 1, 10), "x")], "ts timestamp_ntz, outcome string")
    assert sorted(r.n for r in stream.windowed_counts(events, "ts").collect()) == [1, 2]


def test_schemas():
    assert "content" not in schemas.persisted() and len(schemas.DOCUMENT.fields) == 27 and schemas.TRANSFORMED["title"].nullable


FOLLOWING = {
    **SOURCE, "name": "iso",
    "listing": {"path": "/d", "page_size": 3, "pagination": "follow_next", "date_format": "%Y-%m-%d", "params": {"date_from": "after", "date_to": "before", "page": "p", "static": {}}},
    "listing_contract": {"selectors": {"record": "article", "identifier": "h3 a", "published_date": "time", "description": "p", "next_page": "nav a[rel=next]"}, "published_date_format": "%Y-%m-%d", "doc_path_sources": ["identifier"]},
}


def test_a_source_that_follows_links_plans_parses_and_pages_to_the_end(spark, tmp_path):
    path = tmp_path / "iso.yml"
    path.write_text(yaml.safe_dump(FOLLOWING, sort_keys=False))
    iso = spec.load(path)
    row = spark.createDataFrame([(date(2024, 1, 5), date(2024, 1, 31))], "start date, end date")
    assert row.select(planner.listing_url(iso, F.lit("1"), F.col("start"), F.col("end"), F.lit(1))).first()[0] == "https://x.org/d?body=1&after=2024-01-05&before=2024-01-31&p=1"
    html = "<article><h3><a href='/x'>X 1</a></h3><time>2024-01-09</time><p>one</p></article><article><h3><a href='/y'>Y</a></h3><time>9/1/2024</time><p></p></article><nav><a rel='next' href='?p=2'>n</a></nav>"
    found = pages.listing_rows(spark.createDataFrame([("https://x.org/d", "1", "2024-01", 1, html)], schemas.PAGES), iso.contract).orderBy("row_pos").collect()
    assert [r.published_date for r in found] == [date(2024, 1, 9), None] and found[0].doc_url == "https://x.org/x"
    chain = spark.createDataFrame([(k, k + 1) for k in range(150)] + [(500, 501), (501, 502), (502, 501), (600, 600), (700, None)], "page int, next int")
    met = planner.walk(chain, spark.createDataFrame([(k,) for k in (0, 148, 500, 502, 600, 700)], "page int")).collect()
    by_start = {k: [r.page for r in sorted(met, key=lambda r: r.position) if r.start == str(k)] for k in (0, 148, 500, 502, 600, 700)}
    assert by_start == {0: [str(k) for k in range(151)], 148: ["148", "149", "150"], 500: ["500", "501", "502"], 502: ["502", "501"], 600: ["600"], 700: ["700"]}
    assert sorted(r.position for r in met if r.start == "0") == list(range(1, 152))


def test_requests_are_made_again_where_the_fault_may_pass():
    from quillmill.sources.retry import Patience

    class Answer(Exception):
        def __init__(self, status):
            self.status = status

    def failing(*faults):
        left = list(faults)

        def request():
            if left:
                raise left.pop(0)
            return "page"

        return request

    waits = []
    ask = lambda request, **kw: Patience(**({"delay": 0.5} | kw)).ask(request, waits.append)
    assert ask(failing(TimeoutError(), Answer(503), ConnectionError())) == "page" and waits == [0.5, 1.5, 0.5, 3.0, 0.5, 6.0, 0.5]
    for fault in (Answer(404), ValueError(), FileNotFoundError()):
        waits.clear()
        with pytest.raises(type(fault)):
            ask(failing(fault))
        assert waits == [0.5]
    with pytest.raises(Answer):
        ask(failing(*[Answer(429)] * 4))
    assert ask(failing(*[Answer(429)] * 3)) == "page"
