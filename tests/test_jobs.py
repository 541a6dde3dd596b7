from __future__ import annotations

from datetime import date

import pytest

from quillmill import schemas
from quillmill.operators import jobs, reconcile, records
from tests.test_pipeline_parts import loaded  # noqa: F401  a fixture

ITEM = '<li class="item"><h2><a href="{href}">{name}</a></h2><span class="date">{date}</span><p class="text">about {name}</p><p class="path" title="{href}"></p><span class="ref">{name}</span></li>'


def page(n, items):
    return f'<div class="head">Shows 1 to {len(items)} of {n} results</div><ul>' + "".join(ITEM.format(href=h, name=x, date=d) for h, x, d in items) + "</ul>"


def listing(spark, pages):
    return spark.createDataFrame(pages, schemas.PAGES)


def bodies(spark, rows):
    return spark.createDataFrame([(u, bytearray(b.encode()), h) for u, b, h in rows], "doc_url string, body binary, header string")


def html(title, text, note=""):
    return f"<html><body><nav>x</nav><!-- {note} --><article><h1>{title}</h1><p>{text}</p></article></body></html>"


@pytest.fixture
def zones(tmp_path):
    return jobs.Zones(*(str(tmp_path / n) for n in ("landing", "landing_objects", "transformed", "transformed_objects", "work")))


PAGES = [
    ("https://x.org/s/?1", "1", "2024-01", 1, page(3, [("/d/a.html", "A - 1", "5/1/2024"), ("/d/b.html", "B", "soon"), ("/d/c.pdf", "C", "7/1/2024")])),
    ("https://x.org/s/?2", "2", "2024-02", 1, page(2, [("/d/a2.html", "A2", "5/2/2024"), ("", "none", "5/2/2024")])),
]
BODIES = [("https://x.org/d/a.html", html("A", "first"), "text/html"), ("https://x.org/d/b.html", html("B", "second"), "text/html; charset=utf-8"), ("https://x.org/d/c.pdf", "%PDF", "application/pdf"), ("https://x.org/d/a2.html", html("A2", "third"), "")]


def landed(spark, zones):
    return jobs.read(spark, zones.landing, schemas.LANDING)


def test_ingest_twice_and_a_new_version(spark, loaded, zones):  # noqa: F811
    first = {r.facet_id: r for r in jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, BODIES), zones).collect()}
    assert first["1"].complete and (first["1"].records_scraped, first["1"].documents_stored, first["1"].records_degraded) == (3, 3, 1)
    assert first["2"].complete and (first["2"].records_scraped, first["2"].records_skipped, first["2"].records_found) == (1, 1, 2)
    rows = {r.identifier: r for r in landed(spark, zones).collect()}
    assert rows["A - 1"].identifier_slug == "A-1" and rows["A - 1"].object_key.startswith("web/1/2024-01/A-1/") and rows["A - 1"].file_hash_basis == "content_text"
    assert rows["B"].quality_flags == ["missing:published_date"] and rows["C"].file_hash == rows["C"].raw_sha256 and rows["A2"].extension == "html"
    assert rows["A - 1"].file_path == f"s3://landing/{rows['A - 1'].object_key}" and rows["A - 1"].issuing_authority == "one" and rows["A - 1"].partition_date == date(2024, 1, 1)

    noted = [(u, b.replace("<!--  -->", "<!-- t=2 -->"), h) for u, b, h in BODIES]
    again = {r.facet_id: r for r in jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, noted), zones).collect()}
    assert again["1"].complete and (again["1"].documents_stored, again["1"].documents_unchanged) == (0, 3) and landed(spark, zones).count() == 4
    objects = spark.read.parquet(zones.landing_objects)
    assert objects.count() == 4 == objects.select("object_key").distinct().count()

    changed = [(u, b.replace("first", "revised"), h) for u, b, h in BODIES]
    third = {r.facet_id: r for r in jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, changed), zones).collect()}
    assert (third["1"].documents_stored, third["1"].documents_unchanged) == (1, 2) and landed(spark, zones).count() == 5


def test_ingest_reports_what_is_missing(spark, loaded, zones):  # noqa: F811
    broken = [*PAGES, ("https://x.org/s/?3", "1", "2024-03", 1, "<div class='head'>of many results</div>")]
    twice = [("https://x.org/s/?4", "1", "2024-04", 1, page(3, [("/d/a.html", "A", "5/4/2024"), ("/d/a.html", "A", "5/4/2024"), ("/d/b.html", "A", "5/4/2024")]))]
    report = jobs.ingest(spark, loaded, listing(spark, broken + twice), bodies(spark, BODIES[:3]), zones)
    found = {(r.facet_id, r.partition_key): r for r in report.collect()}
    assert found["2", "2024-02"].downloads_failed == 1 and not found["2", "2024-02"].complete
    assert found["1", "2024-03"].failures == 1 and found["1", "2024-03"].records_found == 0 and not found["1", "2024-03"].complete
    april = found["1", "2024-04"]
    assert (april.records_duplicate, april.identifiers_reused, april.records_degraded, april.records_unaccounted) == (1, 1, 1, 1)
    assert not reconcile.run_summary(report).first().complete


def derive(spark, spec, zones):
    return jobs.derive(spark, spec, zones, date(2024, 1, 1), date(2024, 2, 29)).first()


def test_transform_runs(spark, loaded, zones):  # noqa: F811
    jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, BODIES), zones)
    done = derive(spark, loaded, zones)
    assert (done.candidates, done.transformed, done.passthrough, done.unchanged, done.failed, done.complete) == (4, 3, 1, 0, 0, True)
    rows = {r.identifier: r for r in spark.read.parquet(zones.transformed).collect()}
    objects = {r.file_path: bytes(r.body) for r in spark.read.parquet(zones.transformed_objects).collect()}
    assert rows["A - 1"].file_path == "s3://transformed/web/A-1.html" and rows["A - 1"].title == "A" and rows["A - 1"].text_chars == len("A first")
    assert objects["s3://transformed/web/C.pdf"] == b"%PDF" and b"<h1>A</h1>" in objects["s3://transformed/web/A-1.html"] and b"nav" not in objects["s3://transformed/web/A-1.html"]
    assert (derive(spark, loaded, zones).unchanged, len(objects)) == (4, 4)

    # A second document takes the identifier: both names get a mark, and the first one's old object goes.
    more = [("https://x.org/s/?5", "1", "2024-01", 1, page(1, [("/d/a9.html", "A - 1", "9/1/2024")]))]
    jobs.ingest(spark, loaded, listing(spark, more), bodies(spark, [("https://x.org/d/a9.html", html("A9", "ninth"), "text/html")]), zones)
    done = derive(spark, loaded, zones)
    assert (done.transformed, done.unchanged, done.flags["identifier_reused"]) == (2, 3, 2)
    paths = {r.file_path for r in spark.read.parquet(zones.transformed_objects).collect()}
    assert len(paths) == 5 and "s3://transformed/web/A-1.html" not in paths and sum("A-1~" in p for p in paths) == 2
    assert spark.read.parquet(zones.transformed).count() == 5 and derive(spark, loaded, zones).unchanged == 5


def test_a_lost_object_is_a_failure_of_its_row(spark, loaded, zones):  # noqa: F811
    jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, BODIES), zones)
    kept = spark.read.parquet(zones.landing_objects).filter("object_key not like '%/B/%'").collect()
    spark.createDataFrame(kept, schemas.LANDING_OBJECT).write.mode("overwrite").parquet(zones.landing_objects)
    done = derive(spark, loaded, zones)
    assert (done.failed, done.transformed, done.complete, done.failure_reasons) == (1, 2, False, {"NoSuchKey": 1})
    assert spark.read.parquet(zones.transformed).count() == 3


def test_widened_dates(spark):
    row = records.widened(spark.createDataFrame([(date(2024, 1, 2), 1)], "d date, n int")).first()
    assert (row.d.year, row.d.hour) == (2024, 0) and records.widened(spark.range(1)).dtypes == [("id", "bigint")]


def test_ingest_fetches_what_it_lists(spark, loaded, zones):  # noqa: F811
    known = {u: (b.encode(), h) for u, b, h in BODIES[1:]}

    def fetch(url):
        if url not in known:
            raise ValueError(url)
        return known[url]

    found = {r.facet_id: r for r in jobs.ingest(spark, loaded, listing(spark, PAGES), fetch, zones).collect()}
    assert (found["1"].documents_downloaded, found["1"].downloads_failed, found["1"].complete) == (2, 1, False) and found["2"].complete
    assert {r.identifier for r in landed(spark, zones).collect()} == {"B", "C", "A2"}


def files(spark, path):
    return {f for f in spark.read.parquet(path).inputFiles()}


def test_derive_writes_what_changed_alone(spark, loaded, zones):  # noqa: F811
    jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, BODIES), zones)
    derive(spark, loaded, zones)
    before = files(spark, zones.transformed), files(spark, zones.transformed_objects)
    assert derive(spark, loaded, zones).unchanged == 4 and (files(spark, zones.transformed), files(spark, zones.transformed_objects)) == before
    changed = [(u, b.replace("third", "revised"), h) for u, b, h in BODIES]
    jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, changed), zones)
    assert derive(spark, loaded, zones).transformed == 1
    for was, now in zip(before, (files(spark, zones.transformed), files(spark, zones.transformed_objects)), strict=True):
        assert {f for f in was if "2024-01" in f} == {f for f in now if "2024-01" in f} and {f for f in was if "2024-02" in f}.isdisjoint(now)
    assert spark.read.parquet(zones.transformed).count() == 4 == spark.read.parquet(zones.transformed_objects).count()


def test_a_run_that_ends_between_its_writes_loses_nothing(spark, loaded, zones, monkeypatch):  # noqa: F811
    jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, BODIES), zones)
    derive(spark, loaded, zones)
    more = [("https://x.org/s/?5", "1", "2024-01", 1, page(1, [("/d/a9.html", "A - 1", "9/1/2024")]))]
    jobs.ingest(spark, loaded, listing(spark, more), bodies(spark, [("https://x.org/d/a9.html", html("A9", "ninth"), "text/html")]), zones)
    replaced = jobs._replaced
    for ends_after in (1, 2):
        left = [ends_after]

        def some(*args, left=left):
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            replaced(*args)

        monkeypatch.setattr(jobs, "_replaced", some)
        with pytest.raises(KeyboardInterrupt):
            derive(spark, loaded, zones)
        monkeypatch.setattr(jobs, "_replaced", replaced)
        named = {r.file_path for r in spark.read.parquet(zones.transformed).collect()}
        assert named <= {r.file_path for r in spark.read.parquet(zones.transformed_objects).collect()} and len(named) >= 4
        if ends_after == 1:
            assert derive(spark, loaded, zones).complete and spark.read.parquet(zones.transformed).count() == 5
            jobs.ingest(spark, loaded, listing(spark, PAGES), bodies(spark, [(u, b.replace("second", "again"), h) for u, b, h in BODIES]), zones)
