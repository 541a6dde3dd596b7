from __future__ import annotations

import importlib.util
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from quillmill.queries import ORACLE_SQL, QUERIES
from tests.compare import check

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    check(QUERIES[name](spark, SF), ORACLE_SQL[name], SF)


@pytest.fixture(scope="module")
def odd_pages(spark, tmp_path_factory):
    """The tables of SF, with pages whose titles and texts end inside a character reference."""
    folder = tmp_path_factory.mktemp("odd")
    for path in Path(SF).glob("*.parquet"):
        (folder / path.name).symlink_to(path)
    (folder / "pages.parquet").unlink()
    ends = ["a &amp; b", "cut &amp", "cut &am", "&lt&gt;", "&quot", "&copy; &middot; &copy", "&amp;lt; &amp;amp", "a & b &", "&amp x &amp"]
    rows = [(k, f"https://x.org/{k}", f"<html><head><script>a && b</script></head><body><article><h1>{t}</h1><p>{t} and {t}</p></article></body></html>") for k, t in enumerate(ends * 2)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").toPandas().to_parquet(folder / "pages.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["extract_document", "fingerprint_pages", "region_text_dom"])
def test_odd_pages_equal_the_sql(spark, odd_pages, name):
    check(QUERIES[name](spark, odd_pages), ORACLE_SQL[name], odd_pages)


def with_texts(spark, folder, texts):
    """The tables of SF, with pages of these texts."""
    for path in Path(SF).glob("*.parquet"):
        if path.name != "pages.parquet":
            (folder / path.name).symlink_to(path)
    rows = [(k, f"https://x.org/{k}", f"<html><head><title>t</title></head><body><article><h1>{t}</h1><p>{t} and {t}</p></article><p>no</p></body></html>") for k, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").toPandas().to_parquet(folder / "pages.parquet")
    return str(folder)


MARKED = ["one <![ x ]> two", "one <![x[y]]> two", "one <![CDATA[y]]> two", "one <![CDATA[y>z]]> two", "<![if x]>one<![endif]> two", "one <![1]> two", "one<![-]>two"]


@pytest.mark.parametrize("name", ["extract_document", "fingerprint_pages", "region_text_dom"])
def test_pages_with_marked_sections_equal_the_sql(spark, tmp_path, name):
    check(QUERIES[name](spark, folder := with_texts(spark, tmp_path, MARKED)), ORACLE_SQL[name], folder)


PARTED = ["o<!-- c -->ne two", "one <!-- a --> <!-- b > c -->t<!-- d -->wo", "o<script>'</p>'</script>ne t<style>p{}</style><script>x</script>wo", "one<!-- c --><b>two</b>", "one</i>two<!x>three<?y?>four</ z>five", "&am<!-- c -->p; one &amp;<!-- c -->lt;"]


@pytest.mark.parametrize("name", ["extract_document", "fingerprint_pages", "region_text_dom"])
def test_pages_with_parted_texts_equal_the_sql(spark, tmp_path, name):
    check(QUERIES[name](spark, folder := with_texts(spark, tmp_path, PARTED)), ORACLE_SQL[name], folder)


def test_every_query_of_the_library_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


def test_entry_and_registry(spark):
    assert entry_points.entry(spark).count() == 50
    names = entry_points.queries()
    assert QUERIES.keys() <= names.keys()
    assert entry_points.oracle_sql().keys() <= names.keys()
    assert ("pipeline" in names) == bool(importlib.util.find_spec("quillmill.llm") and importlib.util.find_spec("corpus_pipeline"))


def test_nothing_else_imports_the_curation_subpackage():
    import ast
    from pathlib import Path

    root = Path(entry_points.__file__).parent / "quillmill"
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(".llm" in n for n in names), path
