"""Contract checks: small queries with a verdict each, and the coverage cube."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.text import href_extension


def verdict(name: str, table: DataFrame, ok: Column, detail: Column) -> DataFrame:
    """One row (check, ok, detail) of an aggregate; null counts as failed."""
    return table.select(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail"))


def selector_contract(rows: DataFrame) -> DataFrame:
    """Rows (identifier, ref_no, path_conflict, doc_path): all agree, none conflicts, all have a path."""
    good = (F.col("identifier") == F.col("ref_no")) & ~F.col("path_conflict") & F.col("doc_path").isNotNull()
    return verdict("selector_contract", rows.agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("ok"), F.count("*").alias("n")), F.col("ok"), F.col("n"))


def page_size(counts: DataFrame, size: int) -> DataFrame:
    """Counts (records) by attempted override: all alike and the configured size."""
    return verdict("page_size", counts.agg(F.count_distinct("records").alias("kinds"), F.max("records").alias("records")), (F.col("kinds") == 1) & (F.col("records") == size), F.col("records"))


def statelessness(pages: DataFrame) -> DataFrame:
    """Rows (page: first, deep or past_end; identifier): both pages have rows and share none, past the end is none."""
    by_row = pages.groupBy("identifier").agg(F.count_distinct(F.when(F.col("page") != "past_end", F.col("page"))).alias("on"))
    shared = by_row.agg(F.count_if(F.col("on") > 1).alias("shared"))
    counts = pages.agg(*(F.count_if(F.col("page") == p).alias(p) for p in ("first", "deep", "past_end")))
    both = counts.join(F.broadcast(shared), F.lit(True))
    return verdict("statelessness", both, (F.col("first") > 0) & (F.col("deep") > 0) & (F.col("shared") == 0) & (F.col("past_end") == 0), F.col("shared"))


def disjointness(parts: DataFrame, combined: DataFrame) -> DataFrame:
    """Counts (records) of parts sum to the combined count, which is known."""
    both = parts.agg(F.sum("records").alias("parts")).join(F.broadcast(combined.agg(F.max("records").alias("whole"))), F.lit(True))
    return verdict("disjointness", both, F.col("parts") == F.col("whole"), F.concat_ws("/", F.col("parts").cast("string"), F.col("whole").cast("string")))


def document_formats(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Rows (doc_path, …) counted by group and extension, and by extension over all, in one pass."""
    with_ext = rows.select(*groups, href_extension(F.coalesce("doc_path", F.lit(""))).alias("ext"))
    return with_ext.groupingSets([[*groups, "ext"], ["ext"]], *groups, "ext").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def formats_verdict(rows: DataFrame) -> DataFrame:
    ext = href_extension(F.coalesce("doc_path", F.lit("")))
    return verdict("document_formats", rows.agg(F.count("*").alias("n"), F.count_if(ext != "html").alias("others")), (F.col("n") > 0) & (F.col("others") == 0), F.col("others"))


def empty_states(banners: DataFrame) -> DataFrame:
    """Rows (total, expected): each banner reads as expected, null included."""
    return verdict("empty_states", banners.agg(F.bool_and(F.col("total").eqNullSafe(F.col("expected"))).alias("ok"), F.count("*").alias("n")), F.col("ok"), F.col("n"))


def stability(pairs: DataFrame) -> DataFrame:
    """Counts of pairs whose (raw, bare, region) hashes agree between two fetches: columns a_raw, b_raw and so on."""
    same = lambda n: F.count_if(F.col(f"a_{n}") == F.col(f"b_{n}")).alias(f"{n}_stable")
    return pairs.agg(F.count("*").alias("n"), same("raw"), same("bare"), same("region"))


def stability_verdict(pairs: DataFrame) -> DataFrame:
    n = F.col("n")
    return verdict("fingerprint_stability", stability(pairs), (F.col("bare_stable") == n) & (F.col("region_stable") == n) & (F.col("raw_stable") < n), F.col("raw_stable"))


def robots(rules: DataFrame, paths: DataFrame, word: str) -> DataFrame:
    """Each path with the disallow rules (line) that hold for it literally; rules are those with the word, in either case.

    Rules are a file of a host, so their array is small.
    """
    wanted = rules.filter(F.startswith(F.lower("line"), F.lit("disallow")) & F.contains(F.lower("line"), F.lit(word)))
    prefixes = wanted.agg(F.collect_list(F.trim(F.regexp_extract("line", r"^[^:]*:(.*)$", 1))).alias("prefixes"))
    return paths.join(F.broadcast(prefixes), F.lit(True)).select("path", F.exists("prefixes", lambda p: F.startswith(F.col("path"), p)).alias("disallowed"))


def canonical(path: Column, status: Column, location: Column) -> Column:
    """Whether a probe of a path's other spelling is answered by a lasting redirect to the path."""
    return status.isin(301, 308) & F.endswith(F.lower(F.coalesce(location, F.lit(""))), F.lower(path))


def coverage(counts: DataFrame) -> DataFrame:
    """Cube of counts (year, facet, records): sums by both, by each and over all; an unreadable count is 0 and told."""
    known = counts.select("year", "facet", F.coalesce("records", F.lit(0)).alias("records"), F.col("records").isNull().alias("unread"))
    return known.cube("year", "facet").agg(F.sum("records").alias("records"), F.count_if("unread").alias("unread"), F.grouping_id().alias("level"))


def bounds(counts: DataFrame) -> DataFrame:
    """Per facet: first and last year with records, their sum, the peak year (the first of equals) and its records."""
    ranked = counts.withColumn("__place", F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("records"), F.asc("year"))))
    active = F.col("records") > 0
    return ranked.groupBy("facet").agg(
        F.min(F.when(active, F.col("year"))).alias("first_year"), F.max(F.when(active, F.col("year"))).alias("last_year"), F.sum("records").alias("records"),
        F.max(F.when(F.col("__place") == 1, F.col("year"))).alias("peak_year"), F.max("records").alias("peak_records"),
    )


def peak_quarters(months: DataFrame) -> DataFrame:
    """Per facet: the greatest calendar quarter and the greatest three months in a row, of months (facet, month date, records)."""
    quarter = months.groupBy("facet", F.trunc("month", "quarter").alias("quarter")).agg(F.sum("records").alias("n")).groupBy("facet").agg(F.max("n").alias("peak_quarter"))
    ahead = Window.partitionBy("facet").orderBy(F.months_between("month", F.lit("1970-01-01").cast("date")).cast("long")).rangeBetween(-2, 0)
    three = months.withColumn("n", F.sum("records").over(ahead)).groupBy("facet").agg(F.max("n").alias("peak_three_months"))
    return quarter.join(three, "facet")


def collect(*verdicts: DataFrame) -> DataFrame:
    """All verdicts as one table."""
    return reduce(DataFrame.unionByName, verdicts)


def markdown(verdicts: DataFrame) -> str:
    """A report of the verdicts; a row a check, so it is small."""
    rows = verdicts.orderBy("check").collect()
    return "\n".join(["| check | verdict | detail |", "| --- | --- | --- |", *(f"| {r.check} | {'pass' if r.ok else 'FAIL'} | {r.detail} |" for r in rows)]) + "\n"


def tsv_lines(table: DataFrame, order: list[str]) -> DataFrame:
    """The lines of a tab-separated export, with the columns that order them; null is empty."""
    cells = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns))
    return table.select(*order, cells.alias("line"))


def write_tsv(table: DataFrame, order: list[str], path: str) -> None:
    """A tab-separated export in order."""
    table.orderBy(*order).coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)
