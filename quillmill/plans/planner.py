"""Planning a crawl as tables: which facet and partition to ask, which pages, what follows a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import text, urls
from quillmill.plans.spec import Spec
from quillmill.store import written

#: Strategies by name: whether pages are known from a count, or found one by one.
STRATEGIES = {"declared_total": True, "follow_next": False}

# What can be wrong with a page's continuation.
CAPPED, UNDERRUN, LOOP, NO_PROGRESS = "pagination_recovery_capped", "pagination_underrun", "pagination_loop", "pagination_no_progress"


def strategy(name: str) -> bool:
    if name not in STRATEGIES:
        raise ValueError(f"{name!r} is not one of {sorted(STRATEGIES)}")
    return STRATEGIES[name]


def facet_partitions(partitions: DataFrame, facets: DataFrame) -> DataFrame:
    """Each partition with each facet value and whether it is covered: one active by the partition's clamped end.

    The facet dimension is a broadcast of the specification's size; partitions are calendar periods.
    """
    covered = F.col("active_from").isNull() | (F.col("end") >= F.col("active_from"))
    return partitions.join(F.broadcast(facets), F.lit(True)).withColumn("covered", covered)


def plan_summary(plan: DataFrame) -> DataFrame:
    """One row: partitions planned, partitions skipped as inactive, and whether the plan is empty, which is an error."""
    counted = plan.agg(F.count_if("covered").alias("planned"), F.count_if(~F.col("covered")).alias("skipped_inactive"))
    return counted.withColumn("empty", F.col("planned") == 0)


def pages_expected(declared: Column, page_size: int) -> Column:
    return F.ceil(declared / F.lit(page_size)).cast("bigint")


def page_plan(declared: DataFrame, page_size: int) -> DataFrame:
    """A row (…, page) for each page of a declared count; an unreadable count has page 1 alone, as has an empty one."""
    pages = F.coalesce(pages_expected(F.col("declared"), page_size), F.lit(1))
    return declared.withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), F.greatest(pages, F.lit(1)))))


def listing_params(spec: Spec, facet_id: Column, start: Column, end: Column, page: Column) -> Column:
    """Query parameters (name, value) in order, dates in the source's format; a later one of a name takes the place of an earlier one."""
    first, last = (text.format_date(day, spec.date_format) for day in (start, end))
    pairs = {name: F.lit(value) for name, value in spec.static.items()} | {spec.facet_param: facet_id, spec.date_from: first, spec.date_to: last, spec.page: page.cast("string")}
    return F.array(*(F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in pairs.items()))


def listing_url(spec: Spec, facet_id: Column, start: Column, end: Column, page: Column) -> Column:
    return F.concat(F.lit(spec.search_url + "?"), urls.query_string(listing_params(spec, facet_id, start, end, page)))


def continuations(pages: DataFrame) -> DataFrame:
    """What follows each page of a decision table: next_url, depth, anomalies.

    Rows have strategy, page, pages_expected, recovery_depth, max_recovery, link (the pager's, or null), base_url,
    urls_fetched and new_records. With a declared count a link matters only at the expected end or in recovery,
    which is bounded; without one it is followed. Neither may go back to a page fetched, nor on without new records.
    """
    known = F.col("strategy") == "declared_total"
    recovering = F.col("recovery_depth") > 0
    at_end = F.col("pages_expected").isNotNull() & (F.col("page") >= F.col("pages_expected"))
    wanted = F.col("link").isNotNull() & (~known | at_end | recovering)
    capped = known & wanted & (F.col("recovery_depth") >= F.col("max_recovery"))
    follows = wanted & ~capped
    target = urls.resolve(F.col("base_url"), F.col("link"))
    loop = follows & F.array_contains(F.array_union(F.col("urls_fetched"), F.array("base_url")), target)
    stuck = follows & ~loop & (F.col("page") > 1) & (F.col("new_records") == 0)
    anomalies = F.array_compact(F.array(
        F.when(capped, F.lit(CAPPED)), F.when(known & follows & ~recovering, F.lit(UNDERRUN)),
        F.when(loop, F.lit(LOOP)), F.when(stuck, F.lit(NO_PROGRESS)),
    ))
    depth = F.when(known & follows, F.col("recovery_depth") + 1).when(capped, F.col("recovery_depth")).otherwise(0)
    return pages.select("*", F.when(follows & ~loop & ~stuck, target).alias("next_url"), depth.cast("int").alias("depth"), anomalies.alias("anomalies"))


def walk(links: DataFrame, start: DataFrame) -> DataFrame:
    """Pages (start, page, position) met by following links (page, next) from each start, until a page that was met or that has no link.

    Of a page with several links the least counts. Steps double each round, so that a chain of any length takes as many
    rounds as its length has bits; rounds end when none adds a page. Each is a table in the shared folder.
    """
    jump = written(links.filter("next is not null").groupBy(F.col("page").cast("string").alias("from")).agg(F.min(F.col("next").cast("string")).alias("to")), "jump")
    page = F.col("page").cast("string")
    met, steps = written(start.select(page.alias("start"), page.alias("page"), F.lit(1).cast("bigint").alias("position")).distinct(), "met"), 1
    pages = met.count()
    while True:
        ahead = met.join(jump, F.col("page") == F.col("from")).select("start", F.col("to").alias("page"), (F.col("position") + steps).alias("position"))
        # A page that is met again keeps its first position, so that a loop ends.
        then = written(met.unionByName(ahead).groupBy("start", "page").agg(F.min("position").alias("position")), "met")
        now = then.count()
        if now == pages:
            return then
        after = jump.select(F.col("from").alias("to"), F.col("to").alias("after"))
        jump, met, pages, steps = written(jump.join(after, "to").select("from", F.col("after").alias("to")), "jump"), then, now, 2 * steps
