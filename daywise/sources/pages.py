"""Stored pages of a JSON API: one document per row, each with a bounded row array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


# Code of a page that is no JSON, such as a gateway's error text, or is not there.
UNPARSABLE = "UNPARSABLE"


def page_body(service: str, row_ddl: str, body: str = "body") -> Column:
    """The page as a struct. A failed request holds `RESULT` in place of the service."""
    return F.from_json(
        body,
        f"`{service}` STRUCT<list_total_count: BIGINT, row: ARRAY<STRUCT<{row_ddl}>>>, "
        "RESULT STRUCT<CODE: STRING, MESSAGE: STRING>, _corrupt STRING",
        {"columnNameOfCorruptRecord": "_corrupt"},
    )


def _error_code() -> Column:
    """The service's code, or `UNPARSABLE`; null for a page that is sound."""
    broken = F.col("p").isNull() | F.col("p._corrupt").isNotNull()
    return F.when(broken, UNPARSABLE).otherwise(F.col("p.RESULT.CODE"))


def flatten_json_pages(
    pages: DataFrame, service: str, row_ddl: str, keep: Sequence[str] = (), body: str = "body"
) -> DataFrame:
    """One row per record, with `error_code`; a failed page stays as one row with its code."""
    parsed = pages.select(*keep, page_body(service, row_ddl, body).alias("p"))
    return parsed.select(
        *keep,
        _error_code().alias("error_code"),
        F.explode_outer(F.col(f"p.`{service}`.row")).alias("r"),
    ).select(*keep, "error_code", "r.*")


def page_completeness(
    pages: DataFrame, service: str, by: Sequence[str], body: str = "body", page: str | None = None
) -> DataFrame:
    """Per request: answers seen and failed, rows received and announced, and whether all came.

    `page` names a page's number or start: a page that came more than once counts once, by its
    fullest answer. Complete is what has exactly the rows announced: where the rows are known that a page begins with,
    `page_intervals` tells gaps and overlaps. Only array sizes are needed, so records are never exploded.
    """
    answers = _answers(pages, service, by, body, page)
    once = answers.withColumns({"_n": F.lit(1), "_failed": F.col("_code").isNotNull().cast("int")})
    if page:
        once = once.groupBy(*by, "_page").agg(
            *[F.sum(c).alias(c) for c in ("_n", "_failed")], *[F.max(c).alias(c) for c in ("_rows", "_total")]
        )
    counts = once.groupBy(*by).agg(
        F.sum("_n").alias("n_pages"),
        F.sum("_failed").alias("n_failed"),
        F.sum("_rows").alias("n_rows"),
        F.max("_total").alias("n_announced"),
    )
    complete = F.coalesce(F.col("n_rows") == F.col("n_announced"), F.lit(False))
    return counts.withColumn("status", F.when(complete, "complete").otherwise("incomplete"))


def _answers(pages: DataFrame, service: str, by: Sequence[str], body: str, page: str | None) -> DataFrame:
    """(by, _page, _rows, _code, _total) of each stored page."""
    number = [F.col(page).alias("_page")] if page else []
    parsed = pages.select(*by, *number, page_body(service, "_ignored STRING", body).alias("p"))
    rows = F.coalesce(F.array_size(F.col(f"p.`{service}`.row")), F.lit(0)).cast("bigint")
    return parsed.select(
        *by, *(["_page"] if page else []), rows.alias("_rows"), _error_code().alias("_code"),
        F.col(f"p.`{service}`.list_total_count").alias("_total"),
    )


# Row numbers of a request that are looked at together.
STRETCH = 100_000


def page_intervals(
    pages: DataFrame, service: str, by: Sequence[str], start: str, body: str = "body", stretch: int = STRETCH
) -> DataFrame:
    """Per request: rows announced, received, missing, doubled and beyond what was announced.

    `start` names the number, from 1, of the first row that a page was asked for; with its length that is the interval of
    rows it holds. A page that came more than once counts once, by its fullest answer; rows in two pages of different start are
    doubled. `complete` needs each announced row, and no other, exactly once; `doubled` has all of them, some more than once; a request
    whose total is not known, as all its pages failed, is `incomplete` and misses an unknown number (null).
    Pages without a start are left to `page_completeness`.

    Intervals are cut at every `stretch` rows and covered by a running maximum of their ends, from start to start, in each
    stretch. So a task's group holds at most `stretch` pages, however many a request has.
    """
    held = _answers(pages, service, by, body, start).filter(F.col("_page").isNotNull())
    held = held.groupBy(*by, "_page").agg(F.max("_rows").alias("_rows"), F.max("_total").alias("_total"))
    totals = held.groupBy(*by).agg(F.sum("_rows").alias("n_rows"), F.max("_total").alias("n_announced"))
    low, high = F.col("_page").cast("bigint"), F.col("_page").cast("bigint") + F.col("_rows")
    spans = held.filter("_rows > 0").select(*by, low.alias("_low"), high.alias("_high"))
    number = F.explode(F.sequence(F.floor(F.col("_low") / stretch), F.floor((F.col("_high") - 1) / stretch)))
    cut = spans.withColumn("_stretch", number).select(
        *by, "_stretch", F.greatest("_low", F.col("_stretch") * stretch).alias("_low"),
        F.least("_high", (F.col("_stretch") + 1) * stretch).alias("_high"),
    )
    before = Window.partitionBy(*by, "_stretch").orderBy("_low", "_high").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("_high").over(before), F.lit(0))
    new = cut.withColumn("_low", F.greatest("_low", reached)).filter("_high > _low")
    # Requests without a row have no span; a null in the request is a request of its own.
    key = [f"_by{i}" for i in range(len(by))]
    renamed = totals.select(*[F.col(c).alias(k) for c, k in zip(by, key)], "n_rows", "n_announced")
    same = F.lit(True)
    for column, k in zip(by, key):
        same &= F.col(column).eqNullSafe(F.col(k))
    within = F.greatest(F.lit(0), F.least("_high", F.col("n_announced") + 1) - F.greatest("_low", F.lit(1)))
    counted = new.join(renamed, same).groupBy(*key).agg(
        F.sum(F.col("_high") - F.col("_low")).alias("_distinct"), F.sum(F.when(F.col("n_announced").isNotNull(), within)).alias("_within")
    )
    told = totals.join(counted, same, "left").select(
        *by, "n_announced", "n_rows",
        (F.col("n_announced") - F.coalesce("_within", F.lit(0))).alias("n_missing"),
        (F.col("n_rows") - F.coalesce("_distinct", F.lit(0))).alias("n_doubled"),
        F.when(F.col("n_announced").isNotNull(), F.coalesce(F.col("_distinct") - F.col("_within"), F.lit(0))).alias("n_beyond"),
    )
    exact = (F.col("n_missing") == 0) & (F.col("n_beyond") == 0)
    status = F.when(exact & (F.col("n_doubled") == 0), "complete").when(exact, "doubled").otherwise("incomplete")
    return told.withColumn("status", status)
