"""Grouped averages and distributions over daily rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise


def exact_mean(column: str) -> Column:
    """Mean from a decimal sum of six places; null for no values."""
    total = F.sum(F.col(column).cast("decimal(38,6)")).cast("double")
    return F.try_divide(total, F.count(column))


def avg_by_category(
    df: DataFrame, category: str | Sequence[str], means: Mapping[str, str], decimals: int = 0
) -> DataFrame:
    """Rounded mean per category; `means` maps a column to the name of its mean.

    Sums are decimal, so the result does not depend on the order in which tasks are merged.
    """
    keys = [category] if isinstance(category, str) else list(category)
    return df.groupBy(*keys).agg(
        *[F.round(exact_mean(column), decimals).alias(name) for column, name in means.items()]
    )


# Ranges that the values of a group are counted in at once.
RANGES = 1 << 16


def moment_sums(column: str, places: int = 6) -> list[Column]:
    """Aggregates `_n`, `_s1`, `_s2`: count, sum and sum of squares of the values in units of `places` decimals.

    They are whole numbers, so no order of merging changes them; values are rounded to the unit. The sum of squares holds up to
    38 digits (at six places: n values of size x with n * x * x below 1e26), beyond which the job fails.
    """
    units = (F.col(column).cast(f"decimal(26,{places})") * F.lit(Decimal(10**places))).cast("decimal(19,0)")
    return [F.count(column).alias("_n"), F.sum(units).alias("_s1"), F.sum(units * units).alias("_s2")]


def moment_mean(places: int = 6) -> Column:
    """The mean that follows from `moment_sums`; null for no values."""
    return F.try_divide(F.col("_s1").cast("double") / 10**places, F.col("_n"))


def moment_sd(places: int = 6) -> Column:
    """The deviation of the sample; null for one value.

    Squares are taken from the whole number next to the mean, exactly, so large means cost no digits.
    """
    middle = F.expr("cast(_s1 div _n as decimal(19,0))")
    rest = F.col("_s1") - middle * F.col("_n")
    squares = F.col("_s2") - middle * (F.col("_s1") + rest)
    spread = squares.cast("double") - F.pow(rest.cast("double"), F.lit(2)) / F.col("_n")
    return F.when(F.col("_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("_n") - 1)) / 10**places)


def _gap(high: Column, low: Column, whole: bool) -> Column:
    """How far apart two values are: never 0 for different ones, and larger or equal for a larger `high`."""
    if whole:
        high, low = high.cast("decimal(20,0)"), low.cast("decimal(20,0)")
    return (high - low).cast("double")


def exact_quantiles(counts: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], ranges: int = RANGES) -> DataFrame:
    """(by, n, q): exact quantiles of each group, interpolated, as an array in the order of `shares`.

    `counts` has a row for each value of a group, with `_count`; nulls neither in groups nor in values. The values around a
    quantile are found by rank: those of a group are counted in ranges of equal width, then those of the one range that holds
    the rank in narrower ones, until it holds one value. So a group is spread over tasks at all times, and what comes together
    are its `ranges` counts. Two rounds suffice unless values lie on very different scales.
    """
    whole = counts.schema[value].dataType.typeName() not in ("double", "float", "decimal")
    by = list(by)
    base = counts.groupBy(*by).agg(F.sum("_count").alias("n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    at = [F.lit(float(share)) * (F.col("n") - 1) for share in shares]
    ranks = F.array_distinct(F.array(*[f(a).cast("bigint") for a in at for f in (F.floor, F.ceil)]))
    probes = base.select(*by, "n", F.explode(ranks).alias("_rank"), "_lo", "_hi", F.lit(0).cast("bigint").alias("_before"))

    def narrowed(probes: DataFrame) -> DataFrame:
        wide = probes.filter("_lo < _hi")
        inside = counts.join(wide.select(*by, "_lo", "_hi").distinct(), by).filter(F.col(value).between(F.col("_lo"), F.col("_hi")))
        share = _gap(F.col(value), F.col("_lo"), whole) / _gap(F.col("_hi"), F.col("_lo"), whole)
        part = F.least(F.floor(share * ranges).cast("int"), F.lit(ranges - 1))
        counted = inside.groupBy(*by, "_lo", "_hi", part.alias("_part")).agg(
            F.sum("_count").alias("_rows"), F.min(value).alias("_least"), F.max(value).alias("_most")
        )
        order = Window.partitionBy(*by, "_lo", "_hi").orderBy("_part")
        counted = counted.withColumn("_upto", F.sum("_rows").over(order))
        rank = F.col("_rank") - F.col("_before")
        found = wide.join(counted, [*by, "_lo", "_hi"]).filter((rank >= F.col("_upto") - F.col("_rows")) & (rank < F.col("_upto")))
        closer = found.select(
            *by, "n", "_rank", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
            (F.col("_before") + F.col("_upto") - F.col("_rows")).alias("_before"),
        )
        return materialise(probes.filter("_lo = _hi").unionByName(closer), "probes")

    probes = narrowed(probes)
    while not probes.filter("_lo < _hi").isEmpty():
        probes = narrowed(probes)
    values = F.map_from_entries(F.collect_list(F.struct("_rank", F.col("_lo").cast("double"))))
    known = probes.groupBy(*by, "n").agg(values.alias("_at"))

    def between(a: Column) -> Column:
        low, high = F.floor(a).cast("bigint"), F.ceil(a).cast("bigint")
        below, above = F.col("_at")[low], F.col("_at")[high]
        return F.when(low == high, below).when(below == above, below).otherwise((high - a) * below + (a - low) * above)

    return known.select(*by, "n", F.array(*[between(a) for a in at]).alias("q"))


def box_stats(df: DataFrame, by: Sequence[str], value: str, reach: float = 1.5) -> DataFrame:
    """What a box plot of `value` draws per group: quartiles, whiskers, outlier count.

    Whiskers are the extreme values within `reach` interquartile ranges of the box. Quartiles
    are exact. The input is scanned once: its values are counted first, and only the counts are looked at further, so groups may be of any size. Rows with a
    null in `by` belong to no box, and nulls and NaN are no values; a group without a value has no box.
    """
    by = list(by)
    number = F.nanvl(F.col(value), F.lit(None)) if df.schema[value].dataType.typeName() in ("double", "float") else F.col(value)
    counts = df.select(*by, number.alias(value)).dropna().groupBy(*by, value).agg(F.count("*").alias("_count"))
    counts = materialise(counts, "value-counts")
    boxes = exact_quantiles(counts, by, value, (0.25, 0.5, 0.75))
    q1, q3 = F.col("q")[0], F.col("q")[2]
    edge = F.lit(reach) * (q3 - q1)
    inside = F.col(value).between(q1 - edge, q3 + edge)
    return (
        counts.join(boxes, by)
        .groupBy(*by)
        .agg(
            F.sum("_count").alias("n"),
            F.first(q1).alias("q1"),
            F.first(F.col("q")[1]).alias("median"),
            F.first(q3).alias("q3"),
            F.min(F.when(inside, F.col(value))).alias("whisker_lo"),
            F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
            F.coalesce(F.sum(F.when(~inside, F.col("_count"))), F.lit(0)).alias("n_outliers"),
        )
    )


def mean_ci(
    df: DataFrame, by: Sequence[str], value: str, z: float = 1.96, decimals: int = 2
) -> DataFrame:
    """Mean with normal-approximation bounds (95 % by default); no bounds for a single row.

    Mean and deviation come from whole numbers, so they do not depend on the order in which tasks are merged.
    """
    half = F.lit(z) * F.col("_sd") / F.sqrt(F.col("_n").cast("double"))
    return (
        df.groupBy(*by)
        .agg(*moment_sums(value))
        .withColumns({"_mean": moment_mean(), "_sd": moment_sd()})
        .select(
            *by,
            F.col("_n").alias("n"),
            F.round("_mean", decimals).alias("mean"),
            F.round("_sd", decimals).alias("sd"),
            F.round(F.col("_mean") - half, decimals).alias("lo"),
            F.round(F.col("_mean") + half, decimals).alias("hi"),
        )
    )
