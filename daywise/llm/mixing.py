"""Mixing of sources to target weights by entropy balancing.

Each document may be taken 0 to `MOST` times. Rates that stay closest in entropy to taking everything once,
given how many words of each source are wanted, are exponentially tilted: the odds of each possible
copy are its prior odds times exp(multiplier x size). One multiplier for each source solves the
convex dual; Newton steps find it from sums over the data. Documents of one source and size have one rate,
so sums run over counts of sizes. Rates are then rounded to copies, carrying the words that
rounding leaves over from larger sizes to smaller ones.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .shared import with_rank, word_count

MOST = 3
WEIGHTS = (1, 2, 3)
TOLERANCE = 1e-7
MAX_STEPS = 60
SOURCE = ["no_source", "source"]
UNIT = ["doc_id", *SOURCE, "size"]


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Add `target` to (no_source, source, source_size): shares by weight, none above `most` times its size.

    Sources in code point order, null last, weigh `weights` in turn and share the sum of all sizes.
    What a source cannot take goes to the others by weight, until none is above its limit: the
    level at which that ends is found by going through the sources by limit per weight. There is
    one row per source, and only these rows are put in order.
    """
    place = F.row_number().over(Window.orderBy(*SOURCE))
    rows = sources.withColumn("place", place)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("limit", most * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "place")
    rows = rows.withColumns({
        "at": F.row_number().over(by_ratio),
        "full": F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    rows = rows.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))
    level = F.min(fits).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["level"]
    return rows.withColumn("target", F.least(F.col("limit").cast("double"), level * F.col("weight"))).select(
        *SOURCE, "source_size", "target"
    )


def _share(most: int) -> Column:
    """Chance of each of the possible copies; 1 / `most` without a tilt."""
    tilt = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -F.col("multiplier") * F.col("x")))
    return 1 / (1 + (most - 1) * F.exp(tilt))


def _exact(value: Column) -> Column:
    """Sums of decimals do not depend on the order of rows, so reruns take the same steps."""
    return F.sum(value.cast("decimal(38,9)")).cast("double")


def multipliers(cells: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """Solve the dual for each source: adds `multiplier`, `scale` and `taken` (expected words) to `wanted`.

    A Newton step goes no further than double the present multiplier and one, and stays between the
    values known to be too low and too high; else that interval is halved. Each step is one
    aggregate over the cells, combined before the shuffle; only whether all sources are done comes
    to the driver. Sources that need all or nothing of every document are done at once.
    """
    scale = cells.groupBy(*SOURCE).agg((F.sum(F.col("n") * F.col("unit_size")) / F.sum("n")).alias("scale"))
    state = wanted.join(scale, SOURCE).withColumns({
        "multiplier": F.lit(0.0), "low": F.lit(-1e9), "high": F.lit(1e9), "taken": F.lit(None).cast("double"),
    })
    state = materialise(state.filter((F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))), "dual")
    columns = state.columns
    far = (F.abs(F.col("taken") - F.col("target")) > TOLERANCE * F.col("target")) & (F.col("high") - F.col("low") > 1e-12)
    for _ in range(MAX_STEPS):
        used = cells.filter("unit_size > 0").join(state, SOURCE).withColumn("x", F.col("unit_size") / F.col("scale"))
        words = F.col("n") * F.col("unit_size") * most * _share(most)
        slope = words * (1 - _share(most)) * F.col("x")
        sums = used.groupBy(*SOURCE).agg(_exact(words).alias("now"), _exact(slope).alias("slope"))
        step = state.drop("taken").join(sums, SOURCE).withColumnRenamed("now", "taken")
        low = F.when(F.col("taken") < F.col("target"), F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("taken") > F.col("target"), F.col("multiplier")).otherwise(F.col("high"))
        step = step.withColumns({"low": low, "high": high})
        limit = F.abs("multiplier") + 1
        newton = F.greatest(-limit, F.least(limit, (F.col("target") - F.col("taken")) / F.greatest("slope", F.lit(1e-9))))
        moved = F.col("multiplier") + newton
        inside = (moved > F.col("low")) & (moved < F.col("high"))
        moved = F.when(inside, moved).otherwise((F.col("low") + F.col("high")) / 2)
        state = materialise(step.withColumn("multiplier", F.when(far, moved).otherwise(F.col("multiplier"))).select(columns), "dual")
        if state.filter(far).isEmpty():
            break
    return state


def _round_cells(most: int):
    """Copies for each size of one source; its rows are as many as there are sizes."""

    def round_cells(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("unit_size", ascending=False, kind="stable")
        wanted = cells["n"] * cells["unit_size"] * cells["rate"]
        left = cells["target"].iloc[0] - wanted.sum()
        copies = []
        for n, size, words in zip(cells["n"], cells["unit_size"], wanted):
            if size == 0:
                copies.append(n)
                continue
            left += words
            taken = int(min(most * n, max(0, round(left / size))))
            left -= taken * size
            copies.append(taken)
        return cells.assign(copies=copies)[[*SOURCE, "unit_size", "copies"]]

    return round_cells


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, most: int = MOST
) -> DataFrame:
    """A row for each document: doc_id, size (words), source, source_size, target, copies, taken.

    `target` is what the source should give in words; `taken` is copies x size. Rows of one doc_id,
    source and size are taken equally often and count as one of their common size. A null
    text has no words and is taken once, a null source is a source of its own, an empty table
    gives no rows. Which documents of equal size get one more copy is decided by a hash of the id,
    so a rerun gives the same. A source whose documents are few and long can miss its target by
    up to half its shortest document.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).isNull().cast("int").alias("no_source"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.col(text).alias("text"),
    ).withColumn("size", word_count("text")).drop("text")
    rows = materialise(rows, "sizes")
    units = rows.groupBy(*UNIT).agg((F.count("*") * F.first("size")).alias("unit_size"))
    units = units.withColumn("lot", F.xxhash64("doc_id", "size"))
    ranked = with_rank(units, [*SOURCE, "unit_size", "lot", "doc_id", "size"], "rank")
    cells = ranked.groupBy(*SOURCE, "unit_size").agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    cells = materialise(cells, "size-counts")
    sizes = cells.groupBy(*SOURCE).agg(F.sum(F.col("n") * F.col("unit_size")).alias("source_size"))
    wanted = materialise(targets(sizes, weights, most), "targets")
    solved = multipliers(cells, wanted, most).select(*SOURCE, "scale", "multiplier")
    rated = cells.join(wanted, SOURCE).join(solved, SOURCE, "left").withColumn("x", F.col("unit_size") / F.col("scale"))
    fixed = F.when(F.col("target") > 0, F.lit(float(most))).otherwise(F.lit(0.0))
    rated = rated.withColumn("rate", F.coalesce(most * _share(most), fixed))
    kept = rated.select(*SOURCE, "unit_size", "n", "rate", "target")
    rounded = kept.groupBy(*SOURCE).applyInPandas(_round_cells(most), "no_source int, source string, unit_size long, copies long")
    given = materialise(cells.join(rounded, [*SOURCE, "unit_size"]).join(wanted, SOURCE), "copies")
    base, more = F.expr("copies div n"), F.expr("copies % n")
    each = base + (F.col("rank") - F.col("first") < more).cast("long")
    chosen = ranked.join(given, [*SOURCE, "unit_size"]).select(*UNIT, each.alias("copies"), "source_size", "target")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) if k == "doc_id" else F.col(f"r.{k}") == F.col(f"c.{k}") for k in UNIT]
    found = rows.alias("r").join(chosen.alias("c"), same)
    return found.select(
        "r.doc_id", "r.size", F.when(F.col("r.no_source") == 0, F.col("r.source")).alias("source"),
        "source_size", "target", "copies", (F.col("copies") * F.col("r.size")).alias("taken"),
    )
