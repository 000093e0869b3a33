"""The monthly run: raw files of a month to the stored daily table and the CSV export."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Literal
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ..functions import fixed_values as fv
from ..operators import normalise_dust, normalise_usage, normalise_weather, union_by_name
from ..session import materialise
from ..sinks import replace_months, write_csv
from ..sources import file_profile, read_csv, read_month_table
from ..sources.charset import UNDECODABLE, WIDE
from .daily_condition import DAILY_SCHEMA, Rules, daily_condition_table, merge_inputs, published_names


class UnknownLayout(ValueError):
    """A file in no charset or with no column that says what it is; nothing is replaced."""


def _layouts(
    profiles: Iterable[Row], day: Sequence[str], charset: str | None
) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """Files by charset and column names; one that fits no charset, or has none of the `day` columns, fails the run."""
    layouts: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for row in profiles:
        status = charset or row.status
        path = unquote(row.file)
        if row.status == UNDECODABLE:
            raise UnknownLayout(f"{path} is in none of the known charsets")
        raw = bytes(row.header)
        # The first line ends at the byte of the line feed, which is the second of two in big-endian files.
        text = raw[: len(raw) - len(raw) % 2].decode(status) if status in WIDE else raw.decode(status)
        header = next(csv.reader([text.strip("\ufeff\r\n")]), [])
        if not set(day) & set(header):
            raise UnknownLayout(f"{path} has none of the columns {list(day)}, but {header}")
        layouts.setdefault((status, tuple(header)), []).append(path)
    return layouts


def read_aligned(
    spark: SparkSession, profiles: Iterable[Row], day: Sequence[str], charset: str | None = None
) -> list[DataFrame]:
    """Files of a month or year, one frame for each charset and layout: columns go by the names in each header.

    `profiles` are rows of `sources.file_profile`. A `charset` that is given holds for all.
    """
    return [
        read_csv(spark, files, T.StructType([T.StructField(c, T.StringType()) for c in header]), charset=status)
        for (status, header), files in sorted(_layouts(profiles, day, charset).items())
    ]


def read_inputs(
    spark: SparkSession,
    raw: str,
    month: str,
    charsets: Mapping[str, str] | None = None,
    with_dust: bool = True,
    weather: str | None = None,
) -> dict[str, DataFrame]:
    """The inputs by name, cleaned to day, station and measures.

    `month` fills the file names and may be a pattern: `2025??` stacks the monthly files of a year.
    `weather` fills that of the weather file, if it is another. Bus files of either layout are
    aligned by column name. One job tells the charset and the header line of all files, as an aggregate over their lines; `charsets`
    sets that of an input for all its files. Files without a line are passed over.
    """
    charsets = charsets or {}
    names = ["bus", "subway", "weather", *(["dust"] if with_dust else [])]
    months = {name: weather if weather and name == "weather" else month for name in names}
    paths = [f"{raw}/{fv.INPUT_FILES[name].format(month=part)}" for name, part in months.items()]
    fallbacks = list(dict.fromkeys([*charsets.values(), *(c for c in fv.INPUT_CHARSETS.values() if c != "utf-8")]))
    profiles = file_profile(spark, paths, fallbacks).collect()

    def frames(name: str, day: Sequence[str]) -> list[DataFrame]:
        before, after = map(re.escape, fv.INPUT_FILES[name].split("{month}"))
        mine = [row for row in profiles if re.search(f"/{before}[0-9]+{after}(/|$)", unquote(row.file))]
        found = read_aligned(spark, mine, day, charsets.get(name))
        if not found:
            raise UnknownLayout(f"no file with a line for {name} of {months[name]} below {raw}")
        return found

    def usage(name: str, columns: Mapping[str, object], lenient: bool = False) -> DataFrame:
        return union_by_name([normalise_usage(frame, columns, lenient) for frame in frames(name, columns["day"])])

    def stacked(name: str) -> DataFrame:
        return union_by_name(frames(name, ["TM"]))

    inputs = {
        "usage_a": usage("bus", fv.BUS_COLUMNS),
        "usage_b": usage("subway", fv.SUBWAY_COLUMNS, lenient=True),
        "weather": normalise_weather(stacked("weather")),
    }
    if with_dust:
        inputs["dust"] = normalise_dust(stacked("dust"))
    return inputs


def months_with_files(spark: SparkSession, raw: str, year: str, names: Sequence[str]) -> dict[str, set[str]]:
    """The months of a year that each input has a file for that is not empty, by the names of its files."""
    found = {}
    for name in names:
        before, after = fv.INPUT_FILES[name].split("{month}")
        glob = f"{raw}/{before}{year}??{after}"
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        try:
            files = reader.load(glob).filter("length > 0").select("path")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            found[name] = set()
            continue
        month = F.regexp_extract("path", f"{re.escape(before)}({year}\\d\\d){re.escape(after)}", 1)
        found[name] = {r[0] for r in files.select(month).distinct().collect()}
    return found


def _store(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    months: Sequence[str],
    table: str,
    export: str | None,
    station: object,
    rules: Rules,
    partial: Sequence[str] = (),
) -> DataFrame:
    daily = daily_condition_table(merge_inputs(**inputs, station=station), rules)
    # Daily rows, so the raw files are aggregated once for all months.
    computed = materialise(daily, "daily")
    others = computed.filter(~F.coalesce(F.col("ym").isin([*months, *partial]), F.lit(False)))
    if not others.isEmpty():
        raise ValueError(f"the files hold days of other months, such as {others.first().use_date}; nothing is replaced")
    replace_months(computed, table, months)
    stored = read_month_table(spark, table, DAILY_SCHEMA).filter(F.col("ym").isin(list(months)))
    if export:
        write_csv(published_names(stored), export, bom=True, even=True)
    return stored


def run_month(
    spark: SparkSession,
    raw: str,
    month: str,
    table: str,
    export: str | None = None,
    station: object = fv.CITY_STATION,
    rules: Rules = Rules(),
    charsets: Mapping[str, str] | None = None,
) -> DataFrame:
    """Compute the month, replace it in the table, and return the stored rows.

    Running a month again gives the same table; a month that has become empty is emptied, others
    stay as they are, and a row of another month fails the run before anything is replaced. So does a file
    in an unknown charset or layout. The export is made from the stored rows, so the raw files are aggregated once.
    """
    inputs = read_inputs(spark, raw, month, charsets)
    return _store(spark, inputs, [month], table, export, station, rules)


def run_year(
    spark: SparkSession,
    raw: str,
    year: str,
    table: str,
    export: str | None = None,
    station: object = fv.CITY_STATION,
    rules: Rules = Rules(),
    charsets: Mapping[str, str] | None = None,
    with_dust: bool = True,
    weather: Literal["monthly", "yearly"] = "monthly",
) -> DataFrame:
    """The same for all monthly files of a year at once; returns the stored rows of the months that were replaced.

    Replaced are the months for which each input has a file, or with yearly weather each other input. Months that lack one, or all, stay
    as they are stored. Without dust the means of dust are stored as unknown. `weather` says which weather files
    count where both are there.
    """
    names = ["bus", "subway", *(["weather"] if weather == "monthly" else []), *(["dust"] if with_dust else [])]
    found = months_with_files(spark, raw, year, names)
    whole, some = set.intersection(*found.values()), set.union(*found.values())
    if not whole:
        raise ValueError(f"no month of {year} has files of all of {names} below {raw}")
    inputs = read_inputs(spark, raw, f"{year}??", charsets, with_dust, year if weather == "yearly" else None)
    return _store(spark, inputs, sorted(whole), table, export, station, rules, sorted(some - whole))
