"""Partials of the roll-ups by span of days: the features of a new day read that day of the log and no other.

A store is a folder with a table per roll-up, partitioned by the span (``since``, ``until``) its rows cover. Times are whole hours,
so counts per (day, key, hour) hold all that windows, recencies, bands and peaks need. Days can be merged into one span; its size is that
of the distinct keys, not of the log, and a cutoff reads it, the days of the longest window before the cutoff and no more.
Spans are written by dynamic partition overwrite: adding a day again replaces it, and a lost executor costs a retry.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import timeparts
from footfall.operators import rollup
from footfall.schema import BUY
from footfall.sources.log import read_log

SPAN = ["since", "until"]
TABLES = {
    "users": ["user_id", "hour"], "items": ["item_id", "hour"], "categories": ["item_category", "hour"],
    "pairs": ["user_id", "item_id"], "user_categories": ["user_id", "item_category"],
}
_COUNTS = ["n_all", *rollup.TYPES]


@dataclass(frozen=True)
class Rollups:
    """Tables as the feature functions take them."""

    users: DataFrame
    items: DataFrame
    categories: DataFrame
    pairs: DataFrame
    user_categories: DataFrame


def of_days(log: DataFrame, keys: list[str]) -> DataFrame:
    """A partial per day and keys; with the hour among the keys also the first, the last and the last buying time."""
    times = [
        F.min("time").alias("first"), F.max("time").alias("last"),
        F.max(F.when(rollup.of_type(BUY), F.col("time"))).alias("last_buy"),
    ]
    rows = log.withColumns({"hour": F.hour("time"), "since": F.to_date("time")})
    made = rows.groupBy("since", *keys).agg(*rollup.counts(), *(times if "hour" in keys else []))
    return made.withColumn("until", F.col("since"))


def merged(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of any spans as one per keys."""
    times = [F.min("first").alias("first"), F.max("last").alias("last"), F.max("last_buy").alias("last_buy")]
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _COUNTS], *(times if "hour" in keys else [])
    )


def _write_all(frames: dict[str, DataFrame], path: str) -> None:
    """The tables are independent, so they are written at the same time; ranges keep the files of a day few and a hot day divided."""

    def write(name: str) -> None:
        ordered = frames[name].repartitionByRange("since", *TABLES[name])
        writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*SPAN).parquet(f"{path}/{name}")

    with ThreadPoolExecutor(len(frames)) as pool:
        list(pool.map(write, frames))


def add_days(log: DataFrame, path: str) -> None:
    """Write the partials of all days in ``log``; days written before are replaced.

    ``log`` must hold those days whole. A day in a span merged earlier can't be replaced: the merged span would go on
    without the change.
    """
    _write_all({name: of_days(log, keys) for name, keys in TABLES.items()}, path)


def add_day(spark: SparkSession, log_path: str, path: str, day: date) -> None:
    """Add one day of a log table written by ``write_log``; only its partition is opened."""
    covered = max((until for since, until in _spans(spark, path) if since != until), default=None)
    if covered is not None and day <= covered:
        raise ValueError(f"{day} lies in the span merged until {covered}")
    add_days(one_day(spark, log_path, day), path)


def one_day(spark: SparkSession, log_path: str, day: date) -> DataFrame:
    start = datetime(day.year, day.month, day.day)
    return read_log(spark, log_path, since=start, until=start + timedelta(days=1))


def _spans(spark: SparkSession, path: str) -> list[tuple[date, date]]:
    """All spans of the store, a few per day of the log; read from the smallest table."""
    return [(r.since, r.until) for r in spark.read.parquet(f"{path}/categories").select(*SPAN).distinct().collect()]


def _cover(spans: list[tuple[date, date]], end: date, edge: date) -> Column:
    """Selects the days before ``end``, each once: the longest merged span that ends before ``edge``, then single days."""
    base = max((s for s in spans if s[0] != s[1] and s[1] < edge), key=lambda s: s[1], default=None)
    single = (F.col("since") == F.col("until")) & (F.col("since") < F.lit(end))
    if base is None:
        return single
    of_base = (F.col("since") == F.lit(base[0])) & (F.col("until") == F.lit(base[1]))
    return of_base | (single & (F.col("since") > F.lit(base[1])))


def merge_days(spark: SparkSession, path: str, end: date) -> None:
    """Write one span of all days before ``end``, from the longest one there is and the days after it. The days stay for
    earlier cutoffs."""
    spans = _spans(spark, path)
    days = [since for since, until in spans if since == until and since < end]
    if not days:
        raise ValueError(f"no days before {end}")
    first, last = min(days), max(days)
    if first == last or (first, last) in spans:
        return
    cover = _cover(spans, end, last)
    whole = {"since": F.lit(first), "until": F.lit(last)}
    _write_all(
        {
            name: merged(spark.read.parquet(f"{path}/{name}").where(cover), keys).withColumns(whole)
            for name, keys in TABLES.items()
        },
        path,
    )


def rollups(spark: SparkSession, path: str, as_of: datetime) -> Rollups:
    """The roll-ups of the days before ``as_of``, a midnight. Windows and recencies count from the latest time in them."""
    if as_of != datetime(as_of.year, as_of.month, as_of.day):
        raise ValueError("partials are kept by day: the cutoff must be a midnight")
    end = as_of.date()
    categories = spark.read.parquet(f"{path}/categories")
    latest = categories.where((F.col("since") == F.col("until")) & (F.col("until") < F.lit(end))).agg(F.max("last")).first()[0]
    if latest is None:
        raise ValueError("no rows before the cutoff")
    # a span that ends before this day has no row within the longest window
    edge = (latest - timedelta(days=max(rollup.WINDOWS.values()))).date()
    cover = _cover(_spans(spark, path), end, edge)
    now = timeparts.epoch_seconds(timeparts.naive(latest))

    def age(time: str) -> Column:
        return now - timeparts.epoch_seconds(time)

    def by_key(name: str) -> DataFrame:
        keys = TABLES[name]
        views = [
            F.sum(F.when(age("first") <= days * timeparts.DAY, F.col("n_view")).otherwise(0)).alias(n)
            for n, days in rollup.WINDOWS.items()
        ]
        times = [
            F.max(age("first")).alias("first_age"), F.min(age("last")).alias("last_age"), F.min(age("last_buy")).alias("buy_age"),
        ]
        partials = spark.read.parquet(f"{path}/{name}").where(cover)
        fine = partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _COUNTS], *views, *times)
        return rollup.over_hours(fine, keys[0])

    def summed(name: str) -> DataFrame:
        return merged(spark.read.parquet(f"{path}/{name}").where(cover), TABLES[name])

    return Rollups(by_key("users"), by_key("items"), by_key("categories"), summed("pairs"), summed("user_categories"))
