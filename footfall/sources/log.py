"""The behaviour log: text and Parquet sources, the events adapter, the partitioned sink."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schema
from footfall.functions import timeparts
from footfall.session import materialise
from footfall.sources import tables

# How event names map to behaviour codes. Other events are no behaviour.
EVENT_CODES = {
    "view": schema.VIEW, "signup": schema.FAVOURITE, "click": schema.CART, "purchase": schema.BUY,
}


def read_log_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV with hour-grain text times, under an explicit schema."""
    raw = spark.read.schema(schema.LOG_TEXT).option("header", True).csv(path)
    return raw.withColumn("time", timeparts.parse_hour("time"))


class TooManyBadLines(ValueError):
    """A log file whose share of bad lines is above the bound."""


def read_log_csv_checked(spark: SparkSession, path: str, quarantine: str, most: float = 0.01) -> DataFrame:
    """:func:`read_log_csv` that keeps bad lines apart.

    A line is bad if it can't be read under the schema, lacks a user, item or time, or names no behaviour. Bad lines are written
    to ``quarantine`` as (line, reason), replacing what was there; the reason is the first that holds of ``malformed``,
    ``no user``, ``no item``, ``no time``, ``unknown behaviour``. If more than the share ``most`` of all lines is bad, the
    load fails, after the quarantine is written. No lines at all are no failure. An item without a category is good.

    The file is parsed once, into a written table; the quarantine and the good rows are read from that.
    """
    fields = T.StructType([*schema.LOG_TEXT.fields, T.StructField("_line", T.StringType())])
    raw = spark.read.schema(fields).option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_line").csv(path)
    hour = timeparts.try_parse_hour("time")
    reason = (
        F.when(F.col("_line").isNotNull(), "malformed")
        .when(F.col("user_id").isNull(), "no user")
        .when(F.col("item_id").isNull(), "no item")
        .when(hour.isNull(), "no time")
        .when(F.coalesce(~F.col("behavior_type").isin(*EVENT_CODES.values()), F.lit(True)), "unknown behaviour")
    )
    # a line that was read is given back as its fields
    line = F.coalesce("_line", F.array_join(F.array(*[F.col(f.name).cast("string") for f in schema.LOG_TEXT.fields]), ",", ""))
    parsed = materialise(raw.select(
        *[f.name for f in schema.LOG_TEXT.fields if f.name != "time"], hour.alias("time"),
        reason.alias("reason"), F.when(reason.isNotNull(), line).alias("line"),
    ), "parsed-log")
    rows = parsed.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    bad = tables.write_counted(
        parsed.where(F.col("reason").isNotNull()).select("line", "reason"), quarantine, n=F.count(F.lit(1))
    )["n"]
    if bad > most * rows:
        raise TooManyBadLines(f"{bad} of {rows} lines are bad, more than {most:.2%}; they are in {quarantine}")
    return parsed.where(F.col("reason").isNull()).select(*[f.name for f in schema.LOG.fields])


def read_log(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """A Parquet log written by :func:`write_log`.

    The bounds prune ``dt`` partitions and reach the scan as row-group filters, and only the named
    columns are read.
    """
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.where((F.col("dt") >= F.lit(since.date())) & (F.col("time") >= timeparts.naive(since)))
    if until is not None:
        last = (until - timedelta(microseconds=1)).date()
        rows = rows.where((F.col("dt") <= F.lit(last)) & (F.col("time") < timeparts.naive(until)))
    return rows.select(*(columns or [f.name for f in schema.LOG.fields]))


def write_log(log: DataFrame, path: str) -> None:
    """Replace a log table, partitioned by day.

    Ranges of (day, user, item, hour) keep the files even when one user or one day holds much of the
    log, and keep a user's rows together so that min/max statistics can skip row groups.
    """
    keys = ["dt", "user_id", "item_id", "time"]
    (
        log.withColumn("dt", F.to_date("time"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite").partitionBy("dt").parquet(path)
    )


def write_log_csv(log: DataFrame, path: str) -> None:
    log.withColumn("time", timeparts.format_hour("time")).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def _hour_not_before(moment: datetime) -> datetime:
    floor = moment.replace(minute=0, second=0, microsecond=0)
    return floor if floor == moment else floor + timedelta(hours=1)


def log_from_events(
    events: DataFrame, until: datetime | None = None, since: datetime | None = None
) -> DataFrame:
    """The log held in an ``events`` table.

    Times are cut to the hour. The bounds (``until`` exclusive) are on those hours; they are applied to
    the raw time, rounded up to the hour, which selects the same rows and reaches the scan.
    """
    rows = events.where(F.col("event_type").isin(*EVENT_CODES))
    if since is not None:
        rows = rows.where(F.col("ts") >= timeparts.naive(_hour_not_before(since)))
    if until is not None:
        rows = rows.where(F.col("ts") < timeparts.naive(_hour_not_before(until)))
    k = F.get_json_object("props", "$.k").cast("bigint")
    code = F.coalesce(*[F.when(F.col("event_type") == n, F.lit(c)) for n, c in EVENT_CODES.items()])
    return rows.select(
        "user_id",
        (F.col("user_id") % 10 * 100 + k).alias("item_id"),
        (k % 20).alias("item_category"),
        code.alias("behavior_type"),
        timeparts.truncate_hour("ts").alias("time"),
    )
