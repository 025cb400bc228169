"""Distinct partners of a key over any span of days, from partials kept by day.

Exact: dense codes of the partners in bitmaps, a bitmap per (day, key, bucket of codes). Bitmaps of days are united without the log.
Approximate: a sketch per (day, key), united likewise.

Both are built by hash aggregates with partial sums, so a key that holds a third of the log sends a row per task and bucket.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators import ranking

#: Base-two logarithm of a sketch's registers; the error is about 1.04 / 2 ** (bits / 2) of the count, relative.
SKETCH_BITS = 12


def _day() -> Column:
    return F.to_date("time").alias("day")


def daily_bitmaps(log: DataFrame, key: str, partner: str) -> tuple[DataFrame, DataFrame]:
    """(day, key, bucket, bits) and the partners' codes (partner, code). Writes ordered slices of the codes while it is built."""
    codes = ranking.dense_codes(log, partner, "code")
    # a partner is coded once per day and key, whatever its rows
    seen = log.where(F.col(partner).isNotNull()).select(_day(), key, partner).distinct()
    # bitmaps count from 1
    coded = seen.join(codes, partner).withColumn("place", F.col("code") + 1)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    return coded.groupBy("day", key, F.bitmap_bucket_number("place").alias("bucket")).agg(bits), codes


def _within(days: DataFrame, since: date | None, until: date | None) -> DataFrame:
    rows = days if since is None else days.where(F.col("day") >= F.lit(since))
    return rows if until is None else rows.where(F.col("day") < F.lit(until))


def distinct_of_bitmaps(days: DataFrame, key: str, name: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """Exact distinct partners per key over the days from ``since`` to before ``until``."""
    united = _within(days, since, until).groupBy(key, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(key).agg(F.sum(F.bitmap_count("bits")).alias(name))


def daily_sketches(log: DataFrame, key: str, partner: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(day, key, sketch) of the partners."""
    return log.groupBy(_day(), key).agg(F.hll_sketch_agg(partner, bits).alias("sketch"))


def distinct_of_sketches(days: DataFrame, key: str, name: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """Approximate distinct partners per key over the days from ``since`` to before ``until``."""
    return _within(days, since, until).groupBy(key).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
