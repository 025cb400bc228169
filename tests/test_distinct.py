"""Distinct counts from daily partials, exact and approximate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from footfall.operators import distinct
from footfall.session import materialise


def _log(spark, n):
    day = F.expr("timestampadd(DAY, id % 5, TIMESTAMP_NTZ '2024-01-01 03:00:00')")
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 11)
    return spark.range(n).select(key.alias("item_id"), (F.col("id") * 7919 % (n // 2)).alias("user_id"), day.alias("time"))


def test_bitmaps_of_days_unite(spark):
    rows = _log(spark, 80_000).unionByName(_log(spark, 10).withColumn("user_id", F.lit(None).cast("long")))
    made, codes = distinct.daily_bitmaps(rows, "item_id", "user_id")
    days = materialise(made, "bitmaps", by="day")
    # codes reach beyond one bucket of 32,768
    assert codes.count() == 40_000 and days.select("bucket").distinct().count() == 2
    for since, until in ((None, None), (date(2024, 1, 2), date(2024, 1, 4)), (date(2024, 1, 5), None)):
        want = rows
        if since:
            want = want.where(F.col("time") >= F.lit(since).cast("timestamp_ntz"))
        if until:
            want = want.where(F.col("time") < F.lit(until).cast("timestamp_ntz"))
        exact = {r.item_id: r.n for r in want.groupBy("item_id").agg(F.count_distinct("user_id").alias("n")).collect() if r.n}
        found = distinct.distinct_of_bitmaps(days, "item_id", "n", since, until)
        assert {r.item_id: r.n for r in found.collect()} == exact
    # only the days asked for are opened
    plan = distinct.distinct_of_bitmaps(days, "item_id", "n", date(2024, 1, 5))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_sketches_of_days_unite_within_their_error(spark):
    rows = _log(spark, 80_000)
    days = materialise(distinct.daily_sketches(rows, "item_id", "user_id"), "sketches", by="day")
    about = {r.item_id: r.n for r in distinct.distinct_of_sketches(days, "item_id", "n").collect()}
    for r in rows.groupBy("item_id").agg(F.count_distinct("user_id").alias("n")).collect():
        assert abs(about[r.item_id] - r.n) <= 4 * 1.04 / 2 ** (distinct.SKETCH_BITS / 2) * r.n + 1
