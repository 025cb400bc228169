"""Features from partials by day against features from the whole log."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from footfall.operators import daily, features, history
from footfall.session import scratch_path
from footfall.sources.log import write_log


def _log(spark, n=6000):
    """20 days; user 7 holds a third of the rows, day 12 has none, the last hours of a day lie on the windows' edges."""
    i = F.col("id")
    day = F.when(i * 31 % 20 == 12, 13).otherwise(i * 31 % 20)
    time = F.timestamp_add("HOUR", day * 24 + i * 17 % 24, F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    return spark.range(n).select(
        F.when(i % 3 == 0, 7).otherwise(i * 13 % 97).cast("long").alias("user_id"), (i * 7 % 53).alias("item_id"),
        (i * 7 % 53 % 6).alias("item_category"), F.element_at(F.array(*map(F.lit, [1, 1, 1, 2, 3, 4])), (i * 11 % 6 + 1).cast("int"))
        .alias("behavior_type"), time.alias("time"),
    )


def _rows(df):
    return sorted(df.collect(), key=str)


def _same(spark, log, path, as_of):
    h, r = history.open_history(log, as_of), daily.rollups(spark, path, as_of)
    got = [
        features.user_features(None, None, r.pairs, r.user_categories, r.users),
        features.item_features(None, None, r.pairs, r.items),
        features.category_features(None, None, r.user_categories, r.categories),
    ]
    for build, found in zip((features.user_features, features.item_features, features.category_features), got):
        want = build(h)
        assert found.columns == want.columns and found.dtypes == want.dtypes
        assert _rows(found) == _rows(want)
    return got


def test_features_from_partials(spark):
    log = _log(spark)
    log_path, path = scratch_path(spark, "log"), scratch_path(spark, "store")
    write_log(log, log_path)
    daily.add_days(log.where(F.col("time") < F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")), path)
    _same(spark, log, path, datetime(2024, 1, 16))
    # the 13th has no rows: windows of the 14th's cutoff count from the 12th
    _same(spark, log, path, datetime(2024, 1, 14))
    daily.merge_days(spark, path, date(2024, 1, 7))
    daily.add_day(spark, log_path, path, date(2024, 1, 16))
    daily.add_day(spark, log_path, path, date(2024, 1, 16))
    users, *_ = _same(spark, log, path, datetime(2024, 1, 17))
    # an earlier cutoff, whose windows reach into the merged span, reads the days instead
    _same(spark, log, path, datetime(2024, 1, 9))
    daily.merge_days(spark, path, date(2024, 1, 9))
    daily.add_day(spark, log_path, path, date(2024, 1, 17))
    _same(spark, log, path, datetime(2024, 1, 18))
    spans = {s for s in daily._spans(spark, path) if s[0] != s[1]}
    assert spans == {(date(2024, 1, 1), date(2024, 1, 6)), (date(2024, 1, 1), date(2024, 1, 8))}
    with pytest.raises(ValueError, match="merged"):
        daily.add_day(spark, log_path, path, date(2024, 1, 8))
    with pytest.raises(ValueError, match="midnight"):
        daily.rollups(spark, path, datetime(2024, 1, 9, 3))
    with pytest.raises(ValueError, match="no rows"):
        daily.rollups(spark, path, datetime(2024, 1, 1))


def test_a_day_opens_one_partition_of_the_log(spark):
    log_path = scratch_path(spark, "log")
    write_log(_log(spark, 500), log_path)
    day = daily.one_day(spark, log_path, date(2024, 1, 5))
    files = day.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("dt=2024-01-05" in r.f for r in files)
    plan = daily.of_days(day, daily.TABLES["users"])._jdf.queryExecution().executedPlan().toString()
    assert "(dt#" in plan and ">= 2024-01-05)" in plan and "<= 2024-01-05)" in plan
