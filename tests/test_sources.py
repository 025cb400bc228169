"""Checked loads, bucketed lookups, counts while writing, reconciliation by fingerprints."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from footfall.operators import joins, models, reconcile
from footfall.session import materialise, scratch_path
from footfall.sources import tables
from footfall.sources.log import TooManyBadLines, read_log_csv_checked

_HEAD = "user_id,item_id,item_category,behavior_type,time"


def _written(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in [_HEAD, *lines]], "value string").coalesce(1).write.text(path)
    return path


def test_bad_lines_go_to_the_quarantine(spark):
    good = ["1,2,3,1,2024-01-01 05", "1,2,,4,2024-02-29 23"]
    bad = {
        "x,2,3,1,2024-01-01 05": "malformed", "1,2": "malformed", "1,2,3,1,2024-01-01 05,7": "malformed",
        ",2,3,1,2024-01-01 05": "no user", "1,,3,1,2024-01-01 05": "no item", "1,2,3,1,": "no time",
        "1,2,3,1,2023-02-29 05": "no time", "1,2,3,1,2024-01-01 24": "no time", "1,2,3,1,2024-01-01": "no time",
        "1,2,3,9,2024-01-01 05": "unknown behaviour", "1,2,3,,2024-01-01 05": "unknown behaviour",
        ",,,,": "no user",
    }
    path, quarantine = _written(spark, [*good, *bad]), scratch_path(spark, "quarantine")
    rows = read_log_csv_checked(spark, path, quarantine, most=12 / 14)
    assert sorted(map(str, (r.time for r in rows.collect()))) == ["2024-01-01 05:00:00", "2024-02-29 23:00:00"]
    assert {r.line: r.reason for r in spark.read.parquet(quarantine).collect()} == bad


def test_too_many_bad_lines_fail_the_load(spark):
    path, quarantine = _written(spark, ["1,2,3,1,2024-01-01 05", "bad"]), scratch_path(spark, "quarantine")
    with pytest.raises(TooManyBadLines, match="1 of 2 lines"):
        read_log_csv_checked(spark, path, quarantine, most=0.4)
    assert spark.read.parquet(quarantine).count() == 1


def test_a_log_without_lines_is_good(spark):
    assert read_log_csv_checked(spark, _written(spark, []), scratch_path(spark, "quarantine"), most=0).count() == 0


def test_counts_come_from_the_job_that_writes(spark):
    context, path = spark.sparkContext, scratch_path(spark, "counted")
    context.setJobGroup("counted", "one job")
    found = tables.write_counted(
        spark.range(1000).withColumn("gap", F.when(F.col("id") % 4 > 0, F.col("id"))), path,
        rows=F.count(F.lit(1)), gaps=F.count_if(F.col("gap").isNull()), top=F.max("id"),
    )
    assert found == {"rows": 1000, "gaps": 250, "top": 999}
    assert len(context.statusTracker().getJobIdsForGroup("counted")) == 1
    context.setJobGroup("", "")
    assert spark.read.parquet(path).count() == 1000
    empty = tables.write_counted(spark.range(0), path, rows=F.count(F.lit(1)), top=F.max("id"))
    assert empty == {"rows": 0, "top": None}


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_bucketed_tables_are_not_shuffled(spark):
    """Without broadcasts each lookup shuffles the rows that look up and leaves the table where it lies."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # a third of the rows look up one key, and some keys are in one side only
        key = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 900)
        rows = materialise(spark.range(6000).select("id", key.alias("k"), F.lit(1).alias("v")), "rows")
        table = materialise(spark.range(100, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "table")
        tables.write_bucketed(table, "kept_in_buckets", scratch_path(spark, "bucketed"), "k", 8)
        plain = joins.lookup(rows, table, "k")
        kept = joins.lookup(rows, spark.table("kept_in_buckets"), "k")
        assert (_exchanges(plain), _exchanges(kept)) == (2, 1)
        assert sorted(kept.collect()) == sorted(plain.collect())
        # a second write replaces the first
        tables.write_bucketed(table.where("k < 200"), "kept_in_buckets", scratch_path(spark, "bucketed"), "k", 8)
        assert spark.table("kept_in_buckets").count() == 100
    finally:
        spark.sql("DROP TABLE IF EXISTS kept_in_buckets")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _sides(spark, change):
    stored = materialise(spark.range(5000).select(
        "id", (F.col("id") / 3).alias("rate"), F.when(F.col("id") % 2 == 0, F.col("id") % 24).alias("hour")
    ), "stored")
    return stored, materialise(change(stored).repartition(7), "fresh")


_CHANGES = {
    "one value": lambda t: t.withColumn("hour", F.when(F.col("id") == 70, 99).otherwise(F.col("hour"))),
    "swapped values": lambda t: t.withColumn("hour", F.when(F.col("id").isin(2, 4), F.lit(6) - F.col("id")).otherwise(F.col("hour"))),
    "close doubles": lambda t: t.withColumn("rate", F.col("rate") + F.when(F.col("id") < 9, 1e-9).otherwise(0.0)),
    "NULL for a value": lambda t: t.withColumn("hour", F.when(F.col("id") != 8, F.col("hour"))),
    "missing and new keys": lambda t: t.where("id <> 3").unionByName(t.where("id < 2").withColumn("id", F.col("id") + 9000)),
    "keys without a value": lambda t: t.unionByName(t.limit(2).withColumn("id", F.lit(None).cast("long"))),
    "no rows": lambda t: t.where("false"),
}


@pytest.mark.parametrize("change", _CHANGES)
def test_fingerprints_find_what_a_join_finds(spark, change):
    stored, fresh = _sides(spark, _CHANGES[change])
    for a, b in ((stored, fresh), (fresh, stored)):
        want = {r.feature: r.asDict() for r in reconcile.all_agree(a, b, "id").collect()}
        for buckets in (16, 1 << 16):
            found = reconcile.agree_by_fingerprint(a, b, "id", buckets=buckets)
            assert {r.feature: r.asDict() for r in found.collect()} == want


def test_tables_that_agree_are_not_joined(spark):
    stored, fresh = _sides(spark, lambda t: t)
    found = reconcile.agree_by_fingerprint(stored, fresh, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # what is left reads the fingerprints alone
    assert "Join" not in plan and "stored-" not in plan and "fresh-" not in plan
    assert {(r.feature, r["keys"], r.present, r.differing) for r in found.collect()} == {("rate", 5000, 5000, 0), ("hour", 5000, 2500, 0)}


def test_a_fitted_model_scores_after_rows_were_observed(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7 + F.hash("id") % 3 > 3).cast("int").alias("label"))
    tables.write_counted(rows, str(tmp_path / "counted"), rows=F.count(F.lit(1)))
    ready = models.vectors(rows, ["a"])
    model = models.fit_logistic(ready, 200)
    tables.save_model(model, str(tmp_path / "model"))
    again = tables.load_model(LogisticRegressionModel, str(tmp_path / "model"))
    own, read = (sorted(r.score for r in models.score(m, ready).collect()) for m in (model, again))
    assert own == read and len(own) == 200
