"""Selection, metrics, models and sinks."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from footfall import schema
from footfall.operators import metrics, models, reconcile, selection
from footfall.operators.models import Boosting
from footfall.session import scratch_path
from footfall.sources import tables
from footfall.sources.log import read_log, read_log_csv, write_log, write_log_csv


def _corr(spark, rows):
    return spark.createDataFrame(
        [(i, j, a, b, c) for i, j, a, b, c in rows], "i int, j int, col_i string, col_j string, corr double"
    )


def test_correlation_chain_drops_the_earlier(spark):
    corr = _corr(spark, [(0, 1, "a", "b", 0.9), (1, 2, "b", "c", 0.9), (0, 2, "a", "c", 0.7)])
    assert {r.feature for r in selection.redundant(corr).collect()} == {"a", "b"}


def test_priority_keeps_the_listed(spark):
    corr = _corr(spark, [(0, 1, "a", "b", 0.9), (1, 2, "b", "c", 0.9)])
    assert {r.feature for r in selection.redundant(corr, priority=["a"]).collect()} == {"b"}
    assert {r.feature for r in selection.redundant(corr, priority=["a", "b"]).collect()} == {"a", "c"}


def test_constant_columns_have_no_partner(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 6.0)], "a double, k double, b double")
    assert selection.drop_redundant(df, ["a", "k", "b"]) == ["k", "b"]


def test_informative_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None, "z", "y"), (2.0, 5.0, None, "z", "y"), (3.0, 5.0, 1.0, "x", "y")],
        "a double, k double, gaps double, t string, s string",
    )
    assert selection.keep_informative(df, df.columns) == ["a", "s", "t"]
    missing = {r.feature: r.missing_ratio for r in selection.missing_ratio(df).collect()}
    assert missing["gaps"] == pytest.approx(2 / 3)


def test_inputs_ignore_absent_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 0, 4.0)], "user_id int, item_id int, item_category int, label int, uv double")
    assert selection.inputs(df) == ["item_category", "uv"]
    assert len(schema.NOT_INPUTS) == 15


def test_encode_fails_on_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",)], "s string")
    assert [r.s for r in selection.encode(train, train, "s").orderBy("s").collect()] == [0, 1]
    other = spark.createDataFrame([("q",)], "s string")
    with pytest.raises(Exception, match="was not seen in training"):
        selection.encode(train, other, "s").collect()


def test_share_keeps_the_top_one(spark):
    table = spark.createDataFrame([("a", 99.0), ("b", 1.0)], "feature string, importance double")
    assert [r.feature for r in selection.select_by_share(table).collect()] == ["a"]
    even = spark.createDataFrame([(c, 1.0) for c in "abcd"], "feature string, importance double")
    assert {r.feature for r in selection.select_by_share(even, 0.75).collect()} == {"a", "b", "c"}


def _scored(spark, rows):
    return metrics.predict(spark.createDataFrame(rows, "label int, score double"))


def test_auc_counts_ties_half(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(300)]
    pos, neg = ([s for y, s in rows if y == c] for c in (1, 0))
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.auc(_scored(spark, rows)).first()[0] == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_missing(spark):
    assert metrics.auc(_scored(spark, [(1, 0.5), (1, 0.7)])).first()[0] is None


def test_roc_leaves_out_straight_runs(spark):
    rows = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)]
    points = [(r.fpr, r.tpr) for r in metrics.roc(_scored(spark, rows)).orderBy(F.desc("threshold")).collect()]
    assert points == [(0.0, 0.0), (0.0, 0.25), (0.0, 0.75), (1.0, 0.75), (1.0, 1.0)]
    assert metrics.roc(_scored(spark, rows), corners_only=False).count() == 7


def test_undefined_metrics_are_zero(spark):
    row = metrics.precision_recall(_scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert tuple(row) == (0.0, 0.0, 0.0)


def test_log_loss_is_clipped(spark):
    value = metrics.log_loss(_scored(spark, [(1, 0.0)])).first()[0]
    assert value == pytest.approx(-math.log(2.0**-52))


def test_best_round_waits_for_the_patience():
    assert models.best_round([5, 4, 3, 4, 4, 4, 1], patience=3) == 3
    assert models.best_round([5, 4, 3, 4, 4, 4, 1], patience=9) == 7
    assert models.best_round([3, 3, 3], patience=10) == 1


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(5)
    rows = [(int(x + rng.gauss(0, 0.3) > 0), x, rng.random()) for x in (rng.uniform(-1, 1) for _ in range(400))]
    df = spark.createDataFrame(rows, "label int, x double, noise double").coalesce(1).cache()
    return models.vectors(df, ["x", "noise"])


def test_patience_equals_the_long_fit(separable):
    train, val = separable.where("noise < 0.7"), separable.where("noise >= 0.7")
    config = Boosting(depth=2, rounds=24, min_rows=5)
    long = models.losses(models.fit_boosting(train, config), val)
    short = models.fit_with_patience(train, val, config, patience=4, first=6)
    assert short.getNumTrees == models.best_round(long, 4)
    assert models.losses(short, val) == pytest.approx(long[: short.getNumTrees])


def test_models_find_the_signal(spark, separable):
    model = models.fit_boosting(separable, Boosting(depth=2, rounds=5, min_rows=5))
    row = metrics.summary(models.score(model, separable)).first()
    assert row.auc > 0.9
    gain = {r.feature: r.importance for r in selection.importance(model, ["x", "noise"]).collect()}
    splits = {r.feature: r.importance for r in selection.importance(model, ["x", "noise"], "split").collect()}
    assert gain["x"] > gain["noise"]
    assert splits["x"] >= 5
    keyed = separable.withColumn("user_id", F.monotonically_increasing_id()).drop("features")
    moved = selection.permutation_importance(model, keyed, ["x", "noise"], ["user_id"], repeats=2)
    found = {r.feature: r.importance_mean for r in moved.collect()}
    assert found["x"] > max(found["noise"], 0.05)
    logistic = models.fit_logistic(separable, 400)
    assert metrics.auc(models.score(logistic, separable)).first()[0] > 0.9
    path = scratch_path(spark, "model")
    tables.save_model(model, path)
    assert tables.load_model(GBTClassificationModel, path).getNumTrees == 5


def test_halved_loss_is_the_log_loss(separable):
    model = models.fit_boosting(separable, Boosting(depth=2, rounds=5, min_rows=5))
    last = models.losses(model, separable)[-1]
    assert metrics.log_loss(models.score(model, separable)).first()[0] == pytest.approx(last, abs=1e-9)


def test_log_round_trips(spark, make_log):
    rows = [(1, 2, 3, 4, "2014-11-18 00"), (5, 6, 7, 1, "2014-12-18 23"), (5, 6, 7, 1, "2014-12-17 05")]
    log = make_log(rows)
    text, parquet = scratch_path(spark, "csv"), scratch_path(spark, "log")
    write_log_csv(log, text)
    assert sorted(map(tuple, read_log_csv(spark, text).collect())) == sorted(map(tuple, log.collect()))
    write_log(log, parquet)
    assert sorted(map(tuple, read_log(spark, parquet).collect())) == sorted(map(tuple, log.collect()))


def test_bounds_reach_the_scan(spark, make_log):
    from datetime import datetime

    path = scratch_path(spark, "log")
    write_log(make_log([(1, 2, 3, 4, "2014-12-18 00"), (1, 2, 3, 1, "2014-12-17 05")]), path)
    rows = read_log(spark, path, ["user_id"], datetime(2014, 12, 17), datetime(2014, 12, 18))
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(time" in plan
    assert "ReadSchema: struct<user_id:bigint,time:timestamp_ntz>" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_schema_is_checked_on_write(spark):
    bad = spark.createDataFrame([(1, "x")], "item_category long, total_pv string")
    with pytest.raises(ValueError, match="total_pv"):
        tables.write_table(bad, scratch_path(spark, "bad"), schema.CATEGORY_TABLE)


def test_reconcile_reports_each_difference(spark):
    stored = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "k long, n long")
    fresh = spark.createDataFrame([(1, 10), (2, 21), (4, 1)], "k long, n long")
    row = reconcile.counts_agree(stored, fresh, "k", "n").first()
    assert (row["keys"], row.only_fresh, row.only_stored, row.differing) == (4, 1, 1, 1)
    a = spark.createDataFrame([(1, 0.5), (2, None), (3, None)], "k long, r double")
    b = spark.createDataFrame([(1, 0.5 + 1e-9), (2, None), (3, 0.1)], "k long, r double")
    assert reconcile.ratios_agree(a, b, "k", "r").first().differing == 1


def test_training_table_of_a_log_table(spark):
    """Read by partitions of history and label days, the same table as from the whole log."""
    from footfall.catalog.registry import TRAIN_AS_OF, TRAIN_DAYS, log
    from footfall.plans import pipeline

    whole = log(spark, "/root/testdata/sf0.001")
    path = scratch_path(spark, "log")
    write_log(whole, path)
    a = pipeline.training_table_from(spark, path, TRAIN_AS_OF, TRAIN_DAYS)
    b = pipeline.training_table(whole, TRAIN_AS_OF, TRAIN_DAYS)
    assert a.columns == b.columns
    assert len(a.columns) == 58
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert len(selection.inputs(a)) == 44


def test_first_rounds_are_a_shorter_fit(separable):
    """The first trees of a long fit give the losses of a fit of that length, and whole importances."""
    from footfall.operators.models import Boosting

    config = Boosting(rounds=8, depth=2)
    long = models.fit_boosting(separable, config)
    short = models.fit_boosting(separable, Boosting(rounds=3, depth=2))
    cut = models.first_rounds(long, 3)
    assert cut.getNumTrees == 3
    assert models.losses(cut, separable) == pytest.approx(models.losses(short, separable), abs=1e-12)


def test_text_columns_are_coded_from_train(spark):
    from footfall.plans import experiments
    from footfall.plans.pipeline import Splits

    rows = [(i, "abc"[i % 3], float(i % 5), int(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "user_id long, kind string, x double, label int")
    parts = experiments.encoded(Splits(df, df.where("kind <> 'c'"), df.limit(5)), ["kind", "x"])
    assert {r.kind for r in parts.train.collect()} == {0, 1, 2}
    assert {r.kind for r in parts.val.collect()} == {0, 1}


def test_correlation_with_gaps_is_pairwise(spark):
    rows = [(1.0, 2.0, None), (2.0, None, 1.0), (3.0, 5.0, 2.0), (4.0, 9.0, 1.5), (6.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_i, r.col_j): r["corr"] for r in selection.correlations(df, ["a", "b", "c"]).collect()}

    def plain(i, j):
        pairs = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        x, y = zip(*pairs)
        mx, my = sum(x) / len(x), sum(y) / len(y)
        top = sum((p - mx) * (q - my) for p, q in pairs)
        return abs(top / (sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y)) ** 0.5)

    assert got == pytest.approx({("a", "b"): plain(0, 1), ("a", "c"): plain(0, 2), ("b", "c"): plain(1, 2)})


def test_correlation_without_variance_is_nan(spark):
    rows = [(1.0, 5e9, None, 2.0), (2.0, 5e9, 1.0, None), (3.0, 5e9, 2.0, None), (4.5, 5e9, 4.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.col_i, r.col_j): r["corr"] for r in selection.correlations(df.repartition(3), ["a", "b", "c", "d"]).collect()}
    assert all(math.isnan(got[p]) for p in (("a", "b"), ("b", "c"), ("b", "d"), ("c", "d")))
    assert got["a", "c"] == pytest.approx(float(np.corrcoef([2, 3, 4.5], [1, 2, 4])[0, 1])) and got["a", "d"] == pytest.approx(1.0)
    # large values far from 0 keep their digits
    far = df.select("a", (df.a * 3 + 1e12).alias("e"))
    assert selection.correlations(far, ["a", "e"]).first()["corr"] == pytest.approx(1.0, abs=1e-6)
    assert selection.correlations(df.limit(0), ["a", "c"]).first()["corr"] != 0


def test_patience_takes_two_fits_at_most(separable, monkeypatch):
    tried, fit = [], models.fit_boosting
    monkeypatch.setattr(models, "fit_boosting", lambda train, config: tried.append(config.rounds) or fit(train, config))
    models.stop_early(separable, separable, Boosting(depth=1, rounds=9, min_rows=5), patience=2, first=2)
    assert tried == [2, 9]


def test_wide_aggregates_go_by_parts(spark, monkeypatch):
    df = spark.range(5).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(40)])
    widths, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *columns: widths.append(len(columns)) or agg(self, *columns))
    assert selection.keep_informative(df, df.columns) == df.columns[1:]
    assert max(widths) <= 16 and sum(widths) == 80
