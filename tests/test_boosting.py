"""Boosting of many experiments at once, against a plain booster that copies rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import boosting, metrics, rebalance
from footfall.operators.boosting import UNIT, Growth

NAMES = ["a", "b", "c"]


def _rows(n, seed):
    draw = random.Random(seed)
    for i in range(n):
        x = [draw.gauss(0, 1), float(draw.randrange(6)), draw.gauss(0, 3)]
        y = int(draw.random() < 1 / (1 + math.exp(-(2 * x[0] + (x[1] > 2) * x[2] - 1))))
        yield (i, i % 17, i % 5, *x, y, [1, 1 + 2 * y, i % 2])


@pytest.fixture(scope="module")
def data(spark):
    kinds = "user_id long, item_id long, item_category long, a double, b double, c double, label int, weights array<int>"
    train, val = list(_rows(400, 1)), list(_rows(200, 2))
    return spark.createDataFrame(train, kinds), spark.createDataFrame(val, kinds), train, val


def _plain(train, val, cuts, weight, config):
    """Trees by trying every cut of every leaf, over copied rows."""
    rows = [r for r in train for _ in range(r[7][weight])]
    bins = lambda r: [sum(c < v for c in edges) for v, edges in zip(r[3:6], cuts)]
    x, y = np.array([bins(r) for r in rows]), np.array([r[6] for r in rows])
    vx, vy = np.array([bins(r) for r in val]), np.array([r[6] for r in val])
    start = math.log(y.mean() / (1 - y.mean()))
    margin, vmargin = np.full(len(y), start), np.full(len(vy), start)
    losses, best = [], 0
    while len(losses) < config.rounds and len(losses) - best < config.patience:
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(UNIT * (p - y)) / UNIT, np.rint(UNIT * p * (1 - p)) / UNIT
        leaves = [(np.ones(len(y), bool), np.ones(len(vy), bool))]

        def top(inside):
            found = (0.0, None)
            for f in range(3):
                for b in sorted(set(x[inside, f]))[:-1]:
                    low = inside & (x[:, f] <= b)
                    high = inside & ~low
                    if min(low.sum(), high.sum()) >= config.min_rows and min(h[low].sum(), h[high].sum()) >= config.min_curvature:
                        gain = sum(s * g[m].sum() ** 2 / h[m].sum() for s, m in ((1, low), (1, high), (-1, inside)))
                        if gain > found[0] + 1e-12:
                            found = gain, (f, b)
            return found

        tops = [top(leaves[0][0])]
        while len(leaves) < config.leaves and max(t[0] for t in tops) > 0:
            at = max(range(len(tops)), key=lambda i: tops[i][0])
            (inside, vinside), (_, (f, b)) = leaves.pop(at), tops.pop(at)
            for low in (True, False):
                part = inside & ((x[:, f] <= b) == low)
                leaves.append((part, vinside & ((vx[:, f] <= b) == low)))
                tops.append(top(part))
        for inside, vinside in leaves:
            value = -config.step * g[inside].sum() / h[inside].sum()
            margin[inside] += value
            vmargin[vinside] += value
        losses.append(float(np.mean(np.logaddexp(0, vmargin) - vy * vmargin)))
        best = int(np.argmin(losses)) + 1
    return losses, best


def test_every_experiment_is_the_booster_of_its_copies(spark, data):
    train, val, rows, held = data
    config = Growth(leaves=6, rounds=5, min_rows=10, patience=2, step=0.5, carry=2)
    cuts = boosting.quantile_cuts(train, NAMES, 15)
    fit = boosting.fit(train, val, NAMES, 3, config, cuts)
    for e in range(3):
        losses, best = _plain(rows, held, cuts, e, config)
        assert fit.val_losses[e] == pytest.approx(losses, abs=1e-6)
        assert fit.best[e] == best
        # a tree a round, and none after patience has run out
        assert len(fit.trees[e]) == len(losses)
    scored = boosting.scores(fit, val, ["label"], ["x", "y", "z"])
    table = {r.experiment: r for r in metrics.summaries(scored, "experiment").collect()}
    for e, name in enumerate("xyz"):
        assert table[name].log_loss == pytest.approx(fit.val_losses[e][fit.best[e] - 1], abs=1e-6)
        alone = scored.where(F.col("experiment") == name)
        assert table[name].auc == pytest.approx(metrics.auc(alone).first().auc)
    nodes = boosting.nodes(fit, spark, ["x", "y", "z"])
    leaves = nodes.where("feature is null").groupBy("experiment", "tree").count().collect()
    assert len(leaves) == sum(map(len, fit.trees)) and all(2 <= r["count"] <= 6 for r in leaves)


def test_partitions_do_not_change_the_fit(spark, data, monkeypatch):
    train, val, _, _ = data
    config = Growth(leaves=4, rounds=2, min_rows=10, patience=None)
    cuts = boosting.quantile_cuts(train, NAMES, 15)
    one = boosting.fit(train, val, NAMES, 3, config, cuts)
    monkeypatch.setattr(boosting, "PART_ROWS", 100)
    many = boosting.fit(train, val, NAMES, 3, config, cuts)
    assert [[t.__dict__ for t in trees] for trees in one.trees] == [[t.__dict__ for t in trees] for trees in many.trees]
    assert one.val_losses == many.val_losses


def test_an_experiment_without_both_classes_is_left_alone(spark, data):
    train, val, _, _ = data
    only = train.withColumn("weights", F.array(F.lit(1), (F.col("label") == 0).cast("int")))
    fit = boosting.fit(only, val, NAMES, 2, Growth(leaves=3, rounds=1))
    assert [len(t) for t in fit.trees] == [1, 0]


def test_weights_are_the_rebalanced_sets(spark, data):
    train, _, rows, _ = data
    odd = train.where("label = 0 or user_id % 4 = 0").drop("weights")
    ratios = [0.3, 0.8]
    table, cases = rebalance.grid_weights(odd, NAMES, ratios)
    kept = table.collect()
    for e, (method, ratio) in enumerate(cases):
        have = Counter()
        for r in kept:
            have[r.a, r.b, r.c, r.label] += r.weights[e]
        if method == "baseline":
            want = odd
        elif method == "smote":
            want = rebalance.smote(odd, NAMES, ratio)
        else:
            want = (rebalance.oversample if method == "oversampling" else rebalance.undersample)(odd, ratio)
        assert +have == Counter((r.a, r.b, r.c, r.label) for r in want.select(*NAMES, "label").collect())


def test_a_small_table_is_fitted_in_one_pass(spark, data, monkeypatch):
    train, val, _, _ = data
    config = Growth(leaves=8, rounds=3, min_rows=5, patience=2, step=0.5, carry=2)
    cuts = boosting.quantile_cuts(train, NAMES, 15)
    one = boosting.fit(train, val, NAMES, 3, config, cuts)
    assert one.passes == 1
    monkeypatch.setattr(boosting, "PART_ROWS", 100)
    many = boosting.fit(train, val, NAMES, 3, config, cuts)
    assert [[t.__dict__ for t in trees] for trees in one.trees] == [[t.__dict__ for t in trees] for trees in many.trees]
    assert (one.train_losses, one.val_losses, one.best) == (many.train_losses, many.val_losses, many.best)


def test_a_table_of_millions_of_rows_is_fitted_in_one_pass(spark):
    n = 2_050_000
    rows = spark.range(n).select(
        ((F.col("id") * 7919) % 1000 / 10).alias("a"), (F.col("id") % 10).cast("double").alias("b"),
        (F.col("id") % 10 + F.col("id") * 31 % 7 > 9).cast("int").alias("label"), F.array(F.lit(1)).alias("weights"),
    )
    cuts = [[float(i) for i in range(0, 100, 10)], [float(i) for i in range(10)]]
    fit = boosting.fit(rows, rows.limit(1000), ["a", "b"], 1, Growth(leaves=4, rounds=2, patience=None), cuts)
    assert fit.passes == 1 and [len(t) for t in fit.trees] == [2]
    assert fit.train_losses[0][1] < fit.train_losses[0][0]


@pytest.mark.parametrize("heavy", [1, 1 << 24])
def test_sums_of_a_node_are_exact_whatever_the_weights(heavy):
    n, draw = 3 * boosting.PIECE + 5, np.random.default_rng(1)
    rows = boosting._Rows(2, n, 0.5, Growth())
    bins, label = draw.integers(0, 256, (n, 2)).astype(np.uint8), draw.integers(0, 2, n)
    weight = draw.integers(1, 3, n) * heavy
    rows.fill(bins, label, weight)
    rows.start()
    middle = rows.part(0, n, 0, 100)
    left = np.flatnonzero(bins[:, 0] <= 100)
    assert middle == len(left) and set(rows.order[:middle].tolist()) == set(left.tolist())
    found = rows._summed(0, middle)
    for f in range(2):
        for b in (0, 50, 100):
            own = [i for i in left if bins[i, f] == b]
            for k, value in enumerate((rows.g, rows.h, np.ones(n, int))):
                assert int(found[k, f, b]) == sum(int(value[i]) * int(weight[i]) for i in own)
