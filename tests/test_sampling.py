"""Exact selections, splits and rebalancing."""

from __future__ import annotations

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.functions import hashing
from footfall.operators import assemble, neighbours, ranking, rebalance, split

NEGATIVES, POSITIVES = 7146, 715


@pytest.fixture(scope="module")
def population(spark):
    """The published training counts."""
    label = (F.col("id") < POSITIVES).cast("int")
    return spark.range(NEGATIVES + POSITIVES).select(
        F.col("id").alias("user_id"), (F.col("id") % 97).alias("item_id"), (F.col("id") % 7).alias("item_category"),
        label.alias("label"), (F.col("id") % 13).alias("a"), (F.col("id") % 5).alias("b"),
    )


def _counts(df):
    return {r.label: r["count"] for r in df.groupBy("label").count().collect()}


@pytest.mark.parametrize(("ratio", "want"), [(0.3, 2143), (0.5, 3573), (0.8, 5716), (1.0, 7146)])
def test_oversampling_counts(population, ratio, want):
    assert _counts(rebalance.oversample(population, ratio)) == {0: NEGATIVES, 1: want}


@pytest.mark.parametrize(("ratio", "want"), [(0.3, 2383), (0.5, 1430), (0.8, 893), (1.0, 715)])
def test_undersampling_counts(population, ratio, want):
    kept = rebalance.undersample(population, ratio)
    assert _counts(kept) == {0: want, 1: POSITIVES}
    assert kept.select(*assemble.ROW).distinct().count() == want + POSITIVES


def test_undersampling_ratio_zero_keeps_all(population):
    assert rebalance.undersample(population, 0) is population


def test_oversampling_already_there(population):
    assert rebalance.oversample(population, 0.01) is population


def test_smote_counts(population):
    made = rebalance.smote(population, ["a", "b"], 0.5)
    assert _counts(made) == {0: NEGATIVES, 1: 3573}


def test_smote_refuses(population):
    with pytest.raises(ValueError):
        rebalance.smote(population, ["a"], 0.01)
    with pytest.raises(ValueError):
        rebalance.smote(population.where("label = 0 or user_id < 5"), ["a"], 0.5)


def test_rank_is_the_md5_order(population):
    ranked = ranking.seeded_rank(population, 42, assemble.ROW, "rank", ["label"])
    rows = ranked.withColumn("o", hashing.digest(42, *assemble.ROW)).collect()
    for label in (0, 1):
        ordered = sorted((r for r in rows if r.label == label), key=lambda r: (r.o, r.user_id))
        assert [r["rank"] for r in ordered] == list(range(1, len(ordered) + 1))


def test_take_is_exact(population):
    for n in (0, 1, 100, NEGATIVES + POSITIVES, 10**9):
        took = ranking.seeded_take(population, "s", assemble.ROW, F.lit(n)).count()
        assert took == min(n, NEGATIVES + POSITIVES)


def test_too_few_negatives_fail_unless_allowed(spark, population):
    few = population.where("label = 1 or user_id < 800")
    with pytest.raises(Exception, match="negatives wanted: 7150, available: 85"):
        assemble.sample_negatives(few, 10).collect()
    assert _counts(assemble.sample_negatives(few, 10, allow_fewer=True)) == {0: 85, 1: POSITIVES}
    report = assemble.sampling_report(few).first()
    assert (report.wanted, report.available, report.taken) == (7150, 85, 85)
    assert _counts(assemble.sample_negatives(population, 5)) == {0: 5 * POSITIVES, 1: POSITIVES}


def test_split_sizes_match_the_published_ones(spark):
    rows = spark.range(11231).select(
        F.col("id").alias("user_id"), F.lit(1).alias("item_id"), F.lit(1).alias("item_category"),
        (F.col("id") < 1021).cast("int").alias("label"),
    )
    cut = split.stratified_split(rows)
    counts = {(r.split, r.label): r["count"] for r in cut.groupBy("split", "label").count().collect()}
    assert (counts["train", 0], counts["train", 1]) == (7146, 715)
    assert sum(counts.values()) == 11231
    assert cut.select("user_id").distinct().count() == 11231
    val, test = (sum(v for (s, _), v in counts.items() if s == part) for part in ("val", "test"))
    assert (val, test) == (2246, 1124)


def test_shuffle_keeps_rows(population):
    shuffled = assemble.shuffle(population)
    assert shuffled.count() == population.count()
    first = [r.user_id for r in shuffled.limit(20).collect()]
    assert first != sorted(first)
    assert first == [r.user_id for r in assemble.shuffle(population).limit(20).collect()]


def _brute(points, k):
    out = {}
    for vid, x, _ in points:
        d = sorted((sum((a - b) ** 2 for a, b in zip(x, y)), o) for o, y, _ in points if o != vid)
        out[vid] = d[:k]
    return out


@pytest.mark.parametrize("block_rows", [7, 50, 1000])
def test_neighbours_against_brute_force(spark, block_rows):
    rng = random.Random(1)
    rows = [(f"p{i:03d}", [float(rng.randint(0, 30)), float(rng.randint(0, 4)), rng.random()], 1) for i in range(300)]
    points = spark.createDataFrame(rows, "vid string, x array<double>, copies long")
    found = neighbours.nearest(points, 3, 5, block_rows).collect()
    have = {v: [] for v, _, _ in rows}
    for r in sorted(found, key=lambda r: r.place):
        have[r.vid].append((r.d2, r.other))
    assert have == _brute(rows, 5)


def test_neighbours_when_a_third_shares_the_main_axis(spark):
    """Many points at one place of the axis that orders the blocks."""
    rng = random.Random(2)
    rows = [(f"p{i:03d}", [1000.0 if i % 3 == 0 else float(rng.randint(0, 999)), rng.random()], 1) for i in range(120)]
    points = spark.createDataFrame(rows, "vid string, x array<double>, copies long")
    have = {v: [] for v, _, _ in rows}
    for r in sorted(neighbours.nearest(points, 2, 3, 10).collect(), key=lambda r: r.place):
        have[r.vid].append((r.d2, r.other))
    assert have == _brute(rows, 3)


def test_neighbours_of_few_points(spark):
    points = spark.createDataFrame([("a", [0.0], 1), ("b", [1.0], 1)], "vid string, x array<double>, copies long")
    assert {(r.vid, r.other) for r in neighbours.nearest(points, 1, 5).collect()} == {("a", "b"), ("b", "a")}


def test_neighbours_with_many_dimensions_and_ties(spark):
    """Whole numbers in six dimensions: equal distances everywhere, cells cut along several of them."""
    rng = random.Random(4)
    rows = [(f"p{i:03d}", [float(rng.randint(0, 3)) for _ in range(5)] + [float(i)], 1) for i in range(400)]
    points = spark.createDataFrame(rows, "vid string, x array<double>, copies long")
    have = {v: [] for v, _, _ in rows}
    for r in sorted(neighbours.nearest(points, 6, 4, 20).collect(), key=lambda r: r.place):
        have[r.vid].append((r.d2, r.other))
    assert have == _brute(rows, 4)


def test_visited_share_falls_as_rows_grow(spark):
    """More points lie closer together: a cell meets a smaller share of the others."""
    rng = np.random.default_rng(5)

    def share(n):
        rows = [(f"p{i}", [float(v) for v in rng.random(3)], 1) for i in range(n)]
        return neighbours.visited_share(spark.createDataFrame(rows, "vid string, x array<double>, copies long"), 3, 5, 16)

    few, many = share(256), share(4096)
    assert many < 0.5 * few


@pytest.mark.parametrize("sample, least", [(1 << 16, 32), (128, 4), (40, 2)])
def test_cells_planned_from_a_draw(spark, sample, least):
    """Whatever the draw, no cell is overfull, none is lost, boxes hold their points and neighbours are exact."""
    rng = np.random.default_rng(8)
    # whole numbers and eighths: squares sum without rounding
    rows = [(f"p{i:04d}", [*(float(round(20 * v)) for v in rng.normal(size=2) ** 3), i / 8], 1) for i in range(700)]
    points = spark.createDataFrame(rows, "vid string, x array<double>, copies long")
    placed, nodes = neighbours.cells(points, 3, 20, sample, least)
    at = {r.vid: r.cell for r in placed.collect()}
    boxes = {r.node: r for r in nodes.collect()}
    assert len(at) == placed.count() == 700
    sizes = collections.Counter(at.values())
    assert max(sizes.values()) <= 20 and {n for n, b in boxes.items() if b.leaf} == set(sizes)
    for vid, x, _ in rows:
        for upto in range(1, len(at[vid]) + 1):
            box = boxes[at[vid][:upto]]
            assert all(lo <= v <= hi for lo, v, hi in zip(box.low, x, box.high))
    have = {v: [] for v, _, _ in rows}
    for r in sorted(neighbours.nearest(points, 3, 4, 20, sample, least).collect(), key=lambda r: r.place):
        have[r.vid].append((r.d2, r.other))
    assert have == _brute(rows, 4)


def test_writes_do_not_follow_the_depth_of_the_cells(spark, monkeypatch):
    """Cells of 256 and of 8 rows, four and nine cuts deep, take the same number of writes."""
    rng = np.random.default_rng(9)
    rows = [(f"p{i}", [float(v) for v in rng.random(2)], 1) for i in range(4096)]
    points = spark.createDataFrame(rows, "vid string, x array<double>, copies long")
    written, write = [], neighbours.materialise
    monkeypatch.setattr(neighbours, "materialise", lambda df, name, by=None: written.append(name) or write(df, name, by))
    found = []
    for block_rows in (256, 8):
        written.clear()
        _, nodes = neighbours.cells(points, 2, block_rows)
        found.append((list(written), nodes.agg(F.max(F.length("node"))).first()[0]))
    (shallow, few), (deep, many) = found
    assert shallow == deep and shallow.count("cells") == 1 and many >= few + 5


def test_copies_are_their_own_neighbours(spark):
    """A third of the points are copies of one: they cost one row, and interpolate to themselves."""
    rows = [(i, 0, 0, 1, 5.0 if i < 20 else float(i), 1.0) for i in range(60)]
    rows += [(100 + i, 0, 0, 0, 0.0, 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, item_category long, label int, a double, b double")
    x, vid = rebalance._point(["a", "b"])
    ranked = df.where("label = 1").select(x.alias("x"), vid.alias("vid"))
    points = neighbours.distinct_points(ranked)
    assert points.count() == 41
    lists = {tuple(r.x): r.near for r in rebalance.neighbour_lists(points, 2, 5, 10).join(points, "vid").collect()}
    assert lists[(5.0, 1.0)] == [[5.0, 1.0]] * 5
    assert lists[(20.0, 1.0)][:2] == [[21.0, 1.0], [22.0, 1.0]]
    made = rebalance.smote(df, ["a", "b"], 0.5).where("label = 1").count()
    assert made == 100


def test_smote_points_lie_between(population):
    made = rebalance.smote(population, ["a", "b"], 0.3)
    bounds = made.where("label = 1").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert list(bounds) == [0.0, 12.0, 0.0, 4.0]


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    values = sorted({round(float(v), 3) for v in rng.random(500)})
    rows = [(v, int(rng.integers(1, 9))) for v in values]
    df = spark.createDataFrame(rows, "v double, n long").repartition(5)
    up = {r.v: r.cum_n for r in ranking.running_totals(df, ["v"], ["n"]).collect()}
    assert up == dict(zip(values, itertools.accumulate(n for _, n in rows)))
    down = {r.v: r.cum_n for r in ranking.running_totals(df, ["v"], ["n"], descending=True).collect()}
    assert down == dict(zip(reversed(values), itertools.accumulate(n for _, n in reversed(rows))))


def test_dense_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "s string")
    assert {r.s: r.code for r in ranking.dense_codes(df, "s").collect()} == {"a": 0, "b": 1, "c": 2}


def test_ranks_of_many_strata_do_not_go_through_the_driver(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 40).alias("part"))
    ranked = ranking.seeded_rank(rows, 7, ["id"], "place", ["part"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ShuffledHashJoin" in plan
    # the rows are dealt once, for the join and for their numbers; the buckets' sizes before and after their totals
    assert len([line for line in plan.split("\n") if "Exchange hashpartitioning(part" in line and "_bucket" in line]) == 3
    places = {}
    for r in ranked.collect():
        places.setdefault(r.part, []).append(r.place)
    assert len(places) == 40 and all(sorted(p) == list(range(1, 76)) for p in places.values())
