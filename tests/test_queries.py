"""Every query with SQL gives the SQL's rows; a few plans have the shape they should.

ORACLE_SF_DIR names the data; the smallest is the default, because all queries are run.
"""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as entry_point
from footfall.catalog import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_registry():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert {n for n in QUERIES if n not in ORACLE} == {"m12_grid_metrics", "m10_grid_losses", "m1_tree_nodes"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "user_id"
    assert df.count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(ORACLE) if n[0] in "uicv" and n not in ("p24_upper_triangle",)])
def test_feature_plans_stay_in_the_jvm(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    assert "Python" not in plan
    assert "ReadSchema" in plan


def test_cutoff_reaches_the_scan(spark):
    plan = _plan(QUERIES["u1_total_behavior"](spark, SF_DIR))
    assert "LessThan(ts" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_hot_user_is_split_in_the_lookup(spark):
    """A user with a third of the base: adaptive execution splits that partition of the join."""
    from pyspark.sql import functions as F

    from footfall.operators import joins

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        base = spark.range(0, 200_000, 1, 16).select(hot.alias("user_id"), F.md5(F.col("id").cast("string")).alias("x"))
        users = spark.range(200_000).select(F.col("id").alias("user_id"), F.lit(1).alias("n"))
        joined = joins.lookup(base, users, "user_id")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in _plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shared_folder(spark):
    """The folder the cluster names is used as it is; without one, the application keeps to one folder."""
    from types import SimpleNamespace

    from footfall.session import shared_folder

    assert shared_folder(spark) == shared_folder(spark)
    chosen = []
    context = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=chosen.append, master="spark://host:7077")
    conf = {"spark.checkpoint.dir": "hdfs://cluster/shared"}
    assert shared_folder(SimpleNamespace(conf=conf, sparkContext=context)) == "hdfs://cluster/shared"
    assert chosen == ["hdfs://cluster/shared"]
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        context.master = master
        with pytest.raises(RuntimeError):
            shared_folder(SimpleNamespace(conf={}, sparkContext=context))


def test_cleanup_removes_the_run_s_folder(spark, tmp_path, monkeypatch):
    from footfall import session

    # a folder of its own: the other tests' tables lie in the application's
    monkeypatch.setattr(session, "run_folder", lambda _: f"file://{tmp_path}/run")
    assert session.materialise(spark.range(3), "numbers").count() == 3
    assert (tmp_path / "run").is_dir()
    session.cleanup(spark)
    assert not (tmp_path / "run").exists()


def test_ranks_are_not_forced_into_a_broadcast(spark):
    from footfall.operators import ranking

    df = spark.createDataFrame([(i, i % 7) for i in range(50)], "item_id long, n long")
    ranked = ranking.min_rank_desc(df, "n", "place")
    assert "rightHint" not in ranked._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]
