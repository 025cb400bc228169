"""Sources and sinks, joins, set operations, ranks and aggregates, each over the whole log."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.catalog import sql
from footfall.catalog.registry import AS_OF, TRAIN_AS_OF, log, matrices, open_log, prepared, query
from footfall.functions import hashing, timeparts
from footfall.operators import assemble, features, history, joins, models, ranking, rollup, selection, variants
from footfall.operators.rollup import of_type
from footfall.schema import BUY, CART, CATEGORY_TABLE, FAVOURITE, ITEM_TABLE, SEED, VIEW
from footfall.session import scratch_path
from footfall.sources import tables
from footfall.sources.log import read_log, read_log_csv, read_log_csv_checked, write_log, write_log_csv

# --- Sources and sinks ------------------------------------------------------------------------------

_LOG_ROWS = sql.with_(sql.LOG, "SELECT user_id, item_id, item_category, behavior_type, time FROM log")


@query("s1_read_csv_log", _LOG_ROWS)
def _s1(spark, sf):
    path = scratch_path(spark, "log-csv")
    write_log_csv(log(spark, sf), path)
    return read_log_csv(spark, path)


# The log as lines of text with planted faults, by the last digits of user + item.
_FAULTY = f"""{sql.LOG},
lines AS (SELECT *, (user_id + item_id) % 50 AS f, strftime(time, '%Y-%m-%d %H') AS hour FROM log),
faulty AS (SELECT *, CASE f WHEN 0 THEN 'x' WHEN 1 THEN '' ELSE user_id::VARCHAR END || ',' ||
    CASE f WHEN 2 THEN '' ELSE item_id::VARCHAR END || ',' || item_category || ',' ||
    CASE f WHEN 4 THEN '9' ELSE behavior_type::VARCHAR END || ',' ||
    CASE f WHEN 3 THEN '2024-02-31 05' ELSE hour END AS line,
  CASE f WHEN 0 THEN 'malformed' WHEN 1 THEN 'no user' WHEN 2 THEN 'no item' WHEN 3 THEN 'no time'
    WHEN 4 THEN 'unknown behaviour' END AS reason FROM lines)"""


def _read_faulty(spark, sf):
    """(good rows, path of the quarantine) of the log with planted faults."""
    rows, fault = log(spark, sf), F.pmod(F.col("user_id") + F.col("item_id"), F.lit(50))
    text = {c: F.col(c).cast("string") for c in ("user_id", "item_id", "item_category", "behavior_type")}
    path, quarantine = scratch_path(spark, "log-faulty"), scratch_path(spark, "quarantine")
    rows.select(
        F.when(fault == 0, "x").when(fault != 1, text["user_id"]).alias("user_id"),
        F.when(fault != 2, text["item_id"]).alias("item_id"), text["item_category"].alias("item_category"),
        F.when(fault == 4, "9").otherwise(text["behavior_type"]).alias("behavior_type"),
        F.when(fault == 3, "2024-02-31 05").otherwise(timeparts.format_hour("time")).alias("time"),
    ).write.option("header", True).csv(path)
    return read_log_csv_checked(spark, path, quarantine, most=0.5), quarantine


@query("s1_good_lines", sql.with_(
    _FAULTY, "SELECT user_id, item_id, item_category, behavior_type, time FROM faulty WHERE reason IS NULL"))
def _s1_good(spark, sf):
    return _read_faulty(spark, sf)[0]


@query("s1_quarantined_lines", sql.with_(_FAULTY, "SELECT line, reason FROM faulty WHERE reason IS NOT NULL"))
def _s1_bad(spark, sf):
    return spark.read.parquet(_read_faulty(spark, sf)[1])


@query("s2_write_log_table", _LOG_ROWS)
def _s2(spark, sf):
    path = scratch_path(spark, "log")
    write_log(log(spark, sf), path)
    write_log(log(spark, sf), path)
    return read_log(spark, path)


@query("s3_replace_feature_table", sql.with_(f"{sql.history()},\n{sql.categories()}", "SELECT * FROM cat_f"))
def _s3(spark, sf):
    path = scratch_path(spark, "category_feature")
    tables.write_table(features.category_features(open_log(spark, sf, TRAIN_AS_OF)), path, CATEGORY_TABLE)
    tables.write_table(features.category_features(open_log(spark, sf)), path, CATEGORY_TABLE)
    return tables.read_table(spark, path, CATEGORY_TABLE)


@query("s4_read_feature_table", sql.with_(f"{sql.history()},\n{sql.items()}", "SELECT * FROM item_f"))
def _s4(spark, sf):
    path = scratch_path(spark, "item_feature")
    tables.write_table(features.item_features(open_log(spark, sf)), path, ITEM_TABLE)
    return tables.read_table(spark, path, ITEM_TABLE)


@query("s5_read_projected_until", sql.with_(sql.history(), "SELECT user_id, behavior_type FROM h"))
def _s5(spark, sf):
    path = scratch_path(spark, "log")
    write_log(log(spark, sf), path)
    return read_log(spark, path, ["user_id", "behavior_type"], until=AS_OF)


@query("s6_write_csv_table", sql.with_(sql.full_table(), "SELECT * FROM ft"))
def _s6(spark, sf):
    full = prepared(spark, sf).table
    path = scratch_path(spark, "feature_table-csv")
    tables.write_csv(full, path)
    return tables.read_csv(spark, path, full.schema)


@query("s7_read_csv_split", sql.with_(sql.full_split(), "SELECT * FROM valid"))
def _s7(spark, sf):
    val = prepared(spark, sf).splits.val
    path = scratch_path(spark, "val-csv")
    tables.write_csv(val, path)
    return tables.read_csv(spark, path, val.schema)


@query("s8_metrics_table", sql.with_(sql.LOG, """
SELECT unnest(['Views', 'Buys']) AS "Metric", unnest([v, b]) AS "Value" FROM (
  SELECT count(*) FILTER (WHERE behavior_type = 1)::DOUBLE AS v, count(*) FILTER (WHERE behavior_type = 4)::DOUBLE AS b
  FROM log)"""))
def _s8(spark, sf):
    row = log(spark, sf).agg(F.count_if(of_type(VIEW)).alias("v"), F.count_if(of_type(BUY)).alias("b"))
    path = scratch_path(spark, "metrics")
    tables.write_metrics(tables.metrics_long(row, {"v": "Views", "b": "Buys"}), path)
    return spark.read.schema("Metric string, Value double").option("header", True).csv(path)


@query("s9_save_and_load_model", sql.with_(sql.full_split(), "SELECT count(*) AS rows, 0.0::DOUBLE AS gap FROM valid"))
def _s9(spark, sf):
    """Scores of a model and of the same model read back: the largest gap is 0."""
    m = matrices(spark, sf)
    model = models.fit_logistic(m.train, m.train.count())
    path = scratch_path(spark, "model")
    tables.save_model(model, path)
    again = tables.load_model(LogisticRegressionModel, path)
    val = m.val.select(*assemble.ROW, "label", "features")
    a = models.score(model, val).select(*assemble.ROW, F.col("score").alias("a"))
    b = models.score(again, val).select(*assemble.ROW, F.col("score").alias("b"))
    return a.join(b, assemble.ROW).agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("gap"))


@query("s10_history_not_empty", sql.with_(sql.history(), "SELECT max(t) AS latest FROM h"))
def _s10(spark, sf):
    rows = history.require_nonempty(history.before(log(spark, sf, AS_OF), AS_OF))
    return spark.range(1).select(history.last_moment(rows).alias("latest"))


@query("s10_counts_while_written", sql.with_(sql.history(), """
SELECT count(*) AS rows, count(*) FILTER (WHERE behavior_type = 4) AS buys,
  count(*) FILTER (WHERE item_category IS NULL) AS gaps, max(t) AS latest FROM h"""))
def _s10_counted(spark, sf):
    """The report on the history comes out of the job that writes it."""
    found = tables.write_counted(
        history.before(log(spark, sf, AS_OF), AS_OF), scratch_path(spark, "history"), rows=F.count(F.lit(1)),
        buys=F.count_if(of_type(BUY)), gaps=F.count_if(F.col("item_category").isNull()),
        latest=F.max(timeparts.epoch_seconds("time")),
    )
    return spark.createDataFrame(
        [tuple(found[n] for n in ("rows", "buys", "gaps", "latest"))], "rows long, buys long, gaps long, latest long")


# --- Joins and set operations -----------------------------------------------------------------------


@query("j1_left_join_two_keys", sql.with_(f"{sql.LOG},\n{sql.labelled(AS_OF, 1)}", """
SELECT user_id, item_id, item_category, lbl.label FROM cand LEFT JOIN lbl USING (user_id, item_id)"""))
def _j1(spark, sf):
    rows = log(spark, sf)
    bought = assemble.labels(rows, AS_OF).withColumn("label", F.lit(1))
    return assemble.candidates(rows, AS_OF).join(bought, assemble.PAIR, "left")


_J2_COLUMNS = ["user_id", "item_id", "item_category", "label", "total_views", "total_pv_x", "total_pv_y",
               "buy_count_x", "buy_count_y", "buy_rate_x", "buy_rate_y", "buy_rate"]


_J2 = sql.with_(
    ",\n".join([sql.history(), sql.users(), sql.items(), sql.categories(), sql.labelled(AS_OF, 1)])
    + ",\nbase AS (SELECT * FROM lab),\n" + sql.joined(), f"SELECT {', '.join(_J2_COLUMNS)} FROM ft")


@query("j2_three_lookups", _J2)
def _j2(spark, sf):
    h = open_log(spark, sf)
    base = assemble.labelled(log(spark, sf), AS_OF)
    users = features.user_features(h, ["total_views", "buy_rate"])
    items = features.item_features(h, ["total_pv", "buy_count", "buy_rate"])
    categories = features.category_features(h, ["total_pv", "buy_count", "buy_rate"])
    return assemble.feature_table(base, users, items, categories).select(*_J2_COLUMNS)


@query("j2_bucketed_lookups", _J2)
def _j2_bucketed(spark, sf):
    """Feature tables kept in buckets of their key: joins leave them where they lie."""
    h = open_log(spark, sf)
    built = {
        "user_id": features.user_features(h, ["total_views", "buy_rate"]),
        "item_id": features.item_features(h, ["total_pv", "buy_count", "buy_rate"]),
        "item_category": features.category_features(h, ["total_pv", "buy_count", "buy_rate"]),
    }
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = []
    for key, table in built.items():
        name = f"footfall_{key}_{uuid.uuid4().hex}"
        tables.write_bucketed(table, name, scratch_path(spark, name), key, buckets)
        kept.append(spark.table(name))
    return assemble.feature_table(assemble.labelled(log(spark, sf), AS_OF), *kept).select(*_J2_COLUMNS)


@query("j3_inner_join_of_aggregates", sql.with_(sql.history(), """
SELECT item_id, a.n::DOUBLE / b.n AS growth
FROM (SELECT item_id, count(*) AS n FROM h, ref WHERE behavior_type = 1 AND t >= ref_t - 259200 GROUP BY item_id) a
JOIN (SELECT item_id, count(*) AS n FROM h, ref WHERE behavior_type = 1 AND t >= ref_t - 604800 GROUP BY item_id) b
USING (item_id)"""))
def _j3(spark, sf):
    h = open_log(spark, sf)
    views = h.rows.where(of_type(VIEW))
    three = views.where(h.within(3)).groupBy("item_id").agg(F.count(F.lit(1)).alias("a"))
    seven = views.where(h.within(7)).groupBy("item_id").agg(F.count(F.lit(1)).alias("b"))
    return three.join(seven, "item_id").select("item_id", (F.col("a") / F.col("b")).alias("growth"))


@query("j4_anti_join_not_exists", sql.with_(sql.LOG, """
SELECT user_id, item_id, time FROM log x WHERE behavior_type = 1 AND NOT EXISTS (
  SELECT 1 FROM log y WHERE y.user_id = x.user_id AND y.item_id = x.item_id AND y.behavior_type = 4)"""))
def _j4(spark, sf):
    rows = log(spark, sf)
    views = rows.where(of_type(VIEW)).select("user_id", "item_id", "time")
    return joins.anti(views, rows.where(of_type(BUY)), assemble.PAIR)


@query("j5_anti_join_left_null", sql.with_(sql.history(), """
SELECT v.user_id, v.item_id FROM (SELECT DISTINCT user_id, item_id FROM h WHERE behavior_type = 3) v
LEFT JOIN (SELECT DISTINCT user_id, item_id FROM h WHERE behavior_type = 4) b
ON v.user_id = b.user_id AND v.item_id = b.item_id WHERE b.user_id IS NULL"""))
def _j5(spark, sf):
    rows = history.before(log(spark, sf, AS_OF), AS_OF)
    carted = rows.where(of_type(CART)).select(*assemble.PAIR).distinct()
    return joins.anti(carted, rows.where(of_type(BUY)), assemble.PAIR)


@query("j6_argmax_with_ties", sql.with_(sql.LOG, """
SELECT item_id, hour, cnt FROM (
  SELECT item_id, hour(time)::INTEGER AS hour, count(*) AS cnt,
         rank() OVER (PARTITION BY item_id ORDER BY count(*) DESC) AS r
  FROM log GROUP BY item_id, hour(time)) WHERE r = 1"""))
def _j6(spark, sf):
    return joins.argmax_ties(variants.hour_counts(log(spark, sf), "item_id"), "item_id", "cnt")


@query("j7_outer_alignment", sql.with_(sql.history(), """
SELECT item_id, a.n AS views, b.n AS carts, c.n AS buys
FROM (SELECT item_id, count(*) AS n FROM h WHERE behavior_type = 1 GROUP BY item_id) a
FULL JOIN (SELECT item_id, count(*) AS n FROM h WHERE behavior_type = 3 GROUP BY item_id) b USING (item_id)
FULL JOIN (SELECT item_id, count(*) AS n FROM h WHERE behavior_type = 4 GROUP BY item_id) c USING (item_id)"""))
def _j7(spark, sf):
    aligned = features.item_features(open_log(spark, sf), ["total_pv", "cart_count", "buy_count"])
    shown = aligned.where(F.coalesce("total_pv", "cart_count", "buy_count").isNotNull())
    return shown.withColumnsRenamed({"total_pv": "views", "cart_count": "carts", "buy_count": "buys"})


@query("j8_bought_items_of_viewers", sql.with_(sql.history(), """
SELECT item_id, count(*) FILTER (WHERE n_buy > 0) AS buyers
FROM prs GROUP BY item_id HAVING count(*) FILTER (WHERE n_view > 0) > 0"""))
def _j8(spark, sf):
    sets = rollup.not_bought(rollup.pairs(open_log(spark, sf).rows), "item_id")
    return sets.where(F.col("d_view") > 0).select("item_id", "buyers")


@query("j9_set_difference", sql.with_(sql.history(), """
SELECT user_id, len(list_filter(v, lambda x: NOT list_contains(b, x)))::BIGINT AS carted_not_bought
FROM (SELECT user_id, coalesce(list(DISTINCT item_id) FILTER (WHERE behavior_type = 3), []) AS v,
             coalesce(list(DISTINCT item_id) FILTER (WHERE behavior_type = 4), []) AS b FROM h GROUP BY user_id)"""))
def _j9(spark, sf):
    sets = rollup.not_bought(rollup.pairs(open_log(spark, sf).rows), "user_id")
    return sets.select("user_id", F.col("d_cart_not").alias("carted_not_bought"))


@query("j10_union_all", sql.with_(sql.LOG, """
SELECT user_id, item_id FROM log WHERE behavior_type = 2 UNION ALL
SELECT user_id, item_id FROM log WHERE behavior_type = 3"""))
def _j10(spark, sf):
    rows = log(spark, sf)
    return rows.where(of_type(FAVOURITE)).select(*assemble.PAIR).unionByName(
        rows.where(of_type(CART)).select(*assemble.PAIR)
    )


@query("j11_union_of_classes", sql.with_(sql.full_table(), """
SELECT user_id, item_id, item_category, label FROM ft WHERE label = 1 UNION ALL
SELECT user_id, item_id, item_category, label FROM ft WHERE label = 0"""))
def _j11(spark, sf):
    rows = prepared(spark, sf).table.select(*assemble.ROW, "label")
    return rows.where("label = 1").unionByName(rows.where("label = 0"))


# --- Sorts, limits, ranks ---------------------------------------------------------------------------


@query("k1_min_rank", sql.with_(sql.history(), """
SELECT item_id, uv, rank() OVER (ORDER BY uv DESC) AS place
FROM (SELECT item_id, count(*) AS uv FROM prs GROUP BY item_id)"""))
def _k1(spark, sf):
    uv = features.item_features(open_log(spark, sf), ["uv"])
    return ranking.min_rank_desc(uv, "uv", "place")


@query("k2_first_row_per_group", sql.with_(sql.LOG, """
SELECT item_category, hr AS hour FROM (
  SELECT item_category, hour(time)::INTEGER AS hr,
         row_number() OVER (PARTITION BY item_category ORDER BY count(*) DESC, hour(time)) AS rn
  FROM log GROUP BY item_category, hour(time)) WHERE rn = 1"""))
def _k2(spark, sf):
    counts = variants.hour_counts(log(spark, sf), "item_category")
    return counts.groupBy("item_category").agg(rollup.peak("cnt").alias("hour"))


@query("k3_row_number", sql.with_(sql.LOG, """
SELECT user_id, item_category, cnt FROM (
  SELECT user_id, item_category, count(*) AS cnt,
         row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item_category) AS rn
  FROM log GROUP BY user_id, item_category) WHERE rn = 1"""))
def _k3(spark, sf):
    counts = log(spark, sf).groupBy("user_id", "item_category").agg(F.count(F.lit(1)).alias("cnt"))
    best = W.partitionBy("user_id").orderBy(F.desc("cnt"), F.asc("item_category"))
    return counts.withColumn("rn", F.row_number().over(best)).where("rn = 1").drop("rn")


@query("k4_order_and_take_one", sql.with_(sql.LOG, """
SELECT hour(time)::INTEGER AS hour, count(*) AS cnt FROM log WHERE behavior_type = 4
GROUP BY hour(time) ORDER BY cnt DESC, hour LIMIT 1"""))
def _k4(spark, sf):
    counts = log(spark, sf).where(of_type(BUY)).groupBy(F.hour("time").alias("hour")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counts.orderBy(F.desc("cnt"), "hour").limit(1)


_VARIANCES = f"""
SELECT unnest([{', '.join(f"'{c}'" for c in sql.input_columns())}]) AS feature,
       unnest([{', '.join(f'round(var_pop({c}::DOUBLE), 4)' for c in sql.input_columns())}]) AS importance
FROM train"""


def _spread(spark, sf):
    """A feature-sized table to sort: rounded variances stand in for importances."""
    train = prepared(spark, sf).splits.train
    return selection.variances(train, selection.inputs(train)).select(
        "feature", F.round("variance", 4).alias("importance")
    )


@query("k5_sort_by_importance", sql.with_(f"{sql.full_split()},\nimp AS ({_VARIANCES})", """
SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature)::INTEGER AS place FROM imp"""))
def _k5(spark, sf):
    return selection.cumulative_share(_spread(spark, sf)).select("feature", "importance", "place").orderBy("place")


@query("k6_running_share", sql.with_(f"{sql.full_split()},\nimp AS ({_VARIANCES})", """
SELECT feature, round(sum(importance) OVER (ORDER BY importance DESC, feature) / sum(importance) OVER (), 6) AS share
FROM imp"""))
def _k6(spark, sf):
    shares = selection.cumulative_share(_spread(spark, sf))
    return shares.select("feature", F.round("cumulative_share", 6).alias("share"))


@query("k7_random_rows", sql.with_(sql.history(), f"""
SELECT user_id FROM (SELECT DISTINCT user_id FROM h) ORDER BY {sql.order_by(SEED, 'user_id')} LIMIT 3"""))
def _k7(spark, sf):
    keys = open_log(spark, sf).rows.select("user_id").distinct()
    return keys.orderBy(hashing.digest(SEED, "user_id"), "user_id").limit(3)


@query("k8_shuffle", sql.with_(f"{sql.LOG},\n{sql.labelled(AS_OF, 1)}", f"""
SELECT user_id, item_id, item_category, label, row_number() OVER (ORDER BY {sql.order_by(SEED, *sql.ROW)}) AS place
FROM lab"""))
def _k8(spark, sf):
    return ranking.seeded_rank(assemble.labelled(log(spark, sf), AS_OF), SEED, assemble.ROW, "place")


# --- Aggregates -------------------------------------------------------------------------------------


@query("a1_group_count", sql.with_(sql.LOG, "SELECT item_category, count(*) AS count FROM log GROUP BY item_category"))
def _a1(spark, sf):
    return log(spark, sf).groupBy("item_category").count()


@query("a2_group_count_two_keys", sql.with_(sql.LOG, """
SELECT user_id, hour(time)::INTEGER AS hour, count(*) AS cnt FROM log GROUP BY user_id, hour(time)"""))
def _a2(spark, sf):
    return variants.hour_counts(log(spark, sf), "user_id")


@query("a3_aggregate_of_aggregate", sql.with_(sql.LOG, """
SELECT item_id, max(n) AS most, count(*) FILTER (WHERE n > 1)::DOUBLE / count(*) AS share_repeated
FROM (SELECT item_id, user_id, count(*) AS n FROM log GROUP BY item_id, user_id) GROUP BY item_id"""))
def _a3(spark, sf):
    return rollup.pairs(log(spark, sf)).groupBy("item_id").agg(
        F.max("n_all").alias("most"),
        (F.count_if(F.col("n_all") > 1) / F.count(F.lit(1))).alias("share_repeated"),
    )


@query("a4_distinct_count", sql.with_(sql.LOG, """
SELECT item_category, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM log GROUP BY item_category"""))
def _a4(spark, sf):
    """Two levels of grouping per column: the first spreads a hot category over its distinct values."""
    rows = log(spark, sf)
    counted = [
        rows.select("item_category", key).distinct().groupBy("item_category").agg(F.count(F.lit(1)).alias(name))
        for key, name in (("user_id", "users"), ("item_id", "items"))
    ]
    return counted[0].join(counted[1], "item_category")


@query("a5_first_and_last", sql.with_(sql.LOG, """
SELECT item_id, min(time) AS first, max(time) AS last, max(time) FILTER (WHERE behavior_type = 4) AS last_buy
FROM log GROUP BY item_id"""))
def _a5(spark, sf):
    return log(spark, sf).groupBy("item_id").agg(
        F.min("time").alias("first"), F.max("time").alias("last"),
        F.max(F.when(of_type(BUY), F.col("time"))).alias("last_buy"),
    )


@query("a6_global_max", sql.with_(sql.history(), "SELECT max(time) AS latest FROM h"))
def _a6(spark, sf):
    return history.before(log(spark, sf, AS_OF), AS_OF).agg(F.max("time").alias("latest"))


@query("a7_distinct_ids_per_group", sql.with_(sql.LOG, """
SELECT DISTINCT user_id, item_id FROM log WHERE behavior_type = 4"""))
def _a7(spark, sf):
    """A set per user as rows of the pair table, never as one growing array."""
    return rollup.pairs(log(spark, sf)).where(F.col("n_buy") > 0).select("user_id", "item_id")


@query("a8_conditional_aggregate", sql.with_(sql.history(), """
SELECT item_id, count(*) FILTER (WHERE behavior_type = 1 AND t >= ref_t - 259200) AS v3,
  count(*) FILTER (WHERE behavior_type = 1 AND t >= ref_t - 604800) AS v7 FROM h, ref GROUP BY item_id"""))
def _a8(spark, sf):
    return rollup.by_key(open_log(spark, sf), "item_id", hourly=False).select("item_id", "v3", "v7")


@query("a9_ratio_of_aggregates", sql.with_(sql.LOG, """
SELECT item_id, count(*)::DOUBLE / count(DISTINCT user_id) AS depth FROM log GROUP BY item_id"""))
def _a9(spark, sf):
    sets = rollup.not_bought(rollup.pairs(log(spark, sf)), "item_id")
    return sets.select("item_id", (F.col("rows_all") / F.col("partners")).alias("depth"))


@query("a10_column_statistics", sql.with_(f"{sql.history()},\n{sql.items()}", """
SELECT round(avg((total_pv IS NULL)::INT), 6) AS missing, round(var_pop(uv), 6) AS variance,
  round(corr(uv, interest_depth), 6) AS correlation, sum(uv)::BIGINT AS total FROM item_f"""))
def _a10(spark, sf):
    items = features.item_features(open_log(spark, sf), ["total_pv", "uv", "interest_depth"])
    return items.agg(
        F.round(F.avg(F.col("total_pv").isNull().cast("int")), 6).alias("missing"),
        F.round(F.var_pop("uv"), 6).alias("variance"),
        F.round(F.corr("uv", "interest_depth"), 6).alias("correlation"),
        F.sum("uv").alias("total"),
    )
