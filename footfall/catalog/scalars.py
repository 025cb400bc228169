"""Projections, filters and scalar functions, each over the whole log or event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.catalog import sql
from footfall.catalog.registry import AS_OF, log, open_log, prepared, query, table
from footfall.functions import ratios, timeparts
from footfall.operators import features, history, reconcile, rollup, selection
from footfall.operators.rollup import of_type
from footfall.schema import AFTERNOON, BUY, CART, FAVOURITE, MORNING, NIGHT, NOT_INPUTS, VIEW


def _events(spark, sf):
    return table(spark, sf, "events")


@query("p1_parse_time", """
SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %H'), '%Y-%m-%d %H') AS time FROM events""")
def _p1(spark, sf):
    text = _events(spark, sf).select("event_id", timeparts.format_hour("ts").alias("text"))
    return text.select("event_id", timeparts.parse_hour("text").alias("time"))


@query("p2_format_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H') AS text FROM events")
def _p2(spark, sf):
    return _events(spark, sf).select("event_id", timeparts.format_hour("ts").alias("text"))


@query("p3_hour", "SELECT event_id, hour(ts)::INTEGER AS hour FROM events")
def _p3(spark, sf):
    return _events(spark, sf).select("event_id", F.hour("ts").alias("hour"))


@query("p4_hour_by_substring", """
SELECT event_id, substr(strftime(ts, '%Y-%m-%d %H'), 12, 2)::INTEGER AS hour FROM events""")
def _p4(spark, sf):
    text = timeparts.format_hour("ts")
    return _events(spark, sf).select("event_id", F.substring(text, 12, 2).cast("int").alias("hour"))


@query("p5_hour_text", "SELECT event_id, strftime(ts, '%H') AS hour FROM events")
def _p5(spark, sf):
    return _events(spark, sf).select("event_id", timeparts.hour_text("ts").alias("hour"))


@query("p6_zero_padded_hour", sql.with_(f"{sql.history()},\n{sql.items()}", """
SELECT item_id, lpad(peak_view_hour::VARCHAR, 2, '0') AS peak_view_hour FROM item_f"""))
def _p6(spark, sf):
    items = features.item_features(open_log(spark, sf), ["peak_view_hour"])
    return items.withColumn("peak_view_hour", F.lpad(F.col("peak_view_hour").cast("string"), 2, "0"))


@query("p7_cutoff", sql.with_(sql.history(), "SELECT user_id, item_id, item_category, behavior_type, time FROM h"))
def _p7(spark, sf):
    return history.before(log(spark, sf, AS_OF), AS_OF)


@query("p8_window_starts", sql.with_(sql.history(), """
SELECT strftime(max(time), '%Y-%m-%d %H') AS last, strftime(max(time) - INTERVAL 1 DAY, '%Y-%m-%d %H') AS d1,
  strftime(max(time) - INTERVAL 3 DAY, '%Y-%m-%d %H') AS d3, strftime(max(time) - INTERVAL 7 DAY, '%Y-%m-%d %H') AS d7
FROM h"""))
def _p8(spark, sf):
    last = history.before(log(spark, sf, AS_OF), AS_OF).agg(F.max("time").alias("last"))
    starts = {f"d{k}": F.col("last") - F.make_dt_interval(F.lit(k)) for k in (1, 3, 7)}
    return last.select(
        timeparts.format_hour("last").alias("last"),
        *[timeparts.format_hour(start).alias(name) for name, start in starts.items()],
    )


@query("p9_type_filter", sql.with_(sql.LOG, "SELECT user_id, item_id, time FROM log WHERE behavior_type = 4"))
def _p9(spark, sf):
    return log(spark, sf).where(of_type(BUY)).select("user_id", "item_id", "time")


@query("p10_type_membership", sql.with_(sql.LOG, """
SELECT user_id, item_id, behavior_type FROM log WHERE behavior_type IN (1, 2, 3)"""))
def _p10(spark, sf):
    rows = log(spark, sf).where(F.col("behavior_type").isin(VIEW, FAVOURITE, CART))
    return rows.select("user_id", "item_id", "behavior_type")


@query("p11_hour_bands", sql.with_(sql.LOG, """
SELECT user_id, time, CASE WHEN hour(time) BETWEEN 6 AND 13 THEN 'morning'
  WHEN hour(time) BETWEEN 14 AND 21 THEN 'afternoon' WHEN hour(time) >= 22 OR hour(time) < 6 THEN 'night' END AS band
FROM log"""))
def _p11(spark, sf):
    hour = F.hour("time")
    bands = {"morning": MORNING, "afternoon": AFTERNOON, "night": NIGHT}
    named = F.coalesce(*[F.when(timeparts.in_band(hour, b), F.lit(n)) for n, b in bands.items()])
    return log(spark, sf).select("user_id", "time", named.alias("band"))


@query("p12_projection", sql.with_(sql.LOG, "SELECT user_id, item_id, item_category FROM log"))
def _p12(spark, sf):
    return log(spark, sf).select("user_id", "item_id", "item_category")


@query("p13_drop_columns", sql.with_(sql.full_table(), f"SELECT {', '.join(sql.input_columns())} FROM ft"))
def _p13(spark, sf):
    return prepared(spark, sf).table.drop(*NOT_INPUTS)


@query("p14_cast_keys", sql.with_(sql.LOG, """
SELECT user_id::VARCHAR AS user_id, item_id::VARCHAR AS item_id, item_category::VARCHAR AS item_category,
  behavior_type::BIGINT AS behavior_type FROM log"""))
def _p14(spark, sf):
    text = {c: F.col(c).cast("string") for c in ("user_id", "item_id", "item_category")}
    return log(spark, sf).withColumns({**text, "behavior_type": F.col("behavior_type").cast("bigint")}).drop("time")


@query("p15_conditional_count", sql.with_(sql.LOG, """
SELECT user_id, count(CASE WHEN behavior_type = 1 THEN 1 END) AS views,
  sum(CASE WHEN behavior_type = 4 THEN 1 ELSE 0 END)::BIGINT AS buys FROM log GROUP BY user_id"""))
def _p15(spark, sf):
    return log(spark, sf).groupBy("user_id").agg(
        F.count_if(of_type(VIEW)).alias("views"), F.count_if(of_type(BUY)).alias("buys")
    )


@query("p16_null_safe_division", sql.with_(sql.history(), """
SELECT item_id, sum(n_buy)::DOUBLE / nullif(sum(n_view), 0) AS buys_per_view FROM prs GROUP BY item_id"""))
def _p16(spark, sf):
    sums = rollup.by_key(open_log(spark, sf), "item_id", hourly=False)
    return sums.select("item_id", ratios.filled_share(F.col("n_buy"), F.col("n_view")).alias("buys_per_view"))


@query("p17_zero_divisor_as_one", sql.with_(sql.history(), """
SELECT item_id, sum(n_buy)::DOUBLE / CASE WHEN sum(n_view) = 0 THEN 1 ELSE sum(n_view) END AS buys_per_view
FROM prs GROUP BY item_id"""))
def _p17(spark, sf):
    sums = rollup.by_key(open_log(spark, sf), "item_id", hourly=False)
    whole = ratios.zero_as_one(F.col("n_view"))
    return sums.select("item_id", ratios.ratio(F.col("n_buy"), whole).alias("buys_per_view"))


@query("p18_fill_missing", sql.with_(f"{sql.history()},\n{sql.items()}", """
SELECT item_id, coalesce(total_pv, 0) AS total_pv, coalesce(buy_rate, 0) AS buy_rate FROM item_f"""))
def _p18(spark, sf):
    return features.item_features(open_log(spark, sf), ["total_pv", "buy_rate"]).fillna(0)


def _spans(spark, sf):
    return log(spark, sf).groupBy("user_id").agg(F.min("time").alias("a"), F.max("time").alias("b"))


@query("p19_time_difference", sql.with_(sql.LOG, """
SELECT user_id, (epoch(max(time)) - epoch(min(time)))::BIGINT AS seconds,
  ((epoch(max(time)) - epoch(min(time)))::BIGINT)::DOUBLE / 3600 AS hours,
  ((epoch(max(time)) - epoch(min(time)))::BIGINT // 86400)::BIGINT AS days
FROM log GROUP BY user_id"""))
def _p19(spark, sf):
    seconds = timeparts.seconds_between(F.col("b"), F.col("a"))
    return _spans(spark, sf).select(
        "user_id", seconds.alias("seconds"), timeparts.hours(seconds).alias("hours"),
        timeparts.whole_days(seconds).alias("days"),
    )


@query("p20_julian_and_epoch_difference", sql.with_(sql.LOG, """
SELECT user_id, ((epoch(max(time)) - epoch(min(time)))::BIGINT)::DOUBLE / 86400 AS julian_days,
  (epoch(max(time)) - epoch(min(time)))::BIGINT AS epoch_seconds
FROM log GROUP BY user_id"""))
def _p20(spark, sf):
    seconds = timeparts.seconds_between(F.col("b"), F.col("a"))
    return _spans(spark, sf).select(
        "user_id", timeparts.days(seconds).alias("julian_days"), seconds.alias("epoch_seconds")
    )


@query("p21_distinct_rows", sql.with_(sql.LOG, "SELECT DISTINCT user_id, item_id, behavior_type FROM log"))
def _p21(spark, sf):
    return log(spark, sf).select("user_id", "item_id", "behavior_type").distinct()


@query("p22_constant_column", sql.with_(sql.LOG, """
SELECT DISTINCT user_id, item_id, 1 AS label FROM log WHERE behavior_type = 4"""))
def _p22(spark, sf):
    return log(spark, sf).where(of_type(BUY)).select("user_id", "item_id").distinct().withColumn("label", F.lit(1))


@query("p23_tolerance_equality", sql.with_(sql.history(), """
SELECT item_id, abs(sum(n_buy)::DOUBLE / sum(n_all) - sum(n_cart)::DOUBLE / sum(n_all)) AS gap,
  abs(sum(n_buy)::DOUBLE / sum(n_all) - sum(n_cart)::DOUBLE / sum(n_all)) < 1e-6 AS same
FROM prs GROUP BY item_id"""))
def _p23(spark, sf):
    sums = rollup.by_key(open_log(spark, sf), "item_id", hourly=False)
    a, b = (ratios.ratio(F.col(c), F.col("n_all")) for c in ("n_buy", "n_cart"))
    return sums.select("item_id", F.abs(a - b).alias("gap"), ratios.near(a, b).alias("same"))


_TRIANGLE = ["total_behavior", "total_views", "total_cart", "total_fav", "total_buy", "interest_concentration"]


@query("p24_upper_triangle", sql.with_(f"{sql.history()},\n{sql.users()}", " UNION ALL ".join(
    f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(abs(corr(coalesce({a}, 0), coalesce({b}, 0))), 6) AS corr FROM user_f"
    for i, a in enumerate(_TRIANGLE) for b in _TRIANGLE[i + 1:])))
def _p24(spark, sf):
    users = features.user_features(open_log(spark, sf), _TRIANGLE).fillna(0)
    return selection.correlations(users, _TRIANGLE).select("col_i", "col_j", F.round("corr", 6).alias("corr"))


@query("p25_label_frequency", sql.with_(sql.full_table(), "SELECT label, count(*) AS count FROM ft GROUP BY label"))
def _p25(spark, sf):
    return prepared(spark, sf).table.groupBy("label").count()


@query("p26_top_value_counts", sql.with_(sql.LOG, """
SELECT item_id, count(*) AS count FROM log GROUP BY item_id ORDER BY count DESC, item_id LIMIT 20"""))
def _p26(spark, sf):
    return log(spark, sf).groupBy("item_id").count().orderBy(F.desc("count"), "item_id").limit(20)


@query("p27_shape", sql.with_(f"{sql.history()},\n{sql.users()}", """
SELECT count(*) AS rows, count(DISTINCT user_id) AS keys, 27::BIGINT AS columns FROM user_f"""))
def _p27(spark, sf):
    return reconcile.shape(features.user_features(open_log(spark, sf)), "user_id").withColumn(
        "rows", F.col("rows").cast("bigint")
    )


_RECENT = """
SELECT user_id, item_id, behavior_type FROM {log}
WHERE time >= (SELECT max(time) FROM {log}) - INTERVAL 1 DAY"""


@query("p28_scalar_subquery", sql.with_(sql.LOG, _RECENT.format(log="log")))
def _p28(spark, sf):
    return spark.sql(_RECENT, log=log(spark, sf))


_SHARE = """
SELECT item_id, {views} / nullif((SELECT count(*) FROM {log} w WHERE w.item_id = v.item_id), 0) AS view_share
FROM (SELECT item_id, count(*) AS views FROM {log} WHERE behavior_type = 1 GROUP BY item_id) v"""


@query("p29_correlated_subquery", sql.with_(sql.LOG, _SHARE.format(log="log", views="views::DOUBLE")))
def _p29(spark, sf):
    return spark.sql(_SHARE.replace("{views}", "views"), log=log(spark, sf))


_CHAIN = """
WITH bought AS (SELECT item_id, user_id, count(*) AS times FROM {log} WHERE behavior_type = 4 GROUP BY item_id, user_id),
per_item AS (SELECT item_id, count(*) AS buyers, count(CASE WHEN times > 1 THEN 1 END) AS again FROM bought GROUP BY item_id)
SELECT item_id, buyers, again FROM per_item WHERE again > 0"""


@query("p30_cte_chain", f"WITH {sql.LOG}, " + _CHAIN.format(log="log").strip().removeprefix("WITH "))
def _p30(spark, sf):
    return spark.sql(_CHAIN, log=log(spark, sf))


@query("p31_set_aggregates_without_udf", sql.with_(sql.history(), """
SELECT user_id, count(*) FILTER (WHERE n_view > 0) AS viewed, count(*) FILTER (WHERE n_buy > 0) AS bought,
  count(*) FILTER (WHERE n_view > 0 AND n_buy = 0) AS viewed_not_bought
FROM prs GROUP BY user_id"""))
def _p31(spark, sf):
    sets = rollup.not_bought(rollup.pairs(open_log(spark, sf).rows), "user_id")
    return sets.select(
        "user_id", F.col("d_view").alias("viewed"), F.col("buyers").alias("bought"),
        F.col("d_view_not").alias("viewed_not_bought"),
    )
