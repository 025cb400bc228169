"""User, item and category features, one query each and all together; the variant definitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.catalog import sql
from footfall.catalog.registry import AS_OF, Query, add, log, open_log, query, rollups_by_day
from footfall.operators import distinct, features, history, rollup, variants
from footfall.schema import BUY, CATEGORY_FEATURES, USER_FEATURES, VIEW
from footfall.session import materialise

_ITEM_ORDER = [
    "total_pv", "cart_count", "favorite_count", "buy_count", "last3day_pv", "last7day_pv",
    "popularity_growth_rate", "items_pv_ranking", "cart_rate", "favorite_rate", "buy_rate", "uv",
    "repurchase_index", "buy_recency_hours", "interest_depth", "peak_view_hour", "peak_buy_hour",
    "view_not_buy_rate", "cart_not_buy_rate", "fav_not_buy_rate",
]


def _entity(build, names: list[str] | None = None) -> Query:
    return lambda spark, sf: build(open_log(spark, sf), names)


def _register(letter: str, key: str, view: str, build, names: list[str], ctes: str) -> None:
    for number, name in enumerate(names, start=1):
        shown = name if not name.startswith(letter + "_") else name[2:]
        add(
            f"{letter}{number}_{shown}",
            _entity(build, [name]),
            sql.with_(f"{sql.history()},\n{ctes}", f"SELECT {key}, {name} FROM {view}"),
        )


_register("u", "user_id", "user_f", features.user_features, USER_FEATURES, sql.users())
_register("i", "item_id", "item_f", features.item_features, _ITEM_ORDER, sql.items())
_register("c", "item_category", "cat_f", features.category_features, CATEGORY_FEATURES, sql.categories())

add("user_features", _entity(features.user_features),
    sql.with_(f"{sql.history()},\n{sql.users()}", "SELECT * FROM user_f"))
add("item_features", _entity(features.item_features),
    sql.with_(f"{sql.history()},\n{sql.items()}", "SELECT * FROM item_f"))
add("category_features", _entity(features.category_features),
    sql.with_(f"{sql.history()},\n{sql.categories()}", "SELECT * FROM cat_f"))


@query("user_features_by_day", sql.with_(f"{sql.history()},\n{sql.users()}", "SELECT * FROM user_f"))
def _user_by_day(spark, sf) -> DataFrame:
    r = rollups_by_day(spark, sf)
    return features.user_features(None, None, r.pairs, r.user_categories, r.users)


@query("item_features_by_day", sql.with_(f"{sql.history()},\n{sql.items()}", "SELECT * FROM item_f"))
def _item_by_day(spark, sf) -> DataFrame:
    r = rollups_by_day(spark, sf)
    return features.item_features(None, None, r.pairs, r.items)


@query("category_features_by_day", sql.with_(f"{sql.history()},\n{sql.categories()}", "SELECT * FROM cat_f"))
def _category_by_day(spark, sf) -> DataFrame:
    r = rollups_by_day(spark, sf)
    return features.category_features(None, None, r.user_categories, r.categories)


# --- Definitions over the log without a cutoff, unless they say otherwise ---------------------------

def _by_event(kind: str) -> None:
    count = f"n_{kind}"
    name = f"{kind}_not_buy_rate"
    code = variants.KINDS[kind]
    number = {"view": 1, "cart": 2, "fav": 3}[kind]

    def run(spark, sf) -> DataFrame:
        return variants.not_bought_by_event(rollup.pairs(log(spark, sf)), count, name)

    add(f"v{number}_{kind}_not_buy_by_event", run, sql.with_(sql.LOG, f"""
SELECT user_id, count(*) FILTER (WHERE NOT bought)::DOUBLE / count(*) AS {name}
FROM (SELECT user_id, behavior_type, bool_or(behavior_type = 4) OVER (PARTITION BY user_id, item_id) AS bought FROM log)
WHERE behavior_type = {code} GROUP BY user_id HAVING NOT bool_and(bought)"""))


for _kind in ("view", "cart", "fav"):
    _by_event(_kind)


@query("v4_interest_concentration_views", sql.with_(sql.LOG, """
SELECT user_id, max(views)::DOUBLE / sum(rows) AS interest_concentration FROM (
  SELECT user_id, item_category, count(*) FILTER (WHERE behavior_type = 1) AS views, count(*) AS rows FROM log GROUP BY ALL)
GROUP BY user_id HAVING max(views) > 0"""))
def _v4(spark, sf):
    return variants.view_concentration(log(spark, sf))


@query("v5_tied_active_hours", sql.with_(sql.LOG, """
SELECT user_id, strftime(MAKE_TIMESTAMP(2000, 1, 1, hr, 0, 0.0), '%H') AS active_hour
FROM (SELECT user_id, hour(time) AS hr, rank() OVER (PARTITION BY user_id ORDER BY count(*) DESC) AS r
      FROM log GROUP BY user_id, hour(time)) WHERE r = 1"""))
def _v5(spark, sf):
    return variants.tied_hours(log(spark, sf))


@query("v6_buy_recency_days", sql.with_(sql.LOG, """
SELECT user_id, ((SELECT epoch(max(time))::BIGINT FROM log) - epoch(max(time))::BIGINT)::DOUBLE / 86400
  AS buy_recency
FROM log WHERE behavior_type = 4 GROUP BY user_id"""))
def _v6(spark, sf):
    return variants.buy_recency_days(log(spark, sf))


def _v7_sql(until: datetime | None) -> str:
    bound = f" AND time < {sql.stamp(until)}" if until else ""
    return sql.with_(sql.LOG, f"""
SELECT item_id, ((SELECT epoch(max(time))::BIGINT FROM log WHERE behavior_type = 4 AND time < {sql.stamp(AS_OF)})
  - epoch(max(time))::BIGINT)::DOUBLE / 3600 AS buy_recency_hours
FROM log WHERE behavior_type = 4{bound} GROUP BY item_id""")


add("v7_item_buy_recency_from_buys",
    lambda spark, sf: variants.buy_recency_from_buys(log(spark, sf), AS_OF), _v7_sql(None))
add("v7_item_buy_recency_from_buys_cut",
    lambda spark, sf: variants.buy_recency_from_buys(log(spark, sf), AS_OF, AS_OF), _v7_sql(AS_OF))


def _n(code: int) -> str:
    return f"count(*) FILTER (WHERE behavior_type = {code})"


def _filled(a: str, b: str, name: str) -> str:
    return f"({a})::DOUBLE / nullif({b}, 0) AS {name}"


add("v8_tendency_index_filled",
    lambda spark, sf: variants.zero_filled_rates(log(spark, sf), "user_id", variants.tendency_rates()),
    sql.with_(sql.LOG, f"""
SELECT user_id, {_filled(f'{_n(4)} + {_n(3)}', _n(1), 'tendency_index')} FROM log GROUP BY user_id"""))

add("v9_user_rates_filled",
    lambda spark, sf: variants.zero_filled_rates(log(spark, sf), "user_id", variants.user_rates()),
    sql.with_(sql.LOG, f"""
SELECT user_id, {_filled(_n(3), _n(1), 'cart_rate')}, {_filled(_n(2), _n(1), 'fav_rate')},
  {_filled(_n(4), _n(1), 'buy_rate')}, {_filled(_n(4), _n(1), 'impulsive_buying_rate')},
  {_filled(_n(1), _n(4), 'hesitation_buying_rate')}
FROM log GROUP BY user_id"""))

add("v9_item_rates_filled",
    lambda spark, sf: variants.zero_filled_rates(log(spark, sf), "item_id", variants.item_rates()),
    sql.with_(sql.LOG, f"""
SELECT item_id, {_filled(_n(3), _n(1), 'cart_rate')}, {_filled(_n(2), _n(1), 'favorite_rate')},
  {_filled(_n(4), _n(1), 'buy_rate')}
FROM log GROUP BY item_id"""))

add("v10_hour_band_rates_filled",
    lambda spark, sf: variants.zero_filled_rates(log(spark, sf), "user_id", variants.band_rates()),
    sql.with_(sql.LOG, """
SELECT user_id,
  count(*) FILTER (WHERE hour(time) BETWEEN 6 AND 13)::DOUBLE / count(*) AS morning_active_rate,
  count(*) FILTER (WHERE hour(time) BETWEEN 14 AND 21)::DOUBLE / count(*) AS afternoon_active_rate,
  count(*) FILTER (WHERE hour(time) >= 22 OR hour(time) < 6)::DOUBLE / count(*) AS night_active_rate
FROM log GROUP BY user_id"""))

add("v11_active_span",
    lambda spark, sf: variants.active_span(log(spark, sf)),
    sql.with_(sql.LOG, """
SELECT user_id, min(time) AS first_active_time, max(time) AS last_active_time FROM log GROUP BY user_id"""))


def _by_pair(kind: str) -> None:
    code, name = variants.KINDS[kind], f"{kind}_not_buy_rate"

    def run(spark, sf) -> DataFrame:
        return variants.not_bought_by_pair(history.before(log(spark, sf, AS_OF), AS_OF), "item_id", code, name)

    add(f"v12_{kind}_not_buy_anti_join", run, sql.with_(sql.history(), f"""
SELECT item_id, count(*) FILTER (WHERE n_buy = 0)::DOUBLE / count(*) AS {name}
FROM prs WHERE n_{kind} > 0 GROUP BY item_id HAVING count(*) FILTER (WHERE n_buy = 0) > 0"""))


for _kind in ("view", "cart", "fav"):
    _by_pair(_kind)


def _peaks(name: str, key: str, code: int, as_of: datetime | None) -> None:
    def run(spark, sf) -> DataFrame:
        return variants.peak_with_count(history.before(log(spark, sf, as_of), as_of), key, code)

    add(name, run, sql.with_(sql.history(as_of), f"""
SELECT {key}, peak_hour, peak_cnt FROM (
  SELECT {key}, strftime(time, '%H') AS peak_hour, count(*) AS peak_cnt,
         row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, strftime(time, '%H')) AS rn
  FROM h WHERE behavior_type = {code} GROUP BY {key}, strftime(time, '%H')) WHERE rn = 1"""))


_peaks("v13_item_peak_view_hour", "item_id", VIEW, AS_OF)
_peaks("v13_item_peak_buy_hour", "item_id", BUY, AS_OF)
_peaks("v13_category_peak_view_hour", "item_category", VIEW, None)
_peaks("v13_category_peak_buy_hour", "item_category", BUY, None)


def _calendar(days: int) -> None:
    name = f"last_{days}day_pv"
    add(f"v14_calendar_{name}",
        lambda spark, sf: variants.calendar_window_views(log(spark, sf), days, name),
        sql.with_(sql.LOG, f"""
SELECT user_id, count(*) AS {name} FROM log
WHERE behavior_type = 1 AND time::DATE >= (SELECT max(time)::DATE FROM log) - {days} GROUP BY user_id"""))


for _days in (1, 3, 7):
    _calendar(_days)


# --- Distinct partners from partials kept by day ------------------------------------------------------

_WEEK = datetime(2024, 1, 15), datetime(2024, 1, 22)


def _span(key: str, partner: str, name: str) -> str:
    return sql.with_(sql.LOG, f"""
SELECT {key}, count(DISTINCT {partner}) AS {name} FROM log
WHERE time >= {sql.stamp(_WEEK[0])} AND time < {sql.stamp(_WEEK[1])} GROUP BY {key}""")


def _from_bitmaps(spark, sf, key: str, partner: str, name: str) -> DataFrame:
    """A week's distinct partners from the bitmaps of all days."""
    days = materialise(distinct.daily_bitmaps(log(spark, sf), key, partner)[0], "bitmaps", by="day")
    return distinct.distinct_of_bitmaps(days, key, name, _WEEK[0].date(), _WEEK[1].date())


@query("a4_item_users_from_bitmaps", _span("item_id", "user_id", "uv"))
def _a4_bitmaps(spark, sf):
    return _from_bitmaps(spark, sf, "item_id", "user_id", "uv")


@query("a4_category_users_from_bitmaps", _span("item_category", "user_id", "users_count"))
def _a4_category_bitmaps(spark, sf):
    return _from_bitmaps(spark, sf, "item_category", "user_id", "users_count")


@query("a7_user_items_from_bitmaps", _span("user_id", "item_id", "items"))
def _a7_bitmaps(spark, sf):
    return _from_bitmaps(spark, sf, "user_id", "item_id", "items")


@query("a4_category_users_from_sketches", sql.with_(sql.LOG, f"""
SELECT item_category, count(DISTINCT user_id) AS users_count, TRUE AS estimate_is_near FROM log
WHERE time >= {sql.stamp(_WEEK[0])} AND time < {sql.stamp(_WEEK[1])} GROUP BY item_category"""))
def _a4_sketches(spark, sf):
    """Exact counts, and whether the estimates from a week's daily sketches are within four of their standard errors."""
    rows = log(spark, sf)
    days = materialise(distinct.daily_sketches(rows, "item_category", "user_id"), "sketches", by="day")
    about = distinct.distinct_of_sketches(days, "item_category", "estimate", _WEEK[0].date(), _WEEK[1].date())
    exact = log(spark, sf, _WEEK[1], _WEEK[0]).groupBy("item_category").agg(F.count_distinct("user_id").alias("users_count"))
    bound = F.col("users_count") * (4 * 1.04 / 2 ** (distinct.SKETCH_BITS / 2)) + 1
    near = (F.abs(F.col("estimate") - F.col("users_count")) <= bound).alias("estimate_is_near")
    return exact.join(about, "item_category").select("item_category", "users_count", near)
