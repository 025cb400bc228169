"""User, item and category features.

A feature is a column over one of the roll-ups. A call names the features it wants, and only the
roll-ups those need are built. The roll-ups of one entity meet on its key, already hash partitioned by
it, so the joins add no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.ratios import present, ratio, share
from footfall.functions.timeparts import hours, whole_days
from footfall.operators import ranking, rollup
from footfall.operators.history import History
from footfall.schema import CATEGORY_FEATURES, ITEM_FEATURES, USER_FEATURES

_FROM_PAIRS = {
    "view_not_buy_rate", "cart_not_buy_rate", "fav_not_buy_rate", "uv", "interest_depth", "repurchase_index",
}
_FROM_HOURS = {
    "active_hour", "morning_active_rate", "afternoon_active_rate", "night_active_rate", "peak_view_hour",
    "peak_buy_hour",
}


def _never_bought(kind: str) -> Column:
    return ratio(F.col(f"d_{kind}_not"), present(f"d_{kind}"))


def _user_columns() -> dict[str, Column]:
    c = F.col
    return {
        "total_behavior": c("n_all"),
        "total_views": present("n_view"),
        "last_1day_pv": present("v1"),
        "last_3day_pv": present("v3"),
        "last_7day_pv": present("v7"),
        "activity_growth_rate": share("v3", "v7"),
        "total_cart": present("n_cart"),
        "cart_rate": share("n_cart", "n_view"),
        "total_fav": present("n_fav"),
        "fav_rate": share("n_fav", "n_view"),
        "total_buy": present("n_buy"),
        "buy_rate": share("n_buy", "n_view"),
        "first_active_time": whole_days(c("first_age")),
        "last_active_time": whole_days(c("last_age")),
        "buy_recency": hours(c("buy_age")),
        "tendency_index": ratio(present("n_buy") + present("n_cart"), present("n_view")),
        "view_not_buy_rate": _never_bought("view"),
        "cart_not_buy_rate": _never_bought("cart"),
        "fav_not_buy_rate": _never_bought("fav"),
        "impulsive_buying_rate": share("n_buy", "n_view"),
        "hesitation_buying_rate": share("n_view", "n_buy"),
        "interest_concentration": ratio(c("top_category"), c("rows_by_category")),
        "active_hour": c("peak_hour"),
        "morning_active_rate": ratio(c("n_morning"), c("n_all")),
        "afternoon_active_rate": ratio(c("n_afternoon"), c("n_all")),
        "night_active_rate": ratio(c("n_night"), c("n_all")),
    }


def _item_columns() -> dict[str, Column]:
    c = F.col
    return {
        "total_pv": present("n_view"),
        "last3day_pv": present("v3"),
        "last7day_pv": present("v7"),
        "popularity_growth_rate": share("v3", "v7"),
        "items_pv_ranking": c("items_pv_ranking"),
        "cart_count": present("n_cart"),
        "favorite_count": present("n_fav"),
        "buy_count": present("n_buy"),
        "cart_rate": share("n_cart", "n_view"),
        "favorite_rate": share("n_fav", "n_view"),
        "buy_rate": share("n_buy", "n_view"),
        "uv": c("partners"),
        "view_not_buy_rate": _never_bought("view"),
        "cart_not_buy_rate": _never_bought("cart"),
        "fav_not_buy_rate": _never_bought("fav"),
        "interest_depth": ratio(c("rows_all"), c("partners")),
        "repurchase_index": ratio(c("repeaters"), present("buyers")),
        "buy_recency_hours": hours(c("buy_age")),
        "peak_view_hour": c("peak_view_hour"),
        "peak_buy_hour": c("peak_buy_hour"),
    }


def _by_key(h: History | None, key: str, want: set[str], key_table: DataFrame | None) -> DataFrame:
    return rollup.by_key(h, key, hourly=bool(want & _FROM_HOURS)) if key_table is None else key_table


def _on_key(blocks: list[DataFrame], key: str) -> DataFrame:
    """Every block has a row for every key of the history, so an inner join loses none."""
    return reduce(lambda a, b: a.join(b, key), blocks)


def user_features(
    h: History | None,
    names: list[str] | None = None,
    pair_table: DataFrame | None = None,
    category_table: DataFrame | None = None,
    key_table: DataFrame | None = None,
) -> DataFrame:
    """Features per user. ``pair_table``, ``category_table`` and ``key_table`` (measures per user) may be given already
    written; with all three no history is read."""
    names = names or USER_FEATURES
    want = set(names)
    blocks = []
    if want - _FROM_PAIRS - {"interest_concentration"}:
        blocks.append(_by_key(h, "user_id", want, key_table))
    if want & _FROM_PAIRS:
        table = rollup.pairs(h.rows) if pair_table is None else pair_table
        blocks.append(rollup.not_bought(table, "user_id"))
    if "interest_concentration" in want:
        table = rollup.user_categories(h.rows) if category_table is None else category_table
        blocks.append(
            table.groupBy("user_id").agg(
                F.max("n_all").alias("top_category"), F.sum("n_all").alias("rows_by_category")
            )
        )
    columns = _user_columns()
    return _on_key(blocks, "user_id").select("user_id", *[columns[n].alias(n) for n in names])


def item_features(
    h: History | None,
    names: list[str] | None = None,
    pair_table: DataFrame | None = None,
    key_table: DataFrame | None = None,
) -> DataFrame:
    """Features per item; tables as in :func:`user_features`."""
    names = names or ITEM_FEATURES
    want = set(names)
    blocks = []
    if want - _FROM_PAIRS:
        base = _by_key(h, "item_id", want, key_table)
        if "items_pv_ranking" in want:
            base = ranking.min_rank_desc(base, "n_view", "items_pv_ranking")
        blocks.append(base)
    if want & _FROM_PAIRS:
        table = rollup.pairs(h.rows) if pair_table is None else pair_table
        blocks.append(rollup.not_bought(table, "item_id"))
    columns = _item_columns()
    return _on_key(blocks, "item_id").select("item_id", *[columns[n].alias(n) for n in names])


def category_features(
    h: History | None,
    names: list[str] | None = None,
    category_table: DataFrame | None = None,
    key_table: DataFrame | None = None,
) -> DataFrame:
    """Features per category; what is missing is 0. Tables as in :func:`user_features`."""
    names = names or CATEGORY_FEATURES
    want = set(names)
    blocks = []
    if want - {"users_count"}:
        blocks.append(_by_key(h, "item_category", want, key_table))
    if "users_count" in want:
        table = rollup.user_categories(h.rows) if category_table is None else category_table
        blocks.append(table.groupBy("item_category").agg(F.count(F.lit(1)).alias("users_count")))
    columns = {
        "total_pv": F.col("n_view"),
        "cart_count": F.col("n_cart"),
        "favorite_count": F.col("n_fav"),
        "buy_count": F.col("n_buy"),
        "users_count": F.col("users_count"),
        "buy_rate": share("n_buy", "n_view"),
        "peak_view_hour": F.col("peak_view_hour"),
        "peak_buy_hour": F.col("peak_buy_hour"),
    }
    rows = _on_key(blocks, "item_category")
    return rows.select("item_category", *[columns[n].alias(n) for n in names]).fillna(0, names)
