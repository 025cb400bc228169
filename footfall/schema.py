"""Schemas of the log and of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Behaviour codes, column names and thresholds that results depend on.
VIEW, FAVOURITE, CART, BUY = 1, 2, 3, 4
TIME_FORMAT = "yyyy-MM-dd HH"

USER_FEATURES = [
    "total_behavior", "total_views", "last_1day_pv", "last_3day_pv", "last_7day_pv",
    "activity_growth_rate", "total_cart", "cart_rate", "total_fav", "fav_rate", "total_buy", "buy_rate",
    "first_active_time", "last_active_time", "buy_recency", "tendency_index", "view_not_buy_rate",
    "cart_not_buy_rate", "fav_not_buy_rate", "impulsive_buying_rate", "hesitation_buying_rate",
    "interest_concentration", "active_hour", "morning_active_rate", "afternoon_active_rate",
    "night_active_rate",
]
ITEM_FEATURES = [
    "total_pv", "last3day_pv", "last7day_pv", "popularity_growth_rate", "items_pv_ranking", "cart_count",
    "favorite_count", "buy_count", "cart_rate", "favorite_rate", "buy_rate", "uv", "view_not_buy_rate",
    "cart_not_buy_rate", "fav_not_buy_rate", "interest_depth", "repurchase_index", "buy_recency_hours",
    "peak_view_hour", "peak_buy_hour",
]
CATEGORY_FEATURES = [
    "total_pv", "cart_count", "favorite_count", "buy_count", "users_count", "buy_rate", "peak_view_hour",
    "peak_buy_hour",
]
# Columns that are no model input: keys, the label, and what gives the label away.
NOT_INPUTS = [
    "user_id", "item_id", "time", "label", "total_buy", "buy_rate_x", "buy_count_x", "buy_rate_y",
    "buy_count_y", "buy_rate", "buy_recency", "buy_recency_hours", "repurchase_index",
    "impulsive_buying_rate", "hesitation_buying_rate",
]
LEAKY_SELECTED = [
    "behavior_type", "buy_recency_hours", "total_buy", "total_cart", "last_1day_pv", "last7day_pv",
]
# Hour bands: first hour, last hour; the night wraps around midnight.
MORNING, AFTERNOON, NIGHT = (6, 13), (14, 21), (22, 5)
RATIOS = [0.3, 0.5, 0.8, 1.0]
SEED = 42
# End of fixed values.

LOG = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("item_category", T.LongType()),
    T.StructField("behavior_type", T.IntegerType()),
    T.StructField("time", T.TimestampNTZType()),
])
LOG_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "time" else f.dataType) for f in LOG.fields
])

_HOURS = {"active_hour", "peak_view_hour", "peak_buy_hour"}
_DOUBLES = {"interest_depth", "buy_recency", "buy_recency_hours"}


def _type(name: str) -> T.DataType:
    if name in _HOURS:
        return T.IntegerType()
    if name in _DOUBLES or name.endswith(("_rate", "_index", "_concentration")):
        return T.DoubleType()
    return T.LongType()


def feature_schema(key: str, names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(key, T.LongType())] + [T.StructField(n, _type(n)) for n in names])


USER_TABLE = feature_schema("user_id", USER_FEATURES)
ITEM_TABLE = feature_schema("item_id", ITEM_FEATURES)
CATEGORY_TABLE = feature_schema("item_category", CATEGORY_FEATURES)
