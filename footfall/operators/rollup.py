"""Groupings of the history that every feature is read from.

Each first-level grouping counts before the shuffle, so a key holding a third of the log sends one row
per task, and each second level sums few rows per key:

* (key, hour): activity counts, windows, first and last times, peak hours;
* (user, item): the pair table, which turns set differences into sums;
* (user, category): concentration, and distinct users of a category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.history import History
from footfall.schema import AFTERNOON, BUY, CART, FAVOURITE, MORNING, NIGHT, VIEW
from footfall.functions.timeparts import in_band

TYPES = {"n_view": VIEW, "n_fav": FAVOURITE, "n_cart": CART, "n_buy": BUY}
WINDOWS = {"v1": 1, "v3": 3, "v7": 7}


def of_type(code: int) -> Column:
    return F.col("behavior_type") == code


def counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("n_all")] + [F.count_if(of_type(c)).alias(n) for n, c in TYPES.items()]


def _measures(h: History) -> list[Column]:
    views = [F.count_if(of_type(VIEW) & h.within(d)).alias(n) for n, d in WINDOWS.items()]
    times = [
        F.max("age").alias("first_age"),
        F.min("age").alias("last_age"),
        F.min(F.when(of_type(BUY), F.col("age"))).alias("buy_age"),
    ]
    return counts() + views + times


def peak(count: str, hour: str = "hour") -> Column:
    """The hour with the highest count, the lowest such hour on ties; NULL where nothing is counted.

    Count and hour are packed in one number, which keeps the aggregate a hash aggregate.
    """
    packed = F.when(F.col(count) > 0, F.col(count) * 32 - F.col(hour))
    return F.max_by(hour, packed)


def by_key(h: History, key: str, hourly: bool = True) -> DataFrame:
    """One row of measures per key. With ``hourly`` it goes by (key, hour) and adds bands and peaks."""
    if not hourly:
        return h.rows.groupBy(key).agg(*_measures(h))
    return over_hours(h.rows.groupBy(key, "hour").agg(*_measures(h)), key)


def over_hours(fine: DataFrame, key: str) -> DataFrame:
    """Measures per (key, hour) summed to one row per key, with bands and peaks."""
    summed = [F.sum(c).alias(c) for c in ["n_all", *TYPES, *WINDOWS]]
    bands = {"n_morning": MORNING, "n_afternoon": AFTERNOON, "n_night": NIGHT}
    return fine.groupBy(key).agg(
        *summed,
        F.max("first_age").alias("first_age"),
        F.min("last_age").alias("last_age"),
        F.min("buy_age").alias("buy_age"),
        *[F.sum(F.when(in_band(F.col("hour"), b), F.col("n_all"))).alias(n) for n, b in bands.items()],
        peak("n_all").alias("peak_hour"),
        peak("n_view").alias("peak_view_hour"),
        peak("n_buy").alias("peak_buy_hour"),
    )


def pairs(rows: DataFrame) -> DataFrame:
    """The pair table: counts by type for each (user, item)."""
    return rows.groupBy("user_id", "item_id").agg(*counts())


def not_bought(pair_table: DataFrame, key: str) -> DataFrame:
    """Per key: distinct partners by type, those of them never bought, buyers and repeat buyers."""
    never = F.col("n_buy") == 0
    columns = [F.count(F.lit(1)).alias("partners"), F.sum("n_all").alias("rows_all")]
    for name, count in {"view": "n_view", "cart": "n_cart", "fav": "n_fav"}.items():
        columns.append(F.count_if(F.col(count) > 0).alias(f"d_{name}"))
        columns.append(F.count_if((F.col(count) > 0) & never).alias(f"d_{name}_not"))
    columns.append(F.count_if(F.col("n_buy") > 0).alias("buyers"))
    columns.append(F.count_if(F.col("n_buy") > 1).alias("repeaters"))
    return pair_table.groupBy(key).agg(*columns)


def user_categories(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "item_category").agg(F.count(F.lit(1)).alias("n_all"))
