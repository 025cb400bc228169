"""Definitions that differ from the materialised features in what they count or how they fill."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions import timeparts
from footfall.functions.ratios import filled_share
from footfall.operators import history, joins, rollup
from footfall.operators.rollup import of_type
from footfall.schema import AFTERNOON, BUY, CART, FAVOURITE, MORNING, NIGHT, VIEW


def not_bought_by_event(pair_table: DataFrame, count: str, name: str) -> DataFrame:
    """Per user: rows of a type on items never bought / rows of that type. Users at zero are absent."""
    never = F.sum(F.when(F.col("n_buy") == 0, F.col(count)).otherwise(0))
    sums = pair_table.groupBy("user_id").agg(never.alias("never"), F.sum(count).alias("every"))
    return sums.where(F.col("never") > 0).select(
        "user_id", filled_share(F.col("never"), F.col("every")).alias(name)
    )


def not_bought_by_pair(rows: DataFrame, key: str, code: int, name: str) -> DataFrame:
    """The same share over distinct pairs, by anti join. Entities at zero are absent."""
    seen = rows.where(of_type(code)).select("user_id", "item_id").distinct()
    bought = rows.where(of_type(BUY)).select("user_id", "item_id")
    only = joins.anti(seen, bought, ["user_id", "item_id"]).groupBy(key).agg(F.count(F.lit(1)).alias("never"))
    every = seen.groupBy(key).agg(F.count(F.lit(1)).alias("every"))
    return only.join(every, key).select(key, filled_share(F.col("never"), F.col("every")).alias(name))


def view_concentration(rows: DataFrame) -> DataFrame:
    """Views in the most viewed category / all rows. Users without views are absent."""
    counts = rows.groupBy("user_id", "item_category").agg(
        F.count_if(of_type(VIEW)).alias("views"), F.count(F.lit(1)).alias("every")
    )
    tops = counts.groupBy("user_id").agg(F.max("views").alias("top"), F.sum("every").alias("every"))
    return tops.where(F.col("top") > 0).select(
        "user_id", filled_share(F.col("top"), F.col("every")).alias("interest_concentration")
    )


def hour_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key, F.hour("time").alias("hour")).agg(F.count(F.lit(1)).alias("cnt"))


def tied_hours(rows: DataFrame, key: str = "user_id") -> DataFrame:
    """Every hour that shares a key's highest count, as text. At most 24 rows per key are ranked."""
    best = W.partitionBy(key).orderBy(F.desc("cnt"))
    ranked = hour_counts(rows, key).withColumn("_rank", F.rank().over(best))
    return ranked.where(F.col("_rank") == 1).select(
        key, F.lpad(F.col("hour").cast("string"), 2, "0").alias("active_hour")
    )


def peak_with_count(rows: DataFrame, key: str, code: int) -> DataFrame:
    """The peak hour of one behaviour and its count; the lowest hour wins ties."""
    best = W.partitionBy(key).orderBy(F.desc("cnt"), F.asc("hour"))
    ranked = hour_counts(rows.where(of_type(code)), key).withColumn("_rank", F.row_number().over(best))
    return ranked.where(F.col("_rank") == 1).select(
        key,
        F.lpad(F.col("hour").cast("string"), 2, "0").alias("peak_hour"),
        F.col("cnt").alias("peak_cnt"),
    )


def buy_recency_days(log: DataFrame) -> DataFrame:
    """Days from a user's last buy to the last row of the whole log."""
    last = log.where(of_type(BUY)).groupBy("user_id").agg(F.max("time").alias("last"))
    since = history.last_moment(log) - timeparts.epoch_seconds("last")
    return last.select("user_id", timeparts.days(since).alias("buy_recency"))


def buy_recency_from_buys(log: DataFrame, as_of: datetime | None, until: datetime | None = None) -> DataFrame:
    """Hours from an item's last buy before ``until`` to the last buy of any item before ``as_of``.

    With no ``until`` the item's own buys have no cutoff, and the result may be negative.
    """
    buys = log.where(of_type(BUY))
    last = history.before(buys, until).groupBy("item_id").agg(F.max("time").alias("last"))
    since = history.last_moment(history.before(buys, as_of)) - timeparts.epoch_seconds("last")
    return last.select("item_id", timeparts.hours(since).alias("buy_recency_hours"))


def _sums(rows: DataFrame, key: str) -> DataFrame:
    hour = F.hour("time")
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("every"),
        *[F.count_if(of_type(c)).alias(n) for n, c in rollup.TYPES.items()],
        *[
            F.count_if(timeparts.in_band(hour, band)).alias(name)
            for name, band in {"morning": MORNING, "afternoon": AFTERNOON, "night": NIGHT}.items()
        ],
    )


def zero_filled_rates(rows: DataFrame, key: str, rates: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rates over plain sums: 0 where nothing is counted, NULL only where the divisor is 0."""
    return _sums(rows, key).select(key, *[filled_share(a, b).alias(n) for n, (a, b) in rates.items()])


def user_rates() -> dict[str, tuple[Column, Column]]:
    view, fav, cart, buy = (F.col(n) for n in ("n_view", "n_fav", "n_cart", "n_buy"))
    return {
        "cart_rate": (cart, view), "fav_rate": (fav, view), "buy_rate": (buy, view),
        "impulsive_buying_rate": (buy, view), "hesitation_buying_rate": (view, buy),
    }


def item_rates() -> dict[str, tuple[Column, Column]]:
    view = F.col("n_view")
    return {
        "cart_rate": (F.col("n_cart"), view), "favorite_rate": (F.col("n_fav"), view),
        "buy_rate": (F.col("n_buy"), view),
    }


def tendency_rates() -> dict[str, tuple[Column, Column]]:
    return {"tendency_index": (F.col("n_buy") + F.col("n_cart"), F.col("n_view"))}


def band_rates() -> dict[str, tuple[Column, Column]]:
    every = F.col("every")
    return {f"{band}_active_rate": (F.col(band), every) for band in ("morning", "afternoon", "night")}


def active_span(rows: DataFrame) -> DataFrame:
    """First and last times themselves."""
    return rows.groupBy("user_id").agg(
        F.min("time").alias("first_active_time"), F.max("time").alias("last_active_time")
    )


def calendar_window_views(log: DataFrame, days: int, name: str) -> DataFrame:
    """Views per user since a calendar day: the day of the last row minus ``days``."""
    last_day = log.agg(F.to_date(F.max("time")).alias("d")).scalar()
    recent = log.where(of_type(VIEW) & (F.to_date("time") >= F.date_sub(last_day, days)))
    return recent.groupBy("user_id").agg(F.count(F.lit(1)).alias(name))


KINDS = {"view": VIEW, "cart": CART, "fav": FAVOURITE}
