"""Candidate pairs, labels, negative sampling and the joined training table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import timeparts
from footfall.operators import history, joins, ranking
from footfall.operators.rollup import of_type
from footfall.schema import BUY, CART, FAVOURITE, SEED, VIEW

PAIR = ["user_id", "item_id"]
ROW = ["user_id", "item_id", "item_category"]


def candidates(log: DataFrame, as_of: datetime) -> DataFrame:
    """Distinct (user, item, category) viewed, favourited or carted before the cutoff."""
    active = F.col("behavior_type").isin(VIEW, FAVOURITE, CART)
    return history.before(log, as_of).where(active).select(*ROW).distinct()


def labels(log: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    """Distinct (user, item) bought in the ``days`` days from the cutoff."""
    end = as_of + timedelta(days=days)
    when = (F.col("time") >= timeparts.naive(as_of)) & (F.col("time") < timeparts.naive(end))
    return log.where(of_type(BUY) & when).select(*PAIR).distinct()


def attach_label(pairs: DataFrame, bought: DataFrame) -> DataFrame:
    """1 where the pair was bought, else 0."""
    marked = bought.select(*PAIR, F.lit(1).alias("label"))
    return pairs.join(marked, PAIR, "left").select(
        *ROW, F.coalesce(F.col("label"), F.lit(0)).alias("label")
    )


def labelled(
    log: DataFrame, as_of: datetime, days: int = 1, label_log: DataFrame | None = None
) -> DataFrame:
    """Labelled candidates. ``label_log`` may be a read of the label days alone."""
    return attach_label(candidates(log, as_of), labels(log if label_log is None else label_log, as_of, days))


def sample_negatives(df: DataFrame, ratio: int = 10, seed: object = SEED, allow_fewer: bool = False) -> DataFrame:
    """All positives and exactly ``ratio`` negatives for each, drawn without replacement.

    Where fewer negatives exist the query fails, unless ``allow_fewer`` asks for all there are; :func:`sampling_report`
    tells beforehand. The input is read several times (counts, then rows), so write it first when it is costly.
    """
    positive, negative = df.where(F.col("label") == 1), df.where(F.col("label") == 0)
    wanted = F.count_if(F.col("label") == 1) * ratio
    available = F.count_if(F.col("label") == 0)
    if not allow_fewer:
        short = F.concat(F.lit("negatives wanted: "), wanted.cast("string"), F.lit(", available: "), available.cast("string"))
        wanted = F.when(available >= wanted, wanted).otherwise(F.raise_error(short).cast("bigint"))
    n = df.agg(wanted.cast("bigint").alias("n")).scalar()
    return positive.unionByName(ranking.seeded_take(negative, seed, ROW, n))


def sampling_report(df: DataFrame, ratio: int = 10) -> DataFrame:
    counts = df.agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("available"),
    )
    wanted = F.col("positives") * ratio
    return counts.select(
        "positives", "available", wanted.alias("wanted"), F.least(wanted, "available").alias("taken")
    )


def shuffle(df: DataFrame, seed: object = SEED, keys: list[str] | None = None) -> DataFrame:
    return ranking.seeded_shuffle(df, seed, keys or ROW)


def feature_table(base: DataFrame, users: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """User, item and category features joined to the base in that order; what is missing is 0.

    Names in both sides get ``_x`` and ``_y`` join by join, as downstream column lists expect.
    """
    table = joins.lookup(base, users, "user_id")
    table = joins.lookup(table, items, "item_id")
    table = joins.lookup(table, categories, "item_category")
    front = ["user_id", "item_id", "item_category", "label"]
    return table.select(*front, *[c for c in table.columns if c not in front]).fillna(0)
