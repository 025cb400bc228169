"""Train / validation / test splits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions import timeparts
from footfall.operators import ranking
from footfall.operators.assemble import ROW
from footfall.schema import SEED

PARTS = ["train", "val", "test"]


def _allot(classes: DataFrame, label: str, count: str, total: Column, name: str) -> DataFrame:
    """Share ``total`` rows among classes in proportion to ``count``, by largest remainder.

    The class table has a row per class, so its windows are small.
    """
    everywhere = W.partitionBy()
    quota = F.col(count).cast("double") * total / F.sum(count).over(everywhere)
    shares = classes.withColumn("_quota", quota).withColumn("_whole", F.floor("_quota").cast("bigint"))
    left = total - F.sum("_whole").over(everywhere)
    place = F.row_number().over(W.orderBy(F.desc(F.col("_quota") - F.col("_whole")), F.asc(label)))
    given = F.col("_whole") + F.when(place <= left, 1).otherwise(0)
    return shares.withColumn(name, given).drop("_quota", "_whole")


def split_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class and split: 30% taken off train, then a third of that for test, both rounded up."""
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everywhere = W.partitionBy()
    classes = classes.withColumn("_n", F.sum("n").over(everywhere))
    n_train = F.col("_n") - F.ceil(F.col("_n") * F.lit(0.3)).cast("bigint")
    classes = _allot(classes, label, "n", n_train, "train")
    classes = classes.withColumn("_rest", F.col("n") - F.col("train"))
    classes = classes.withColumn("_n_rest", F.sum("_rest").over(everywhere))
    n_val = F.col("_n_rest") - F.ceil(F.col("_n_rest") * F.lit(1.0) / F.lit(3.0)).cast("bigint")
    classes = _allot(classes, label, "_rest", n_val, "val")
    return classes.select(label, "n", "train", "val", (F.col("_rest") - F.col("val")).alias("test"))


def stratified_split(
    df: DataFrame, label: str = "label", keys: list[str] | None = None, seed: object = SEED
) -> DataFrame:
    """Add ``split``: exact 70/20/10 shares of every class, in the seeded order of the keys."""
    sizes = split_sizes(df, label).select(label, "train", "val")

    def part(position: Column) -> Column:
        return (
            F.when(position <= F.col("train"), F.lit("train"))
            .when(position <= F.col("train") + F.col("val"), F.lit("val"))
            .otherwise(F.lit("test"))
        )

    return ranking.seeded_cut(df, seed, keys or ROW, part, "split", [label], sizes)


def time_split(df: DataFrame, ts: str, train_until: datetime, val_until: datetime) -> DataFrame:
    """Add ``split`` by time windows."""
    return df.withColumn(
        "split",
        F.when(F.col(ts) < timeparts.naive(train_until), F.lit("train"))
        .when(F.col(ts) < timeparts.naive(val_until), F.lit("val"))
        .otherwise(F.lit("test")),
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows by split and label, and the share of positives in the split."""
    counts = df.groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"))
    whole = W.partitionBy("split")
    positive = F.sum(F.when(F.col(label) == 1, F.col("rows")).otherwise(0)).over(whole)
    return counts.withColumn("positive_share", positive / F.sum("rows").over(whole).cast("double"))


def coverage(df: DataFrame, ts: str) -> DataFrame:
    """Rows by split, day and hour."""
    return df.groupBy("split", F.to_date(ts).alias("day"), F.hour(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("rows")
    )
