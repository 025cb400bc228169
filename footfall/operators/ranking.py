"""Ranks, exact selections and running totals without one giant task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.functions import hashing
from footfall.session import materialise


def min_rank_desc(df: DataFrame, value: str, name: str) -> DataFrame:
    """Descending rank of a count, ties sharing the lowest rank; NULL where the count is 0.

    Rows are grouped to distinct counts, which are placed by running totals over written slices and joined
    back. Adaptive execution broadcasts the places where they are few and splits the hottest count where not.
    """
    sizes = df.where(F.col(value) > 0).groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    totals = running_totals(sizes, ["_value"], ["_n"], descending=True)
    ranks = totals.select("_value", (F.col("cum__n") - F.col("_n") + 1).alias(name))
    return df.join(ranks, F.col(value) == F.col("_value"), "left").drop("_value")


def _bucketed(df: DataFrame, seed: object, keys: list[str]) -> DataFrame:
    ordered = df.withColumn("_order", hashing.digest(seed, *keys))
    return ordered.withColumn("_bucket", hashing.bucket(F.col("_order")))


def _offsets(bucketed: DataFrame, stratum: list[str]) -> DataFrame:
    """Rows before each bucket, and up to its end, by stratum.

    At most 65,536 rows per stratum, whatever the data: safe to broadcast when strata are classes.
    """
    sizes = bucketed.groupBy(*stratum, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*stratum).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    ends = sizes.withColumn("_hi", F.sum("_n").over(upto))
    return ends.select(*stratum, "_bucket", (F.col("_hi") - F.col("_n")).alias("_lo"), "_hi")


def _in_bucket(stratum: list[str], keys: list[str]) -> Column:
    return F.row_number().over(W.partitionBy(*stratum, "_bucket").orderBy("_order", *keys))


def seeded_rank(
    df: DataFrame, seed: object, keys: list[str], name: str = "rank", stratum: list[str] | None = None
) -> DataFrame:
    """1-based position of each row in the md5 order of its keys, within its stratum.

    Row numbers are taken inside 65,536 buckets of the md5 and shifted by the rows before the bucket. Offsets meet rows where the
    buckets are numbered, in the same shuffle, so that they don't go through the driver, which many strata would fill.
    """
    stratum = stratum or []
    rows = _bucketed(df, seed, keys)
    placed = rows.join(_offsets(rows, stratum).hint("shuffle_hash"), [*stratum, "_bucket"])
    ranked = placed.withColumn(name, F.col("_lo") + _in_bucket(stratum, keys))
    return ranked.select(*df.columns, name)


def seeded_cut(
    df: DataFrame,
    seed: object,
    keys: list[str],
    segment: Callable[[Column], Column],
    name: str = "segment",
    stratum: list[str] | None = None,
    extra: DataFrame | None = None,
) -> DataFrame:
    """Cut the md5 order of each stratum into segments, exactly.

    ``segment`` maps a 1-based position to a segment and never falls as the position grows. A bucket
    whose ends map alike lies whole in that segment and is taken without ranking; only the few buckets
    that straddle a cut are sorted. ``extra`` (one row per stratum) supplies columns ``segment`` reads.
    """
    stratum = stratum or []
    rows = _bucketed(df, seed, keys)
    offsets = _offsets(rows, stratum)
    helpers = []
    if extra is not None:
        helpers = [c for c in extra.columns if c not in stratum]
        offsets = offsets.join(F.broadcast(extra), stratum)
    first, last = segment(F.col("_lo") + 1), segment(F.col("_hi"))
    offsets = offsets.withColumns({"_whole": first.eqNullSafe(last), "_segment": first})
    placed = rows.join(F.broadcast(offsets), [*stratum, "_bucket"])
    whole = placed.where("_whole").select(*df.columns, F.col("_segment").alias(name))
    split = placed.where(~F.col("_whole")).withColumn("_position", F.col("_lo") + _in_bucket(stratum, keys))
    split = split.select(*df.columns, segment(F.col("_position")).alias(name))
    return whole.unionByName(split)


def seeded_take(
    df: DataFrame,
    seed: object,
    keys: list[str],
    n: Column,
) -> DataFrame:
    """Exactly the ``n`` first rows of the md5 order (all of them if there are fewer)."""
    cut = seeded_cut(df, seed, keys, lambda p: F.when(p <= n, F.lit(1)).otherwise(F.lit(2)), "_taken")
    return cut.where(F.col("_taken") == 1).drop("_taken")


def seeded_shuffle(df: DataFrame, seed: object, keys: list[str]) -> DataFrame:
    """All rows in md5 order: a range-partitioned sort."""
    ordered = df.withColumn("_order", hashing.digest(seed, *keys))
    return ordered.orderBy("_order", *keys).drop("_order")


def running_totals(
    grouped: DataFrame, by: list[str], sums: list[str], descending: bool = False
) -> DataFrame:
    """Inclusive running totals of ``sums`` in the order of ``by``, as ``cum_*`` columns.

    ``by`` must tell the rows apart. The rows are cut into ordered slices by range, and the slices are
    written, so that the second pass sees the same ones; the number of the slice stays as ``_slice``.
    Totals of whole slices (a row per slice) are then added to totals inside a slice.
    """
    order = [F.desc(c) if descending else F.asc(c) for c in by]
    sliced = materialise(
        grouped.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sliced.groupBy("_slice").agg(*[F.sum(s).alias(s) for s in sums]).select(
        "_slice", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_start_{s}") for s in sums]
    )
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return sliced.join(F.broadcast(starts), "_slice").select(
        *grouped.columns,
        "_slice",
        *[(F.col(f"_start_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums],
    )


def dense_codes(values: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Distinct values of a column with their 0-based place in sorted order."""
    ones = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("one", F.lit(1))
    totals = running_totals(ones, [column], ["one"])
    return totals.select(column, (F.col("cum_one") - 1).alias(name))
