"""Joins with the reference names, semantics and skew in mind.

No side is hinted for broadcast here. Tables read back from disk carry their size, and Catalyst
broadcasts those below its threshold by itself; larger ones are shuffled, where adaptive execution
splits the partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys are not in ``right``."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def lookup(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left join on a key that is unique in ``right``; names in both sides get a suffix each."""
    clash = (set(left.columns) & set(right.columns)) - {key}
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return a.join(b, key, "left").select(*a.columns, *[c for c in b.columns if c != key])


def semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys are in ``right``."""
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def argmax_ties(counts: DataFrame, key: str, count: str) -> DataFrame:
    """All rows of a key that reach its highest count, by joining the maxima back."""
    top = counts.groupBy(key).agg(F.max(count).alias("_top"))
    return counts.join(top, key).where(F.col(count) == F.col("_top")).drop("_top")
