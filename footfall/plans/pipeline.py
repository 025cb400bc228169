"""From a log to feature tables, a training table and its splits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import assemble, features, history, rollup, selection, split
from footfall.schema import CATEGORY_TABLE, ITEM_TABLE, SEED, USER_TABLE
from footfall.session import materialise, materialise_all
from footfall.sources import tables
from footfall.sources.log import read_log


@dataclass(frozen=True)
class FeatureTables:
    users: DataFrame
    items: DataFrame
    categories: DataFrame


def _written_with(
    log: DataFrame, as_of: datetime, now: datetime | None, others: dict[str, DataFrame]
) -> tuple[FeatureTables, list[DataFrame]]:
    """The feature tables, and other tables written along with the first of their stages."""
    h = history.open_history(log, as_of, now, required=True)
    pair_table, category_table, *rest = materialise_all({
        "pairs": rollup.pairs(h.rows), "user_categories": rollup.user_categories(h.rows), **others,
    })
    users = features.user_features(h, None, pair_table, category_table)
    items = features.item_features(h, None, pair_table)
    categories = features.category_features(h, None, category_table)
    written = materialise_all({
        "user_feature": tables.check_schema(users, USER_TABLE),
        "item_feature": tables.check_schema(items, ITEM_TABLE),
        "category_feature": tables.check_schema(categories, CATEGORY_TABLE),
    })
    return FeatureTables(*written), rest


def feature_tables(log: DataFrame, as_of: datetime, now: datetime | None = None) -> FeatureTables:
    """The three feature tables, each written once.

    The pair table serves users and items, and the (user, category) table users and categories, so both
    are written first and the log is not grouped that way again.
    """
    return _written_with(log, as_of, now, {})[0]


def sampled_base(
    log: DataFrame, as_of: datetime, days: int, ratio: int = 10, seed: object = SEED,
    label_log: DataFrame | None = None,
) -> DataFrame:
    """Labelled candidates with ``ratio`` negatives per positive. The labelled pairs are written first,
    because the sample reads them for its counts and again for its rows."""
    labelled = materialise(assemble.labelled(log, as_of, days, label_log), "labelled")
    return assemble.sample_negatives(labelled, ratio, seed)


def training_table(
    log: DataFrame, as_of: datetime, days: int = 1, ratio: int = 10, seed: object = SEED,
    label_log: DataFrame | None = None,
) -> DataFrame:
    """Sampled pairs with all features, written."""
    pairs = assemble.labelled(log, as_of, days, label_log)
    t, (labelled,) = _written_with(log, as_of, None, {"labelled": pairs})
    base = assemble.sample_negatives(labelled, ratio, seed)
    return materialise(assemble.feature_table(base, t.users, t.items, t.categories), "feature_table")


def training_table_from(
    spark: SparkSession, path: str, as_of: datetime, days: int = 1, ratio: int = 10, seed: object = SEED
) -> DataFrame:
    """The training table of a log table. History and label days are separate reads, so that each opens
    only its own day partitions."""
    past = read_log(spark, path, until=as_of)
    ahead = read_log(spark, path, since=as_of, until=as_of + timedelta(days=days))
    return training_table(past, as_of, days, ratio, seed, ahead)


@dataclass(frozen=True)
class Splits:
    train: DataFrame
    val: DataFrame
    test: DataFrame


def splits(table: DataFrame, seed: object = SEED) -> Splits:
    """The stratified split, written in a partition per part, so that each part is read alone."""
    cut = materialise(split.stratified_split(table, seed=seed), "splits", by="split")
    parts = [cut.where(F.col("split") == p).drop("split") for p in split.PARTS]
    return Splits(*parts)


def first_two_steps(train: DataFrame) -> list[str]:
    """Model inputs left after the missing, variance and correlation filters."""
    kept = selection.keep_informative(train, selection.inputs(train))
    return selection.drop_redundant(train, kept)
