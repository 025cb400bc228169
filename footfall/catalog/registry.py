"""The two dictionaries the entry point hands out, and the inputs queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from footfall.operators import daily, history
from footfall.operators.history import History
from footfall.plans import experiments, pipeline
from footfall.session import materialise, scratch_path
from footfall.sources.log import log_from_events, write_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

AS_OF, LABEL_DAYS = datetime(2024, 1, 30), 1
TRAIN_AS_OF, TRAIN_DAYS = datetime(2024, 1, 24), 7


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def add(name: str, function: Query, sql: str | None = None) -> None:
    query(name, sql)(function)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log(
    spark: SparkSession, sf_dir: str, until: datetime | None = None, since: datetime | None = None
) -> DataFrame:
    return log_from_events(table(spark, sf_dir, "events"), until, since)


def label_log(spark: SparkSession, sf_dir: str, as_of: datetime, days: int) -> DataFrame:
    """The log of the label days alone."""
    return log(spark, sf_dir, as_of + timedelta(days=days), as_of)


def open_log(spark: SparkSession, sf_dir: str, as_of: datetime | None = AS_OF) -> History:
    return history.open_history(log(spark, sf_dir, as_of), as_of)


def build_training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read by every roll-up, so the events' JSON is taken apart once
    past = materialise(log(spark, sf_dir, TRAIN_AS_OF), "history")
    ahead = label_log(spark, sf_dir, TRAIN_AS_OF, TRAIN_DAYS)
    return pipeline.training_table(past, TRAIN_AS_OF, TRAIN_DAYS, label_log=ahead)


@dataclass(frozen=True)
class Prepared:
    """The written training table and what the later steps derive from it."""

    table: DataFrame
    splits: pipeline.Splits


_KEPT: dict[tuple[str, str, str], object] = {}


def _kept(kind: str, spark: SparkSession, sf_dir: str, build: Callable[[], object]):
    """Built once per application and input."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """The training table, written once per application and input, as the pipeline's users would."""

    def build() -> Prepared:
        full = build_training_table(spark, sf_dir)
        return Prepared(full, pipeline.splits(full))

    return _kept("prepared", spark, sf_dir, build)


def matrices(spark: SparkSession, sf_dir: str) -> experiments.Matrices:
    """Train and validation sets of the chosen features."""

    def build() -> experiments.Matrices:
        parts = prepared(spark, sf_dir).splits
        return experiments.matrices(parts, experiments.choose_features(parts))

    return _kept("matrices", spark, sf_dir, build)


def baseline(spark: SparkSession, sf_dir: str):
    """(fit with early stopping, scored validation set) of the baseline, fitted once."""

    def build():
        m = matrices(spark, sf_dir)
        return experiments.evaluate(m, m.train)

    return _kept("baseline", spark, sf_dir, build)


def grid(spark: SparkSession, sf_dir: str) -> experiments.Grid:
    """All rebalancing experiments, run together once."""
    return _kept("grid", spark, sf_dir, lambda: experiments.run_grid_together(matrices(spark, sf_dir)))


def rollups_by_day(spark: SparkSession, sf_dir: str) -> daily.Rollups:
    """The roll-ups as of the cutoff from a store of days: the older ones merged, the last day added from its part of the log."""

    def build() -> str:
        log_path, store = scratch_path(spark, "log"), scratch_path(spark, "days")
        last = AS_OF - timedelta(days=1)
        write_log(log(spark, sf_dir, AS_OF), log_path)
        daily.add_days(log(spark, sf_dir, last), store)
        daily.merge_days(spark, store, (AS_OF - timedelta(days=10)).date())
        daily.add_day(spark, log_path, store, last.date())
        return store

    return daily.rollups(spark, _kept("days", spark, sf_dir, build), AS_OF)


def forget() -> None:
    """Drop what was prepared, so that the next query builds it again."""
    _KEPT.clear()
