"""The rows before a cutoff, and the moment that windows and recencies count from."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import timeparts


@dataclass(frozen=True)
class History:
    """Log rows with their ``hour``, and their ``age`` in seconds before the reference moment."""

    rows: DataFrame

    @staticmethod
    def within(days: int) -> Column:
        """Whether a row lies in the last ``days`` days, the edge included."""
        return F.col("age") <= days * timeparts.DAY


def before(log: DataFrame, as_of: datetime | None) -> DataFrame:
    return log if as_of is None else log.where(F.col("time") < timeparts.naive(as_of))


def last_moment(rows: DataFrame) -> Column:
    """The latest time of ``rows`` as an uncorrelated scalar subquery: one value, no join."""
    return rows.agg(timeparts.epoch_seconds(F.max("time")).alias("latest")).scalar()


def require_nonempty(df: DataFrame) -> DataFrame:
    """Fail on an empty input: a job that stops at the first row."""
    if df.isEmpty():
        raise ValueError("no rows before the cutoff")
    return df


def open_history(
    log: DataFrame,
    as_of: datetime | None = None,
    now: datetime | None = None,
    required: bool = False,
) -> History:
    """Rows before ``as_of``. ``now`` replaces the scan for the latest time when it is known; with
    ``required`` an empty history fails at once."""
    rows = before(log, as_of)
    if required:
        require_nonempty(rows)
    if now is None:
        moment = last_moment(rows)
    else:
        moment = timeparts.epoch_seconds(timeparts.naive(now))
    age = moment - timeparts.epoch_seconds("time")
    return History(rows.withColumns({"hour": F.hour("time"), "age": age}))
