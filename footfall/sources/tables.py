"""Feature tables, splits, metrics and models on disk."""

from __future__ import annotations

from pyspark.ml.util import MLReadable
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` in the expected column order; fails on a missing column or another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in expected.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"columns missing or of another type: {', '.join(wrong)}")
    return df.select(*expected.fieldNames())


def write_table(df: DataFrame, path: str, expected: T.StructType | None = None) -> None:
    """Replace a table's content."""
    rows = check_schema(df, expected) if expected is not None else df
    rows.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, expected: T.StructType | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return check_schema(rows, expected) if expected is not None else rows


def write_counted(df: DataFrame, path: str, **counts: Column) -> dict[str, object]:
    """Replace a table's content and return aggregates of the rows written, from the same job.

    They are taken in the tasks that write, once for each task that succeeded, so a lost executor counts nothing twice.
    Aggregates over no rows are as in SQL: counts are 0, others None.
    """
    watch = Observation()
    df.observe(watch, *[c.alias(name) for name, c in counts.items()]).write.mode("overwrite").parquet(path)
    return watch.get


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Replace a catalogue table, kept at ``path``, bucketed and sorted by its key.

    Joins on the key then read its rows where they lie; only the other side is shuffled, into as many partitions as there
    are buckets. Take at least ``spark.sql.shuffle.partitions`` buckets, as Spark shuffles fewer ones again, and as many as keep a
    bucket within an executor's memory. Rows are brought into buckets first, so that a bucket is one file.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, expected: T.StructType) -> DataFrame:
    return spark.read.schema(expected).option("header", True).csv(path)


def metrics_long(row: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row of metrics as (Metric, Value) rows; ``names`` maps columns to the names shown."""
    pairs = [
        F.struct(F.lit(shown).alias("Metric"), F.col(column).cast("double").alias("Value"))
        for column, shown in names.items()
    ]
    return row.select(F.inline(F.array(*pairs)))


def write_metrics(df: DataFrame, path: str) -> None:
    """A metrics table has a row per metric or per model, so one file holds it."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type[MLReadable], path: str):
    return kind.load(path)
