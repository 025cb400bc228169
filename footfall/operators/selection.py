"""Feature selection: fitted on train, applied elsewhere by column list.

Tables here have a row per feature or per pair of features, so their windows and local loops are small
whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators import metrics, models, ranking
from footfall.schema import LEAKY_SELECTED, NOT_INPUTS, SEED


def inputs(df: DataFrame) -> list[str]:
    """The model inputs of a training table, in column order; listed columns that are absent are ignored."""
    return df.drop(*NOT_INPUTS).columns


def _numeric(df: DataFrame, columns: list[str]) -> list[str]:
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in columns if c in numeric]


def _per_column(row: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One wide row as (feature, value) rows."""
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias(name)) for c in columns]))
    )


def _first_by_parts(df: DataFrame, aggregates: list[Column], width: int = 16) -> dict[str, object]:
    """The one row of the named aggregates, ``width`` at a time, each pass reading its own columns."""
    parts = [aggregates[i : i + width] for i in range(0, len(aggregates), width)]
    with ThreadPoolExecutor(4) as pool:
        rows = pool.map(lambda part: df.agg(*part).first().asDict(), parts)
        return {name: value for row in rows for name, value in row.items()}


def missing_ratio(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return _per_column(row, columns, "missing_ratio")


def variances(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Population variance of the numeric columns."""
    columns = _numeric(df, columns or df.columns)
    row = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in columns])
    return _per_column(row, columns, "variance")


def keep_informative(
    df: DataFrame, columns: list[str], variance_above: float = 0.01, missing_below: float = 0.5
) -> list[str]:
    """Columns with few gaps and, if numeric, some variance: numeric ones in order, then the rest sorted."""
    numeric = set(_numeric(df, columns))
    statistics = []
    for i, c in enumerate(columns):
        statistics.append(F.avg(F.col(c).isNull().cast("double")).alias(f"m{i}"))
        if c in numeric:
            statistics.append(F.var_pop(F.col(c).cast("double")).alias(f"v{i}"))
    row = _first_by_parts(df, statistics)
    present = [(i, c) for i, c in enumerate(columns) if (row[f"m{i}"] or 0.0) < missing_below]
    kept = [c for i, c in present if c in numeric and (row[f"v{i}"] or 0.0) > variance_above]
    return kept + sorted(c for _, c in present if c not in numeric)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Absolute Pearson correlations above the diagonal as (i, j, col_i, col_j, corr), in one pass after that for the means.

    A pair with a gap in either column is correlated over the rows that have both; NaN where that leaves no variance.
    Each task adds products of its rows, with gaps as 0 beside a mask, into one block of sums; the blocks meet entry by entry.
    """
    n = len(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    # about the means, so that large values don't cancel
    means = _first_by_parts(numbers, [F.avg(f"c{i}").alias(f"c{i}") for i in range(n)])
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in (means[f"c{i}"] for i in range(n))])
    sums = numbers.mapInArrow(_masked_products(shift), "k int, i int, j int, v double").groupBy("k", "i", "j").agg(F.sum("v").alias("v"))
    count, own, square, product = (np.zeros((n, n)) for _ in range(4))
    blocks = [count, own, square, product]
    for r in sums.collect():  # four numbers per pair of columns
        blocks[r.k][r.i, r.j] = r.v
    rows = []
    for i, j in ((i, j) for i in range(n) for j in range(i + 1, n)):
        m = count[i, j]
        top = m * product[i, j] - own[i, j] * own[j, i]
        spread = [m * square[a, b] - own[a, b] ** 2 for a, b in ((i, j), (j, i))]
        # what rounding leaves of a column without variance is none
        level = min(s / (m * square[a, b]) if square[a, b] > 0 and m > 1 else 0.0 for s, (a, b) in zip(spread, ((i, j), (j, i))))
        value = float("nan") if level <= 1e-12 else min(float(abs(top) / (np.sqrt(spread[0]) * np.sqrt(spread[1]))), 1.0)
        rows.append((i, j, columns[i], columns[j], value))
    return df.sparkSession.createDataFrame(rows, "i int, j int, col_i string, col_j string, corr double")


def _masked_products(shift: np.ndarray):
    """Per task and pair (i, j): rows that have both; over these the sums of i, of its squares, and of i times j."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(shift), len(shift)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) - shift
            has = ~np.isnan(x)
            x = np.where(has, x, 0.0)
            has = has.astype(float)
            total += np.stack([has.T @ has, x.T @ has, (x * x).T @ has, x.T @ x])
        k, i, j = (a.ravel().astype(np.int32) for a in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (k, i, j, total.ravel())], names=["k", "i", "j", "v"])

    return run


def redundant(corr: DataFrame, threshold: float = 0.8, priority: list[str] | None = None) -> DataFrame:
    """Columns to drop: of each strongly correlated pair the earlier one, also if already dropped.

    With ``priority``, a listed column stays and its unlisted partner goes.
    """
    strong = corr.where((F.col("corr") >= threshold) & ~F.isnan("corr"))
    loser = F.col("col_i")
    if priority:
        listed = F.col("col_i").isin(priority) & ~F.col("col_j").isin(priority)
        loser = F.when(listed, F.col("col_j")).otherwise(F.col("col_i"))
    return strong.select(loser.alias("feature")).distinct()


def drop_redundant(
    df: DataFrame, columns: list[str], threshold: float = 0.8, priority: list[str] | None = None
) -> list[str]:
    corr = correlations(df, _numeric(df, columns))
    gone = {r.feature for r in redundant(corr, threshold, priority).collect()}
    return [c for c in columns if c not in gone]


def encode(train: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """``other`` with the text column replaced by its place among the sorted values of train.

    A value that train lacks fails the query.
    """
    codes = ranking.dense_codes(train.withColumn(column, F.col(column).cast("string")), column, "_code")
    unseen = F.raise_error(F.concat(F.lit(f"{column} was not seen in training: "), F.col(column)))
    joined = other.withColumn(column, F.col(column).cast("string")).join(codes, column, "left")
    return joined.withColumn(column, F.coalesce(F.col("_code"), unseen.cast("bigint"))).drop("_code")


def text_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, T.StringType)]


def importance(model, features: list[str], kind: str = "gain") -> DataFrame:
    """Importance per feature: total gain, or the number of splits on it."""
    spark = models.session()
    if kind == "gain":
        values = [float(v) for v in model.featureImportances.toArray()]
        values += [0.0] * (len(features) - len(values))  # features behind the last one that is split on
        return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")
    counts = models.split_counts(model)
    names = spark.createDataFrame(list(enumerate(features)), "index int, feature string")
    return names.join(counts, "index", "left").select(
        "feature", F.coalesce(F.col("splits"), F.lit(0)).cast("double").alias("importance")
    )


def cumulative_share(table: DataFrame) -> DataFrame:
    """Importance sorted downwards with its running share of the total; ties by name."""
    order = W.orderBy(F.desc("importance"), "feature")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    whole = F.sum("importance").over(W.partitionBy())
    return table.select(
        "feature",
        "importance",
        F.row_number().over(order).alias("place"),
        F.try_divide(F.sum("importance").over(upto), whole).alias("cumulative_share"),
    )


def select_by_share(table: DataFrame, share: float = 0.95) -> DataFrame:
    """Features whose running share stays within ``share``; the top one at least."""
    ranked = cumulative_share(table)
    return ranked.where((F.col("cumulative_share") <= share) | (F.col("place") == 1))


def drop_leaky(features: list[str]) -> list[str]:
    return [f for f in features if f not in LEAKY_SELECTED]


def permutation_importance(
    model, df: DataFrame, features: list[str], keys: list[str], repeats: int = 5, seed: object = SEED,
    scorer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rise of the log loss when one feature's values are permuted among the rows.

    ``scorer`` may take the model's place: a score as a column of the array of feature values.

    A repeat has one permutation, used for every feature: rows are placed by two md5 orders and joined
    on the place. All features and repeats are scored in one job.
    """
    data = df.select(*keys, "label", F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    placed = ranking.seeded_rank(data, seed, keys, "place")
    rounds = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    own = placed.select(*keys, "label", "x", "place", rounds)
    other = ranking.seeded_rank(
        data.select(*keys, F.col("x").alias("z"), rounds), f"{seed}-partner", ["repeat", *keys], "place", ["repeat"]
    ).select("repeat", "place", "z")
    index = F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("f")
    mixed = own.join(other, ["repeat", "place"]).select("label", "repeat", "x", "z", index)
    swapped = F.transform("x", lambda v, i: F.when(i == F.col("f"), F.col("z")[i]).otherwise(v))
    rows = mixed.select("label", "repeat", "f", swapped.alias("x"))
    if scorer is None:
        def score(d: DataFrame) -> DataFrame:
            return models.score(model, d.withColumn("features", array_to_vector("x")))
    else:
        def score(d: DataFrame) -> DataFrame:
            return d.withColumn("score", scorer(F.col("x")))
    losses = score(rows).groupBy("f", "repeat").agg(metrics.mean_loss().alias("loss"))
    base = metrics.log_loss(score(data)).first()[0]
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("f") + 1)
    return losses.groupBy(names.alias("feature")).agg(
        F.avg(F.col("loss") - base).alias("importance_mean"),
        F.stddev_pop(F.col("loss") - base).alias("importance_std"),
    )
