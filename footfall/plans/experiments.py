"""Feature choice by a first model, the rebalancing grid, and the comparison of classifiers."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators import boosting, metrics, models, rebalance, selection
from footfall.operators.models import MAIN, SECOND, Boosting, Stopped
from footfall.plans.pipeline import Splits, first_two_steps
from footfall.schema import RATIOS, SEED
from footfall.session import materialise, materialise_all, scratch_path
from footfall.sources import tables


@dataclass(frozen=True)
class Matrices:
    """Selected features and the train and validation sets with their vectors, written."""

    features: list[str]
    train: DataFrame
    val: DataFrame


def _vector_tables(parts: Splits, features: list[str]) -> list[DataFrame]:
    return materialise_all({
        "train": models.vectors(parts.train, features), "val": models.vectors(parts.val, features),
    })


def encoded(parts: Splits, columns: list[str]) -> Splits:
    """The parts with the text columns among ``columns`` replaced by codes of the values train holds."""
    for column in selection.text_columns(parts.train, columns):
        made = [selection.encode(parts.train, part, column) for part in (parts.train, parts.val, parts.test)]
        parts = Splits(*made)
    return parts


def choose_features(parts: Splits, config: Boosting = MAIN, kind: str = "split") -> list[str]:
    """Filters, then the features carrying 95% of a first model's importance (its splits, unless ``kind`` is gain)."""
    kept = first_two_steps(parts.train)
    train, val = _vector_tables(encoded(parts, kept), kept)
    model = models.fit_with_patience(train, val, config)
    ranked = selection.select_by_share(selection.importance(model, kept, kind))
    return [r.feature for r in ranked.orderBy("place").collect()]


@dataclass(frozen=True)
class Selection:
    """The chosen list after the leakage list, and the train and validation sets of it, saved."""

    features: list[str]
    folder: str


def save_selection(parts: Splits, features: list[str], folder: str) -> Selection:
    """Writes ``features.csv``, ``train.csv`` and ``val.csv`` under a folder, as CSV with a header."""
    kept = selection.drop_leaky(features)
    parts = encoded(parts, kept)
    listed = parts.train.sparkSession.createDataFrame([(f,) for f in kept], "feature string")
    tables.write_csv(listed, f"{folder}/features.csv")
    for name, part in (("train", parts.train), ("val", parts.val)):
        tables.write_csv(part.select(*kept, "label"), f"{folder}/{name}.csv")
    return Selection(kept, folder)


def matrices(parts: Splits, features: list[str]) -> Matrices:
    return Matrices(features, *_vector_tables(encoded(parts, features), features))


def resampled(m: Matrices, method: str, ratio: float, seed: object = SEED) -> DataFrame:
    """The train set after one rebalancing method, with vectors."""
    plain = m.train.drop("features")
    if method == "smote":
        rows = rebalance.smote(plain, m.features, ratio, seed=seed)
    elif method == "oversampling":
        rows = rebalance.oversample(plain, ratio, seed)
    elif method == "undersampling":
        rows = rebalance.undersample(plain, ratio, seed)
    else:
        return m.train
    return models.vectors(rows, m.features)


def evaluate(m: Matrices, train: DataFrame, config: Boosting = MAIN) -> tuple[Stopped, DataFrame]:
    """A fit with early stopping, and the validation set scored by its model, written."""
    fit = models.stop_early(train, m.val, config)
    return fit, metrics.kept_scores(models.score(fit.model, m.val))


GRID_METRICS = {"recall": "Recall", "f1": "F1", "auc": "AUC"}
GRID = [("baseline", 0.0)] + [
    (method, ratio) for method in ("smote", "oversampling", "undersampling") for ratio in RATIOS
]


def experiment_name(method: str, ratio: float) -> str:
    return method if method == "baseline" else f"{method}_{ratio:.1f}"


@dataclass(frozen=True)
class Outputs:
    """What experiments or compared models leave: long tables by name, and the folders of models and resampled sets."""

    metrics: DataFrame
    confusion: DataFrame
    roc: DataFrame
    resampled: DataFrame
    models: dict[str, str]


def _together(frames: dict[str, DataFrame], column: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias(column), "*") for n, df in frames.items()])


def run_grid_fully(m: Matrices, config: Boosting = MAIN, parallelism: int = 6, folder: str | None = None) -> Outputs:
    """The baseline and every method and ratio: metrics, confusion, ROC points, class counts, models and resampled sets.

    The neighbour lists of SMOTE depend on train alone and are computed once. Experiments are independent, so a few
    are submitted at once, as cross-validation does. Validation is scored once per experiment. Models and resampled sets lie under
    ``folder``, or the run's own.
    """
    spark = m.train.sparkSession
    folder = folder or scratch_path(spark, "grid")
    plain = m.train.drop("features")
    lists = rebalance.prepare_smote(plain, m.features)

    def one(case: tuple[str, float]) -> tuple[str, dict[str, DataFrame]]:
        method, ratio = case
        name = experiment_name(method, ratio)
        rows = rebalance.smote(plain, m.features, ratio, prepared=lists) if method == "smote" else None
        made = m.train if method == "baseline" else (
            models.vectors(rows, m.features) if rows is not None else resampled(m, method, ratio)
        )
        made.write.parquet(f"{folder}/{name}/train")
        train = spark.read.parquet(f"{folder}/{name}/train")
        fit, scored = evaluate(m, train, config)
        tables.save_model(fit.model, f"{folder}/{name}/model")
        curve = metrics.by_score(scored)
        counts = train.groupBy(F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
        return name, {
            "metrics": metrics.summary(scored), "confusion": metrics.confusion(scored),
            "roc": metrics.roc(scored, curve), "resampled": counts,
        }

    with ThreadPoolExecutor(parallelism) as pool:
        found = dict(pool.map(one, GRID))
    written = materialise_all({
        part: _together({n: f[part] for n, f in found.items()}, "experiment") for part in ("metrics", "confusion", "roc", "resampled")
    })
    return Outputs(*written, {n: f"{folder}/{n}/model" for n in found})


def run_grid(m: Matrices, config: Boosting = MAIN, parallelism: int = 6) -> DataFrame:
    """(experiment, Metric, Value) for the baseline and every method and ratio."""
    return long_metrics(run_grid_fully(m, config, parallelism).metrics)


@dataclass(frozen=True)
class Grid:
    """All experiments of one boosting run: metrics, losses by round, scored validation rows, set sizes, and the fit."""

    metrics: DataFrame
    losses: DataFrame
    scored: DataFrame
    sizes: DataFrame
    fit: boosting.Fit
    names: list[str]


def run_grid_together(m: Matrices, config: boosting.Growth = boosting.Growth(), ratios: list[float] = RATIOS) -> Grid:
    """The baseline and every method and ratio in one boosting run over one table, rebalanced by weights.

    Each pass over the rows serves all experiments; validation is scored once.
    """
    plain = m.train.drop("features")
    rows, cases = rebalance.grid_weights(plain, m.features, ratios)
    rows = materialise(rows, "weighted")
    names = [experiment_name(*c) for c in cases]
    fit = boosting.fit(rows, m.val.drop("features"), m.features, len(cases), config)
    scored = materialise(boosting.scores(fit, m.val.drop("features"), ["label"], names), "scored")
    shown = F.array(*[F.lit(n) for n in names])
    sizes = rows.select("label", F.posexplode("weights").alias("_e", "w")).groupBy(F.get(shown, F.col("_e")).alias("experiment")).agg(
        F.sum(F.when(F.col("label") == 0, F.col("w")).otherwise(0)).alias("negatives"),
        F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0)).alias("positives"),
    )
    losses = [
        (name, i + 1, a, b, i + 1 == fit.best[e])
        for e, name in enumerate(names) for i, (a, b) in enumerate(zip(fit.train_losses[e], fit.val_losses[e]))
    ]
    kinds = "experiment string, round int, train_loss double, val_loss double, best boolean"
    listed = rows.sparkSession.createDataFrame(losses, kinds)
    return Grid(metrics.summaries(scored, "experiment"), listed, scored, sizes, fit, names)


def long_metrics(wide: DataFrame) -> DataFrame:
    values = F.array(*[
        F.struct(F.lit(label).alias("Metric"), F.col(column).alias("Value")) for column, label in GRID_METRICS.items()
    ])
    return wide.select("experiment", F.inline(values))


def compare_fully(
    m: Matrices, main: Boosting = MAIN, second: Boosting = SECOND, parallelism: int = 3, folder: str | None = None
) -> Outputs:
    """Logistic regression and two boosted-tree configurations: metrics, confusion, ROC points and saved models."""
    spark = m.train.sparkSession
    folder = folder or scratch_path(spark, "comparison")
    rows = m.train.count()
    fits: dict[str, Callable] = {
        "Logistic Regression": lambda: models.fit_logistic(m.train, rows),
        "Boosted trees, second": lambda: models.fit_boosting(m.train, second),
        "Boosted trees, main": lambda: models.fit_with_patience(m.train, m.val, main),
    }

    def one(name: str) -> tuple[str, dict[str, DataFrame]]:
        model = fits[name]()
        tables.save_model(model, f"{folder}/{name.replace(' ', '_').replace(',', '')}")
        scored = metrics.kept_scores(models.score(model, m.val))
        counts = scored.groupBy(F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
        return name, {
            "metrics": metrics.summary(scored), "confusion": metrics.confusion(scored),
            "roc": metrics.roc(scored), "resampled": counts,
        }

    with ThreadPoolExecutor(parallelism) as pool:
        found = dict(pool.map(one, fits))
    written = materialise_all({
        part: _together({n: f[part] for n, f in found.items()}, "Model") for part in ("metrics", "confusion", "roc", "resampled")
    })
    return Outputs(*written, {n: f"{folder}/{n.replace(' ', '_').replace(',', '')}" for n in found})


def compare(m: Matrices, main: Boosting = MAIN, second: Boosting = SECOND, parallelism: int = 3) -> DataFrame:
    """Precision, recall, F1 and AUC of logistic regression and two boosted-tree configurations."""
    return compare_fully(m, main, second, parallelism).metrics.select(
        "Model", F.col("precision").alias("Precision"), F.col("recall").alias("Recall"),
        F.col("f1").alias("F1-score"), F.col("auc").alias("ROC-AUC"),
    )
