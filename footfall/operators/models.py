"""Classifiers: boosted trees with a patience rule, and logistic regression."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import SEED
from footfall.session import scratch_path


@dataclass(frozen=True)
class Boosting:
    """Level-wise trees: depth 5 gives at most 32 leaves; ``bins`` are the cut points tried per feature."""

    depth: int = 5
    step: float = 0.1
    rounds: int = 100
    min_rows: int = 20
    bins: int = 255
    seed: int = SEED


MAIN = Boosting()
SECOND = Boosting(depth=6, step=0.3, min_rows=1)


def session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with a ``features`` vector and a double ``label``; unlisted columns stay."""
    typed = df.withColumn("label", F.col("label").cast("double"))
    numbers = typed.withColumns({f"_{i}": F.col(f).cast("double") for i, f in enumerate(features)})
    names = [f"_{i}" for i in range(len(features))]
    ready = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error").transform(numbers)
    return ready.drop(*names)


def fit_boosting(train: DataFrame, config: Boosting = MAIN) -> GBTClassificationModel:
    """``train`` holds ``label`` and ``features``."""
    learner = GBTClassifier(
        maxDepth=config.depth, stepSize=config.step, maxIter=config.rounds,
        minInstancesPerNode=config.min_rows, maxBins=config.bins, seed=config.seed, cacheNodeIds=False,
    )
    return learner.fit(train.select("label", "features"))


def losses(model: GBTClassificationModel, df: DataFrame) -> list[float]:
    """Log loss after each round. The built-in loss is twice the log loss."""
    return [v / 2 for v in model.evaluateEachIteration(df.select("label", "features"))]


def best_round(values: list[float], patience: int = 10) -> int:
    """1-based round of the lowest loss seen before ``patience`` rounds pass without a lower one."""
    best, at = float("inf"), 0
    for number, value in enumerate(values, start=1):
        if value < best:
            best, at = value, number
        elif number - at >= patience:
            break
    return at


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first trees alone. Boosting adds trees one by one, so a shorter fit would give the same ones."""
    if rounds >= model.getNumTrees:
        return model
    java, gateway = model._java_obj, session().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], model.treeWeights[i]
    shorter = ml.classification.GBTClassificationModel(java.uid(), trees, weights)
    return GBTClassificationModel(shorter)


@dataclass(frozen=True)
class Stopped:
    """A fit under the patience rule: the model of the best round, that of all rounds run, and their losses."""

    model: GBTClassificationModel
    run: GBTClassificationModel
    losses: list[float]


def stop_early(
    train: DataFrame, val: DataFrame, config: Boosting = MAIN, patience: int = 10, first: int | None = None
) -> Stopped:
    """Rounds up to ``patience`` after the best one on validation.

    With one seed a shorter fit has the same first trees as a longer one. So a fit of twice the patience (``first`` rounds if
    given) is tried, and one of all rounds where the patience has not run out in it; the first trees are the model. Fits can't be
    continued, so each try between the two would fit its rounds once more.
    """
    rounds = min(first or 2 * patience, config.rounds)
    while True:
        model = fit_boosting(train, replace(config, rounds=rounds))
        values = losses(model, val)
        best = best_round(values, patience)
        if rounds - best >= patience or rounds == config.rounds:
            break
        rounds = config.rounds
    ran = min(best + patience, len(values))
    return Stopped(first_rounds(model, best), first_rounds(model, ran), values[:ran])


def fit_with_patience(
    train: DataFrame, val: DataFrame, config: Boosting = MAIN, patience: int = 10, first: int | None = None
) -> GBTClassificationModel:
    """The model of the best round on validation, found with a patience rule."""
    return stop_early(train, val, config, patience, first).model


def learning_curve(model: GBTClassificationModel, sets: dict[str, DataFrame]) -> DataFrame:
    rows = [
        (name, number, value)
        for name, df in sets.items()
        for number, value in enumerate(losses(model, df), start=1)
    ]
    spark = next(iter(sets.values())).sparkSession
    return spark.createDataFrame(rows, "split string, round int, log_loss double")


def fit_logistic(train: DataFrame, rows: int, iterations: int = 1000):
    """L2 with unit weight on the summed loss, features unscaled.

    The model leaves without the summary of its fit: that holds the session, which no task can be sent once the session has observed
    rows (:func:`footfall.sources.tables.write_counted`).
    """
    learner = LogisticRegression(
        regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, maxIter=iterations
    )
    model = learner.fit(train.select("label", "features"))
    model._java_obj.setSummary(session().sparkContext._jvm.scala.Option.empty())
    return model


def score(model, df: DataFrame) -> DataFrame:
    """``df`` with the positive probability as ``score`` and the class at 0.5 as ``prediction``."""
    out = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return out.withColumn("prediction", F.col("prediction").cast("int")).drop("rawPrediction", "probability")


def tree_nodes(model: GBTClassificationModel) -> DataFrame:
    """The nodes of all trees, read from the saved model: tree, and each node's id, children, split and rows."""
    path = scratch_path(session(), "trees")
    model.write().overwrite().save(path)
    return session().read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")


def split_counts(model: GBTClassificationModel) -> DataFrame:
    """Splits on each feature index."""
    inner = tree_nodes(model).where(F.col("leftChild") >= 0)
    return inner.groupBy(F.col("split.featureIndex").alias("index")).agg(F.count(F.lit(1)).alias("splits"))
