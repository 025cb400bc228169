"""Evaluation of scored rows: ``label`` 0/1, ``prediction`` 0/1, ``score`` the positive probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.operators.ranking import running_totals
from footfall.session import materialise

CLIP = 2.0**-52


def predict(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("prediction", (F.col("score") > threshold).cast("int"))


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _class_rates() -> list[Column]:
    """Precision, recall and F1 of the positive class as aggregates; 0 where undefined."""
    hits = F.count_if((F.col("label") == 1) & (F.col("prediction") == 1))
    called, actual = F.count_if(F.col("prediction") == 1), F.count_if(F.col("label") == 1)
    return [
        _or_zero(hits, called).alias("precision"),
        _or_zero(hits, actual).alias("recall"),
        _or_zero(hits * 2, called + actual).alias("f1"),
    ]


def precision_recall(scored: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the positive class; 0 where undefined."""
    return scored.agg(*_class_rates())


def mean_loss() -> Column:
    p = F.least(F.greatest(F.col("score"), F.lit(CLIP)), F.lit(1 - CLIP))
    return F.avg(F.when(F.col("label") == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))).alias("log_loss")


def log_loss(scored: DataFrame) -> DataFrame:
    return scored.agg(mean_loss())


def by_score(scored: DataFrame) -> DataFrame:
    """Positives and negatives at each distinct score, with running totals from the highest down."""
    grouped = scored.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    return running_totals(grouped, ["score"], ["pos", "neg"], descending=True)


def auc(scored: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """Area under the ROC curve, tied pairs counted half; NULL unless both classes occur.

    Without a curve from by_score, one is written while this is built.
    """
    curve = by_score(scored) if curve is None else curve
    below = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))
    area = F.sum(below)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return curve.agg(F.try_divide(area, pairs).alias("auc"))


def _corners(curve: DataFrame) -> DataFrame:
    """Without the points inside a straight run: those whose step equals the next one's.

    The first and last points stay. A point's next step may lie in the next slice, so the first step of
    each slice is handed to the slice before it.
    """
    inside = W.partitionBy("_slice").orderBy(F.desc("score"))
    heads = curve.groupBy("_slice").agg(
        F.max_by("pos", "score").alias("_head_pos"), F.max_by("neg", "score").alias("_head_neg")
    )
    onward = W.orderBy("_slice")
    heads = heads.select(
        "_slice",
        F.lead("_head_pos").over(onward).alias("_head_pos"),
        F.lead("_head_neg").over(onward).alias("_head_neg"),
    )
    stepped = curve.join(F.broadcast(heads), "_slice").withColumns({
        "_next_pos": F.coalesce(F.lead("pos").over(inside), F.col("_head_pos")),
        "_next_neg": F.coalesce(F.lead("neg").over(inside), F.col("_head_neg")),
    })
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    straight = (F.col("_next_pos") == F.col("pos")) & (F.col("_next_neg") == F.col("neg"))
    return stepped.where(first | ~F.coalesce(straight, F.lit(False)))


def roc(scored: DataFrame, curve: DataFrame | None = None, corners_only: bool = True) -> DataFrame:
    """Points (fpr, tpr, threshold) from the highest score down, after the origin at infinity.

    Without a curve from by_score, one is written while this is built.
    """
    curve = by_score(scored) if curve is None else curve
    points = _corners(curve) if corners_only else curve
    sums = curve.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    positives, negatives = sums.select("p").scalar(), sums.select("n").scalar()
    drawn = points.select(
        F.try_divide(F.col("cum_neg").cast("double"), negatives.cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), positives.cast("double")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = curve.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return origin.unionByName(drawn)


def kept_scores(scored: DataFrame) -> DataFrame:
    """What the metrics read of a scored set, written once, so that the model scores it once."""
    return materialise(scored.select("label", "prediction", "score"), "scored")


def summary(scored: DataFrame) -> DataFrame:
    """One row: precision, recall, f1, auc, log_loss. Writes the scores and their curve while it is built."""
    kept = kept_scores(scored)
    return kept.agg(*_class_rates(), mean_loss()).select(
        "precision", "recall", "f1", auc(kept).scalar().alias("auc"), "log_loss"
    )


def curves(scored: DataFrame, by: str) -> DataFrame:
    """As :func:`by_score` for every value of a column at once, each with running totals of its own."""
    grouped = scored.groupBy(by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    every = running_totals(grouped, [by, "score"], ["pos", "neg"], descending=True)
    before = every.groupBy(by).agg(*[F.min(F.col(f"cum_{c}") - F.col(c)).alias(f"_before_{c}") for c in ("pos", "neg")])
    return every.join(before, by).select(
        by, "score", "pos", "neg", *[(F.col(f"cum_{c}") - F.col(f"_before_{c}")).alias(f"cum_{c}") for c in ("pos", "neg")]
    )


def summaries(scored: DataFrame, by: str) -> DataFrame:
    """A row per value of a column: precision, recall, f1, auc, log_loss. Writes the curves while it is built."""
    below = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    areas = curves(scored, by).groupBy(by).agg(F.try_divide(F.sum(below), pairs).alias("auc"))
    rates = scored.groupBy(by).agg(*_class_rates(), mean_loss())
    return rates.join(areas, by).select(by, "precision", "recall", "f1", "auc", "log_loss")
