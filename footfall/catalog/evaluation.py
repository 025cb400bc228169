"""Models and evaluation. Metrics are checked on a fixed score, fits by what must agree with them."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.catalog import sql
from footfall.catalog.registry import TRAIN_AS_OF, baseline, grid, matrices, open_log, prepared, query
from footfall.operators import boosting, metrics, models
from footfall.operators.models import SECOND
from footfall.plans import experiments
from footfall.schema import RATIOS

# A fixed score: an item's share of buys among its views and buys.
_SCORED = f"""{sql.full_table()},
scored AS (SELECT label, coalesce(buy_count_x::DOUBLE / nullif(buy_count_x + total_pv_x, 0), 0) AS score,
  (coalesce(buy_count_x::DOUBLE / nullif(buy_count_x + total_pv_x, 0), 0) > 0.5)::INTEGER AS prediction FROM ft)"""


def _scored(spark, sf):
    table = prepared(spark, sf).table
    share = F.try_divide(F.col("buy_count_x").cast("double"), F.col("buy_count_x") + F.col("total_pv_x"))
    return metrics.predict(table.select("label", F.coalesce(share, F.lit(0.0)).alias("score")))


@query("m5_predict_at_half", sql.with_(_SCORED, "SELECT label, score, prediction FROM scored"))
def _m5(spark, sf):
    return _scored(spark, sf)


@query("m6_confusion", sql.with_(_SCORED, "SELECT label, prediction, count(*) AS rows FROM scored GROUP BY ALL"))
def _m6(spark, sf):
    return metrics.confusion(_scored(spark, sf))


@query("m7_precision_recall_f1", sql.with_(_SCORED, """
SELECT coalesce(tp::DOUBLE / nullif(called, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(actual, 0), 0) AS recall,
  coalesce((2 * tp)::DOUBLE / nullif(called + actual, 0), 0) AS f1
FROM (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE prediction = 1) AS called, count(*) FILTER (WHERE label = 1) AS actual FROM scored)"""))
def _m7(spark, sf):
    return metrics.precision_recall(_scored(spark, sf))


@query("m8_roc_auc", sql.with_(_SCORED, """
SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)::DOUBLE / count(*) AS auc
FROM (SELECT score FROM scored WHERE label = 1) p, (SELECT score FROM scored WHERE label = 0) n"""))
def _m8(spark, sf):
    return metrics.auc(_scored(spark, sf))


_CURVE = f"""{_SCORED},
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM scored GROUP BY score),
c AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
  row_number() OVER w AS rn, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
  FROM g WINDOW w AS (ORDER BY score DESC))"""
_POINTS = """
SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 'Infinity'::DOUBLE AS threshold UNION ALL
SELECT fp::DOUBLE / n::DOUBLE, tp::DOUBLE / p::DOUBLE, score FROM c"""


@query("m9_roc_curve", sql.with_(_CURVE, _POINTS + """
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"""))
def _m9(spark, sf):
    return metrics.roc(_scored(spark, sf))


@query("m9_roc_curve_every_threshold", sql.with_(_CURVE, _POINTS))
def _m9_all(spark, sf):
    return metrics.roc(_scored(spark, sf), corners_only=False)


@query("m13_log_loss", sql.with_(_SCORED, """
SELECT round(avg(CASE WHEN label = 1 THEN -ln(least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
  ELSE -ln(1 - least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) END), 6) AS log_loss
FROM scored"""))
def _m13(spark, sf):
    return metrics.log_loss(_scored(spark, sf)).select(F.round("log_loss", 6).alias("log_loss"))


# Fits have no SQL. Their queries give what SQL can know (rows and positives of validation, class counts) and whether two
# independent computations agree: our AUC and log loss with MLlib's evaluator and the model's own loss, the area under
# our ROC points with our AUC, a gradient with 0, a stopping round with the losses.
_AGREES = """
SELECT count(*) AS rows, sum(label)::BIGINT AS positives, TRUE AS auc_agrees, TRUE AS loss_agrees FROM valid"""


def _near(a: float, b: float, tolerance: float = 1e-6) -> bool:
    return abs(a - b) <= tolerance


def _agreement(spark, scored, loss: float):
    kept = metrics.kept_scores(scored)
    ours = metrics.summary(kept).first()
    theirs = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(kept)
    return kept.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("bigint").alias("positives"),
        F.lit(_near(ours.auc, theirs)).alias("auc_agrees"), F.lit(_near(ours.log_loss, loss)).alias("loss_agrees"),
    )


@query("m1_boosted_trees", sql.with_(sql.full_split(), _AGREES))
def _m1(spark, sf):
    """Fit without early stopping, scored on validation."""
    m = matrices(spark, sf)
    model = models.fit_boosting(m.train)
    return _agreement(spark, models.score(model, m.val), models.losses(model, m.val)[-1])


@query("m3_boosted_trees_second", sql.with_(sql.full_split(), _AGREES))
def _m3(spark, sf):
    m = matrices(spark, sf)
    model = models.fit_boosting(m.train, SECOND)
    return _agreement(spark, models.score(model, m.val), models.losses(model, m.val)[-1])


_PATIENCE = 5


@query("m2_early_stopping", sql.with_(sql.history(TRAIN_AS_OF), f"""
SELECT max(low) FILTER (WHERE place = stop) AS best, any_value(stop) AS stopped, TRUE AS fit_agrees
FROM (SELECT *, coalesce(min(place) FILTER (WHERE place - low >= {_PATIENCE}) OVER (), max(place) OVER ()) AS stop FROM (
  SELECT place, max(place) FILTER (WHERE lower) OVER (ORDER BY place) AS low FROM (
    SELECT place, coalesce(loss < min(loss) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS lower
    FROM (SELECT hour(time) + 1 AS place, count(*) AS loss FROM h GROUP BY ALL))))"""))
def _m2(spark, sf):
    """The patience rule over a series of the log's own (its rows by hour of day), and over the fit's losses."""
    hours = open_log(spark, sf, TRAIN_AS_OF).rows.groupBy(F.hour("time").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    series = [r.n for r in hours.orderBy("hour").collect()]
    best = models.best_round(series, _PATIENCE)
    fit, _ = baseline(spark, sf)
    rounds = fit.model.getNumTrees
    agrees = models.best_round(fit.losses) == rounds and len(fit.losses) == min(rounds + 10, models.MAIN.rounds) == fit.run.getNumTrees
    return spark.createDataFrame(
        [(best, min(best + _PATIENCE, len(series)), agrees)], "best long, stopped long, fit_agrees boolean"
    )


@query("m4_logistic_regression", sql.with_(sql.full_split(), """
SELECT count(*) AS rows, sum(label)::BIGINT AS positives, TRUE AS auc_agrees, TRUE AS loss_agrees, TRUE AS at_optimum FROM valid"""))
def _m4(spark, sf):
    """At the fitted weights the gradient of the penalised loss is 0, measured against each feature's own size."""
    m = matrices(spark, sf)
    rows = m.train.count()
    model = models.fit_logistic(m.train, rows)
    fitted = models.score(model, m.train).select((F.col("score") - F.col("label")).alias("gap"), vector_to_array("features").alias("x"))
    sums = fitted.agg(*[
        F.struct(F.avg(F.col("gap") * F.col("x")[i]).alias("pull"), F.sqrt(F.avg(F.col("x")[i] ** 2)).alias("size")).alias(f"f{i}")
        for i in range(len(m.features))
    ]).first()
    off = [abs(s.pull + w / rows) / max(s.size, 1e-12) for s, w in zip(sums, model.coefficients.toArray())]
    scored = models.score(model, m.val)
    positive = F.col("label") == 1
    margin = F.col("margin")
    own = model.transform(m.val).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    loss = own.agg(F.avg(F.log1p(F.exp(F.when(positive, -margin).otherwise(margin))))).first()[0]
    return _agreement(spark, scored, loss).withColumn("at_optimum", F.lit(max(off) < 1e-3))


@query("m10_learning_curve", sql.with_(sql.full_split(), """
SELECT 'train' AS split, count(*) AS rows, TRUE AS complete, TRUE AS last_agrees FROM train UNION ALL
SELECT 'val', count(*), TRUE, TRUE FROM valid"""))
def _m10(spark, sf):
    """Losses of every round run, the patience rounds after the best included; the last is that of the model of all rounds."""
    fit, _ = baseline(spark, sf)
    m = matrices(spark, sf)
    sets = {"train": m.train, "val": m.val}
    curve = models.learning_curve(fit.run, sets).collect()
    rows = []
    for name, df in sets.items():
        losses = [r.log_loss for r in sorted(curve, key=lambda r: r.round) if r.split == name]
        own = metrics.log_loss(models.score(fit.run, df)).first()[0]
        rows.append((name, df.count(), len(losses) == len(fit.losses), _near(losses[-1], own)))
    return spark.createDataFrame(rows, "split string, rows long, complete boolean, last_agrees boolean")


def _areas(out: experiments.Outputs, name: str) -> dict[str, bool]:
    """Whether the area under each named ROC curve is the AUC beside it."""
    step = W.partitionBy(name).orderBy("fpr", "tpr")
    strip = (F.col("fpr") - F.lag("fpr").over(step)) * (F.col("tpr") + F.lag("tpr").over(step)) / 2
    area = out.roc.withColumn("strip", strip).groupBy(name).agg(F.sum("strip").alias("area"))
    return {r[0]: _near(r.area, r.auc) for r in area.join(out.metrics, name).collect()}


@query("m11_model_comparison", sql.with_(sql.full_split(), """
SELECT m AS "Model", count(*) AS rows, sum(label)::BIGINT AS positives, TRUE AS area_agrees
FROM valid, (SELECT unnest(['Logistic Regression', 'Boosted trees, second', 'Boosted trees, main']) AS m) GROUP BY m"""))
def _m11(spark, sf):
    out = experiments.compare_fully(matrices(spark, sf))
    agrees = spark.createDataFrame(list(_areas(out, "Model").items()), "Model string, area_agrees boolean")
    counts = out.confusion.groupBy("Model").agg(
        F.sum("rows").alias("rows"), F.sum(F.when(F.col("label") == 1, F.col("rows")).otherwise(0)).alias("positives")
    )
    return counts.join(agrees, "Model").select("Model", "rows", "positives", "area_agrees")


def _grid_sql() -> str:
    cases = ["SELECT 'baseline' AS experiment, n0, n1 FROM cnt"]
    for ratio in RATIOS:
        cases += [
            f"SELECT 'smote_{ratio:.1f}', n0, n1 + floor(n0 * {ratio}::DOUBLE - n1)::BIGINT FROM cnt",
            f"SELECT 'oversampling_{ratio:.1f}', n0, greatest(floor(n0 * {ratio}::DOUBLE)::BIGINT, n1) FROM cnt",
            f"SELECT 'undersampling_{ratio:.1f}', least(floor(n1 / {ratio}::DOUBLE)::BIGINT, n0), n1 FROM cnt",
        ]
    return sql.with_(f"""{sql.full_split()},
cnt AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM train),
cases AS ({' UNION ALL '.join(cases)})""", """
SELECT experiment, n0 AS negatives, n1 AS positives, (SELECT count(*) FROM valid) AS validated, TRUE AS area_agrees FROM cases""")


@query("m12_rebalancing_grid", _grid_sql())
def _m12(spark, sf):
    """Class counts of each rebalanced set, the validation rows scored, and whether the area under the ROC points is the AUC."""
    found = grid(spark, sf)
    curve = metrics.curves(found.scored, "experiment")
    step = W.partitionBy("experiment").orderBy("cum_neg", "cum_pos")
    width = F.col("cum_neg") - F.coalesce(F.lag("cum_neg").over(step), F.lit(0))
    height = (F.col("cum_pos") + F.coalesce(F.lag("cum_pos").over(step), F.lit(0))) / 2
    area = curve.withColumn("strip", width * height).groupBy("experiment").agg(
        F.try_divide(F.sum("strip"), F.sum("pos") * F.sum("neg")).alias("area"), F.sum(F.col("pos") + F.col("neg")).alias("validated")
    )
    return found.sizes.join(area, "experiment").join(found.metrics, "experiment").select(
        "experiment", "negatives", "positives", "validated", (F.abs(F.col("area") - F.col("auc")) < 1e-9).alias("area_agrees")
    )


# What a fit gives has no SQL; tests hold it against a plain booster.


@query("m12_grid_metrics")
def _m12_metrics(spark, sf):
    """Precision, recall, F1, AUC and log loss of every experiment."""
    return grid(spark, sf).metrics


@query("m10_grid_losses")
def _m10_grid(spark, sf):
    """Loss of train and validation after every round of every experiment, the kept round marked."""
    return grid(spark, sf).losses


@query("m1_tree_nodes")
def _m1_nodes(spark, sf):
    """The trees of every experiment, a row per node."""
    found = grid(spark, sf)
    return boosting.nodes(found.fit, spark, found.names)
