"""Class rebalancing of a training set. Draws are seeded and exact in number."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import hashing
from footfall.operators import history, joins, neighbours, ranking
from footfall.operators.assemble import PAIR, ROW
from footfall.schema import CART, FAVOURITE, SEED
from footfall.session import materialise


def class_counts(df: DataFrame) -> tuple[int, int]:
    """(negatives, positives)."""
    row = df.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    return row[0], row[1]


def oversampled_size(negatives: int, positives: int, ratio: float) -> int:
    return max(int(negatives * ratio), positives)


def undersampled_size(negatives: int, positives: int, ratio: float) -> int:
    return negatives if ratio <= 0 else min(int(positives / ratio), negatives)


def _draws(df: DataFrame, n: int) -> DataFrame:
    """``n`` numbered draws, spread over the cluster."""
    return df.sparkSession.range(n).withColumnRenamed("id", "draw")


def oversample(
    df: DataFrame, ratio: float, seed: object = SEED, keys: list[str] | None = None
) -> DataFrame:
    """Positives drawn again with replacement until they are ``ratio`` of the negatives."""
    keys = keys or ROW
    negatives, positives = class_counts(df)
    extra = oversampled_size(negatives, positives, ratio) - positives
    if extra == 0 or positives == 0:
        return df
    ranked = ranking.seeded_rank(df.where(F.col("label") == 1), seed, keys, "_rank")
    draws = _draws(df, extra).select(
        (hashing.draw(F.lit(positives), seed, F.lit("over"), "draw") + 1).alias("_rank")
    )
    return df.unionByName(draws.join(ranked, "_rank").select(*df.columns))


def undersample(
    df: DataFrame, ratio: float, seed: object = SEED, keys: list[str] | None = None
) -> DataFrame:
    """Negatives drawn without replacement until positives are ``ratio`` of them; 0 keeps all."""
    if ratio <= 0:
        return df
    negative, positive = df.where(F.col("label") == 0), df.where(F.col("label") == 1)
    n = positive.agg(F.count(F.lit(1)).alias("n")).scalar()
    wanted = F.floor(n / F.lit(float(ratio))).cast("bigint")
    return positive.unionByName(ranking.seeded_take(negative, seed, keys or ROW, wanted))


def hard_negatives(df: DataFrame, log: DataFrame, as_of: datetime) -> DataFrame:
    """All positives, and the negatives whose pair was carted or favourited before the cutoff."""
    keen = history.before(log, as_of).where(F.col("behavior_type").isin(FAVOURITE, CART))
    kept = joins.semi(df.where(F.col("label") == 0), keen, PAIR)
    return df.where(F.col("label") == 1).unionByName(kept.select(*df.columns))


def _point(features: list[str]) -> tuple[Column, Column]:
    x = F.array(*[F.col(f).cast("double") for f in features])
    return x, F.md5(F.concat_ws("|", x.cast("array<string>")))


def neighbour_lists(points: DataFrame, dimensions: int, k: int, block_rows: int) -> DataFrame:
    """(vid, near): the k nearest other rows of a point, as coordinates, its own copies first."""
    found = neighbours.nearest(points, dimensions, k, block_rows)
    other = points.select(F.col("vid").alias("other"), F.col("x").alias("ox"), F.col("copies").alias("oc"))
    lists = found.join(other, "other").groupBy("vid").agg(
        F.sort_array(F.collect_list(F.struct("place", "ox", "oc"))).alias("others")
    )
    own = F.array_repeat("x", F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    rest = F.flatten(
        F.transform("others", lambda o: F.array_repeat(o["ox"], F.least(o["oc"], F.lit(k)).cast("int")))
    )
    none = F.array().cast("array<array<double>>")
    return points.join(lists, "vid", "left").select(
        "vid", F.slice(F.concat(own, F.coalesce(rest, none)), 1, k).alias("near")
    )


def prepare_smote(
    df: DataFrame, features: list[str], k: int = 5, seed: object = SEED, keys: list[str] | None = None,
    block_rows: int = neighbours.BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The ranked positives and the neighbour lists of their points, written: what every ratio draws from."""
    x, vid = _point(features)
    ranked = ranking.seeded_rank(df.where(F.col("label") == 1), seed, keys or ROW, "_rank").select(
        "_rank", x.alias("x"), vid.alias("vid")
    )
    ranked = materialise(ranked, "positives")
    points = materialise(neighbours.distinct_points(ranked), "points")
    return ranked, materialise(neighbour_lists(points, len(features), k, block_rows), "lists")


def smote(
    df: DataFrame,
    features: list[str],
    ratio: float,
    k: int = 5,
    seed: object = SEED,
    keys: list[str] | None = None,
    block_rows: int = neighbours.BLOCK_ROWS,
    prepared: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """(features, label): the set, plus points between a positive and one of its k nearest positives.

    The number added makes positives ``ratio`` of the negatives. Each draws a positive, a neighbour and
    how far to go towards it. Writes the neighbour lists while it is built, unless :func:`prepare_smote` has.
    """
    negatives, positives = class_counts(df)
    extra = int(negatives * ratio - positives)
    if extra < 0:
        raise ValueError("the ratio would need fewer positives than there are")
    if positives <= k:
        raise ValueError(f"{k} neighbours need more than {k} positives, got {positives}")
    real = df.select(*[F.col(f).cast("double").alias(f) for f in features], "label")
    if extra == 0:
        return real
    lists = prepared or prepare_smote(df, features, k, seed, keys, block_rows)
    made = synthetic(lists, features, positives, extra, k, seed)
    return real.unionByName(made.select(*features, F.lit(1).cast(df.schema["label"].dataType).alias("label")))


def synthetic(
    prepared: tuple[DataFrame, DataFrame], features: list[str], positives: int, extra: int, k: int = 5, seed: object = SEED
) -> DataFrame:
    """(draw, features): the first ``extra`` points drawn; fewer points are the first of more."""
    ranked, lists = prepared
    pick = hashing.draw(F.lit(positives * k), seed, F.lit("pick"), "draw")
    draws = _draws(ranked, extra).select("draw", pick.alias("_pick")).select(
        "draw",
        (F.floor(F.col("_pick") / k) + 1).cast("bigint").alias("_rank"),
        (F.col("_pick") % k + 1).cast("int").alias("_near"),
        hashing.unit(seed, F.lit("gap"), "draw").alias("_gap"),
    )
    based = draws.join(ranked, "_rank").join(lists, "vid")
    target = F.element_at("near", F.col("_near"))
    return based.select("draw", "x", target.alias("y"), "_gap").select(
        "draw",
        *[
            (F.col("x")[i] + F.col("_gap") * (F.col("y")[i] - F.col("x")[i])).alias(f)
            for i, f in enumerate(features)
        ],
    )


def grid_weights(
    df: DataFrame, features: list[str], ratios: list[float], k: int = 5, seed: object = SEED, keys: list[str] | None = None
) -> tuple[DataFrame, list[tuple[str, float]]]:
    """(features, label, weights) and the experiments' (method, ratio): every rebalanced set in one table.

    A weight per experiment is how often the row is in its set, the same sets as :func:`oversample`, :func:`undersample` and
    :func:`smote` give. Made points follow the rows; those of a lower ratio are the first of a higher one's.
    """
    keys = keys or ROW
    negatives, positives = class_counts(df)
    cases = [("baseline", 0.0)] + [(m, r) for m in ("smote", "oversampling", "undersampling") for r in ratios]
    extra = {r: oversampled_size(negatives, positives, r) - positives for r in ratios}
    made = {r: int(negatives * r - positives) for r in ratios}
    ranked = ranking.seeded_rank(df, seed, keys, "_rank", ["label"])
    drawn = _draws(df, max(extra.values(), default=0)).select(
        "draw", (hashing.draw(F.lit(max(positives, 1)), seed, F.lit("over"), "draw") + 1).alias("_rank"), F.lit(1).alias("label")
    )
    again = drawn.groupBy("label", "_rank").agg(*[F.count_if(F.col("draw") < extra[r]).alias(f"_again{i}") for i, r in enumerate(ratios)])
    rows = ranked.withColumn("label", F.col("label").cast("int")).join(again, ["label", "_rank"], "left")
    one, positive = F.lit(1), F.col("label") == 1
    weights = []
    for method, ratio in cases:
        i = ratios.index(ratio) if ratio in ratios else 0
        if method == "oversampling":
            weights.append(F.coalesce(F.col(f"_again{i}"), F.lit(0)).cast("int") + 1)
        elif method == "undersampling":
            weights.append((positive | (F.col("_rank") <= undersampled_size(negatives, positives, ratio))).cast("int"))
        else:
            weights.append(one)
    numbers = [F.col(f).cast("double").alias(f) for f in features]
    real = rows.select(*numbers, "label", F.array(*weights).alias("weights"))
    if positives <= k or min(made.values(), default=0) < 0 or not max(made.values(), default=0):
        raise ValueError(f"the ratios need more than {k} positives, and no more than they add to")
    points = synthetic(prepare_smote(df, features, k, seed, keys), features, positives, max(made.values()), k, seed)
    own = [(F.col("draw") < made[r]).cast("int") if m == "smote" else F.lit(0) for m, r in cases]
    return real.unionByName(points.select(*features, F.lit(1).alias("label"), F.array(*own).alias("weights"))), cases
