"""Training table, splits, selection and rebalancing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from footfall.catalog import sql
from footfall.catalog.registry import (
    AS_OF, LABEL_DAYS, TRAIN_AS_OF, TRAIN_DAYS, add, baseline, build_training_table, label_log, log, matrices,
    open_log, prepared, query, table,
)
from footfall.functions.timeparts import naive
from footfall.operators import assemble, features, models, rebalance, selection, split
from footfall.plans import pipeline
from footfall.schema import ITEM_FEATURES, LEAKY_SELECTED, RATIOS, SEED

# --- Candidates, labels, sample, table --------------------------------------------------------------

_LABELLED = f"{sql.LOG},\n{sql.labelled(AS_OF, 1)}"
_ROWS = "user_id, item_id, item_category"


@query("b1_candidates", sql.with_(_LABELLED, f"SELECT {_ROWS} FROM cand"))
def _b1(spark, sf):
    return assemble.candidates(log(spark, sf, AS_OF), AS_OF)


@query("b2_labels", sql.with_(_LABELLED, "SELECT user_id, item_id FROM lbl"))
def _b2(spark, sf):
    return assemble.labels(label_log(spark, sf, AS_OF, LABEL_DAYS), AS_OF, LABEL_DAYS)


@query("b3_attach_label", sql.with_(_LABELLED, f"SELECT {_ROWS}, label FROM lab"))
def _b3(spark, sf):
    ahead = label_log(spark, sf, AS_OF, LABEL_DAYS)
    return assemble.labelled(log(spark, sf, AS_OF), AS_OF, LABEL_DAYS, ahead)


def _base(spark, sf):
    past, ahead = log(spark, sf, TRAIN_AS_OF), label_log(spark, sf, TRAIN_AS_OF, TRAIN_DAYS)
    return pipeline.sampled_base(past, TRAIN_AS_OF, TRAIN_DAYS, label_log=ahead)


@query("b4_sample_negatives", sql.with_(sql.base_only(), f"SELECT {_ROWS}, label FROM base"))
def _b4(spark, sf):
    return _base(spark, sf)


@query("b4_sampling_report", sql.with_(sql.base_only(), """
SELECT p AS positives, n AS available, 40 * p AS wanted, least(40 * p, n) AS taken
FROM (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM lab)"""))
def _b4_report(spark, sf):
    return assemble.sampling_report(assemble.labelled(log(spark, sf), TRAIN_AS_OF, TRAIN_DAYS), ratio=40)


@query("b5_shuffle", sql.with_(sql.base_only(), f"SELECT {_ROWS}, label FROM base"))
def _b5(spark, sf):
    return assemble.shuffle(_base(spark, sf))


@query("b6_feature_table", sql.with_(sql.full_table(), "SELECT * FROM ft"))
def _b6(spark, sf):
    return build_training_table(spark, sf)


# --- Splits -----------------------------------------------------------------------------------------


@query("d1_stratified_split", sql.with_(sql.full_split(), "SELECT * FROM cut"))
def _d1(spark, sf):
    return split.stratified_split(prepared(spark, sf).table)


@query("d1_split_sizes", sql.with_(f"{sql.full_table()},\n{sql.split_sizes()}", "SELECT * FROM sizes"))
def _d1_sizes(spark, sf):
    return split.split_sizes(prepared(spark, sf).table)


_BOUNDS = datetime(2024, 1, 22), datetime(2024, 1, 27)
_TIMED = f"""{sql.LOG},
timed AS (SELECT *, CASE WHEN time < {sql.stamp(_BOUNDS[0])} THEN 'train'
  WHEN time < {sql.stamp(_BOUNDS[1])} THEN 'val' ELSE 'test' END AS split FROM log)"""


@query("d2_time_split", sql.with_(_TIMED, "SELECT user_id, item_id, time, split FROM timed"))
def _d2(spark, sf):
    return split.time_split(log(spark, sf), "time", *_BOUNDS).select("user_id", "item_id", "time", "split")


@query("d3_label_distribution", sql.with_(sql.full_split(), """
SELECT split, label, count(*) AS rows, sum(count(*) FILTER (WHERE label = 1)) OVER (PARTITION BY split)::DOUBLE
  / sum(count(*)) OVER (PARTITION BY split) AS positive_share
FROM cut GROUP BY split, label"""))
def _d3(spark, sf):
    return split.label_distribution(split.stratified_split(prepared(spark, sf).table.select(*assemble.ROW, "label")))


@query("d4_coverage", sql.with_(_TIMED, """
SELECT split, time::DATE AS day, hour(time)::INTEGER AS hour, count(*) AS rows FROM timed GROUP BY ALL"""))
def _d4(spark, sf):
    return split.coverage(split.time_split(log(spark, sf), "time", *_BOUNDS), "time")


# --- Selection --------------------------------------------------------------------------------------


def _long(source: str, columns: list[str], value: str, name: str) -> str:
    names = ", ".join(f"'{c}'" for c in columns)
    values = ", ".join(value.format(c=c) for c in columns)
    return f"SELECT unnest([{names}]) AS feature, unnest([{values}]) AS {name} FROM {source}"


@query("f1_missing_ratio", sql.with_(
    f"{sql.history()},\n{sql.items()}",
    _long("item_f", ITEM_FEATURES, "round(avg(({c} IS NULL)::INT), 6)", "missing_ratio")))
def _f1(spark, sf):
    items = features.item_features(open_log(spark, sf), ITEM_FEATURES)
    ratio = selection.missing_ratio(items, ITEM_FEATURES)
    return ratio.withColumn("missing_ratio", F.round("missing_ratio", 6))


_INPUTS = sql.input_columns()


@query("f2_variance_filter", sql.with_(
    f"{sql.full_split()},\nv AS ({_long('train', _INPUTS, 'var_pop({c}::DOUBLE)', 'variance')})",
    "SELECT feature, round(variance, 4) AS variance, variance > 0.01 AS kept FROM v"))
def _f2(spark, sf):
    train = prepared(spark, sf).splits.train
    found = selection.variances(train, selection.inputs(train))
    return found.select("feature", F.round("variance", 4).alias("variance"), (F.col("variance") > 0.01).alias("kept"))


def _pairs_sql() -> str:
    """Every pair of inputs with its correlation, computed in one aggregate and then listed."""
    pairs = [(i, j) for i in range(len(_INPUTS)) for j in range(i + 1, len(_INPUTS))]
    corr = ", ".join(f"corr({_INPUTS[i]}::DOUBLE, {_INPUTS[j]}::DOUBLE)" for i, j in pairs)
    left = ", ".join(str(i) for i, _ in pairs)
    right = ", ".join(str(j) for _, j in pairs)
    names = ", ".join(f"'{c}'" for c in _INPUTS)
    var = ", ".join(f"var_pop({c}::DOUBLE) > 0.01" for c in _INPUTS)
    return f"""kept AS (SELECT unnest([{names}]) AS feature, unnest(range({len(_INPUTS)})) AS i, unnest([{var}]) AS ok
  FROM train),
every AS (SELECT unnest([{left}]) AS i, unnest([{right}]) AS j, abs(unnest([{corr}])) AS corr FROM train),
corrs AS (SELECT a.feature AS col_i, b.feature AS col_j, corr FROM every
  JOIN kept a ON a.i = every.i AND a.ok JOIN kept b ON b.i = every.j AND b.ok)"""


_CORRS = f"{sql.full_split()},\n{_pairs_sql()}"


def _kept_columns(train) -> list[str]:
    return selection.keep_informative(train, selection.inputs(train))


@query("f3_correlations", sql.with_(_CORRS, "SELECT col_i, col_j, round(corr, 6) AS corr FROM corrs"))
def _f3(spark, sf):
    train = prepared(spark, sf).splits.train
    corr = selection.correlations(train, _kept_columns(train))
    return corr.select("col_i", "col_j", F.round("corr", 6).alias("corr"))


_GAPS = [c for c in ITEM_FEATURES if c != "items_pv_ranking"]
_GAP_PAIRS = [(a, b) for n, a in enumerate(_GAPS) for b in _GAPS[n + 1 :]]


@query("f3_correlations_with_gaps", sql.with_(f"""{sql.history()},
{sql.items()},
every AS (SELECT unnest([{', '.join(f"'{a}'" for a, _ in _GAP_PAIRS)}]) AS col_i, unnest([{', '.join(f"'{b}'" for _, b in _GAP_PAIRS)}]) AS col_j,
  abs(unnest([{', '.join(f'corr({a}::DOUBLE, {b}::DOUBLE)' for a, b in _GAP_PAIRS)}])) AS corr FROM item_f)""", """
SELECT col_i, col_j, round(corr, 6) AS corr FROM every WHERE isfinite(corr)"""))
def _f3_gaps(spark, sf):
    """Item features with their gaps: each pair over the items that have both."""
    corr = selection.correlations(features.item_features(open_log(spark, sf), _GAPS), _GAPS)
    return corr.where(F.abs("corr") < float("inf")).select("col_i", "col_j", F.round("corr", 6).alias("corr"))


@query("f4_drop_redundant", sql.with_(_CORRS, "SELECT DISTINCT col_i AS feature FROM corrs WHERE corr >= 0.8"))
def _f4(spark, sf):
    train = prepared(spark, sf).splits.train
    return selection.redundant(selection.correlations(train, _kept_columns(train)))


_PRIORITY = ["total_behavior", "total_pv_x", "uv", "cart_rate_y"]
_LISTED = ", ".join(f"'{c}'" for c in _PRIORITY)


@query("f5_drop_redundant_by_priority", sql.with_(_CORRS, f"""
SELECT DISTINCT CASE WHEN col_i IN ({_LISTED}) AND col_j NOT IN ({_LISTED}) THEN col_j ELSE col_i END AS feature
FROM corrs WHERE corr >= 0.5"""))
def _f5(spark, sf):
    train = prepared(spark, sf).splits.train
    return selection.redundant(selection.correlations(train, _kept_columns(train)), 0.5, _PRIORITY)


@query("f6_label_encode", f"""
SELECT e.event_id, c.code AS event_type FROM events e
JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (
  SELECT DISTINCT event_type FROM events WHERE ts < {sql.stamp(TRAIN_AS_OF)})) c USING (event_type)
WHERE e.ts >= {sql.stamp(TRAIN_AS_OF)}""")
def _f6(spark, sf):
    """Event names coded by those seen before the cutoff, applied to later events."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    early = F.col("ts") < naive(TRAIN_AS_OF)
    seen, later = events.where(early), events.where(~early)
    return selection.encode(seen, later, "event_type").select("event_id", F.col("event_type").cast("bigint"))


_TREES = """
SELECT 1.0::DOUBLE AS total, TRUE AS whole, count(*) AS least_rows, count(*) AS most_rows FROM train"""


def _trees_agree(spark, sf, kind: str, total):
    """The listed importances against the fitted trees' own nodes; each tree's root holds all rows of train."""
    fit, _ = baseline(spark, sf)
    listed = selection.importance(fit.model, matrices(spark, sf).features, kind)
    nodes = models.tree_nodes(fit.model)
    inner, leaves = F.count_if(F.col("leftChild") >= 0), F.count_if(F.col("leftChild") < 0)
    # a binary tree has one leaf more than it has splits
    grown = nodes.groupBy("tree").agg(inner.alias("splits"), leaves.alias("leaves"))
    kept = grown.agg(F.sum("splits").alias("splits"), F.bool_and(F.col("leaves") == F.col("splits") + 1).alias("whole"))
    roots = nodes.where("id = 0").agg(F.min("rawCount").alias("least_rows"), F.max("rawCount").alias("most_rows"))
    return roots.select(
        F.round(listed.agg(F.sum("importance")).scalar() / total(kept), 6).alias("total"),
        kept.select("whole").scalar().alias("whole"), "least_rows", "most_rows",
    )


@query("f7_importance_gain", sql.with_(sql.full_split(), _TREES))
def _f7(spark, sf):
    return _trees_agree(spark, sf, "gain", lambda kept: F.lit(1.0))


@query("f7_importance_splits", sql.with_(sql.full_split(), _TREES))
def _f7_splits(spark, sf):
    return _trees_agree(spark, sf, "split", lambda kept: kept.select("splits").scalar())


_SHARES = f"""{sql.full_split()},
imp AS ({_long('train', _INPUTS, 'round(ln(1 + var_pop({c}::DOUBLE)), 4)', 'importance')}),
run AS (SELECT feature, importance, sum(importance) OVER (ORDER BY importance DESC, feature)
  / sum(importance) OVER () AS share, row_number() OVER (ORDER BY importance DESC, feature) AS place FROM imp)"""


def _as_importance(spark, sf):
    train = prepared(spark, sf).splits.train
    return selection.variances(train, selection.inputs(train)).select(
        "feature", F.round(F.log(F.col("variance") + 1), 4).alias("importance")
    )


@query("f8_select_by_share", sql.with_(_SHARES, "SELECT feature FROM run WHERE share <= 0.95 OR place = 1"))
def _f8(spark, sf):
    """Logarithms of variances stand in for importances, so that SQL can check the cut."""
    return selection.select_by_share(_as_importance(spark, sf)).select("feature")


_PERMUTED = f"""{sql.full_split()},
v AS (SELECT user_id, item_id, item_category, label, uv::DOUBLE AS x0, total_pv_x::DOUBLE AS x1 FROM valid),
own AS (SELECT *, row_number() OVER (ORDER BY {sql.order_by(SEED, *sql.ROW)}) AS place FROM v),
other AS (SELECT repeat, x0 AS z0, x1 AS z1, row_number() OVER (
    PARTITION BY repeat ORDER BY {sql.order_by(f'{SEED}-partner', 'repeat', *sql.ROW)}) AS place
  FROM v, (SELECT unnest(range(1, 6)) AS repeat)),
mixed AS (SELECT label, repeat, f, CASE WHEN f = 0 THEN z0 ELSE x0 END AS a, CASE WHEN f = 1 THEN z1 ELSE x1 END AS b
  FROM own JOIN other USING (place), (SELECT unnest(range(2)) AS f)
  UNION ALL SELECT label, 0, -1, x0, x1 FROM v),
priced AS (SELECT f, repeat, avg(-ln(CASE WHEN label = 1 THEN p ELSE 1 - p END)) AS loss FROM (
  SELECT *, least(greatest(a / (a + b + 1), 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM mixed)
  GROUP BY f, repeat)"""


@query("f9_permutation_importance", sql.with_(_PERMUTED, """
SELECT CASE p.f WHEN 0 THEN 'uv' ELSE 'total_pv_x' END AS feature, round(avg(p.loss - b.loss), 6) AS importance_mean,
  round(stddev_pop(p.loss - b.loss), 6) AS importance_std
FROM priced p, (SELECT loss FROM priced WHERE f = -1) b WHERE p.f >= 0 GROUP BY p.f"""))
def _f9(spark, sf):
    """A closed-form score takes the model's place, so that SQL can repeat the permutations."""
    val = prepared(spark, sf).splits.val
    table = selection.permutation_importance(
        None, val, ["uv", "total_pv_x"], assemble.ROW, scorer=lambda x: x[0] / (x[0] + x[1] + F.lit(1.0))
    )
    return table.select("feature", *[F.round(c, 6).alias(c) for c in ("importance_mean", "importance_std")])


@query("f9_permutation_importance_of_the_model", sql.with_(sql.full_split(), "SELECT count(*) AS rows, TRUE AS finite FROM valid"))
def _f9_model(spark, sf):
    """The same with the fitted model: every chosen feature has a finite importance."""
    fit, _ = baseline(spark, sf)
    m = matrices(spark, sf)
    found = selection.permutation_importance(fit.model, m.val.drop("features"), m.features, assemble.ROW)
    finite = F.abs("importance_mean") < float("inf")
    return m.val.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", found.agg((F.bool_and(finite) & (F.count(F.lit(1)) == len(m.features)))).scalar().alias("finite")
    )


@query("f10_drop_leaky", sql.with_(sql.full_split(), "SELECT {} FROM train".format(
    ", ".join(c for c in _INPUTS if c not in LEAKY_SELECTED))))
def _f10(spark, sf):
    train = prepared(spark, sf).splits.train
    return train.select(*selection.drop_leaky(selection.inputs(train)))


@query("f11_apply_columns", sql.with_(_CORRS, """
SELECT feature FROM kept WHERE ok AND feature NOT IN (SELECT col_i FROM corrs WHERE corr >= 0.8)"""))
def _f11(spark, sf):
    """The columns train keeps, applied to validation, listed from the result's own schema."""
    parts = prepared(spark, sf).splits
    applied = parts.val.select(*pipeline.first_two_steps(parts.train))
    return selection.missing_ratio(applied).select("feature")


# --- Rebalancing ------------------------------------------------------------------------------------

_COUNTS = """cnt AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
  FROM train)"""
_WHOLE = ", ".join([*sql.ROW, "label", *sql.feature_columns()])


def _train(spark, sf):
    return prepared(spark, sf).splits.train


def _draw(n: str, *parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT % ({n}))"


def _ranked(columns: str) -> str:
    return f"""pos AS (SELECT {columns}, row_number() OVER (ORDER BY {sql.order_by(SEED, *sql.ROW)}) AS r
  FROM train WHERE label = 1)"""


def _register_ratios() -> None:
    for ratio in RATIOS:
        shown = f"{ratio:.1f}".replace(".", "_")
        add(
            f"r2_oversample_{shown}",
            lambda spark, sf, ratio=ratio: rebalance.oversample(_train(spark, sf), ratio),
            sql.with_(f"""{sql.full_split()},
{_COUNTS},
{_ranked(_WHOLE)},
draws AS (SELECT unnest(range(greatest(floor(n0 * {ratio}::DOUBLE)::BIGINT - n1, 0))) AS draw, n1 FROM cnt)""", f"""
SELECT {_WHOLE} FROM train UNION ALL
SELECT {_WHOLE} FROM draws JOIN pos ON r = {_draw('n1', f"'{SEED}'", "'over'", 'draw')} + 1"""),
        )
        add(
            f"r3_undersample_{shown}",
            lambda spark, sf, ratio=ratio: rebalance.undersample(_train(spark, sf), ratio),
            sql.with_(f"""{sql.full_split()},
{_COUNTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql.order_by(SEED, *sql.ROW)}) AS r FROM train)""", f"""
SELECT {_WHOLE} FROM ranked, cnt WHERE label = 1 OR r <= floor(n1 / {ratio}::DOUBLE)"""),
        )


_register_ratios()

_POINT = _INPUTS
_K = 5


def _smote_sql(ratio: float) -> str:
    """All pairs of positives, the five closest of each, then the same draws."""
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in _POINT)
    vid = "md5(concat_ws('|', " + ", ".join(f"{c}::DOUBLE::VARCHAR" for c in _POINT) + "))"
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _POINT)
    gap = (f"((('0x' || substr(md5(concat_ws('|', '{SEED}', 'gap', draw)), 1, 13))::BIGINT)::DOUBLE"
           " / 4503599627370496)")
    made = ", ".join(f"a.{c} + {gap} * (b.{c} - a.{c}) AS {c}" for c in _POINT)
    return sql.with_(f"""{sql.full_split()},
{_COUNTS},
{_ranked(f'{casts}, {vid} AS vid')},
near AS (SELECT a.r, b.r AS other, row_number() OVER (PARTITION BY a.r ORDER BY {d2}, b.vid, b.r) AS place
  FROM pos a JOIN pos b ON a.r <> b.r),
draws AS (SELECT draw, n1, {_draw(f'n1 * {_K}', f"'{SEED}'", "'pick'", 'draw')} AS pick
  FROM (SELECT unnest(range(floor(n0 * {ratio}::DOUBLE - n1)::BIGINT)) AS draw, n1 FROM cnt))""", f"""
SELECT {casts}, label FROM train UNION ALL
SELECT {made}, 1 AS label FROM draws
JOIN near ON near.r = pick // {_K} + 1 AND near.place = pick % {_K} + 1
JOIN pos a ON a.r = near.r JOIN pos b ON b.r = near.other""")


def _register_smote() -> None:
    for ratio in RATIOS:
        shown = f"{ratio:.1f}".replace(".", "_")
        add(
            f"r1_smote_{shown}",
            lambda spark, sf, ratio=ratio: rebalance.smote(prepared(spark, sf).splits.train, _POINT, ratio, _K),
            _smote_sql(ratio),
        )


_register_smote()


@query("r4_hard_negatives", sql.with_(f"{sql.full_split()},\n{_COUNTS}", f"""
SELECT {_WHOLE} FROM train x WHERE label = 1 OR EXISTS (
  SELECT 1 FROM h WHERE h.user_id = x.user_id AND h.item_id = x.item_id AND behavior_type IN (2, 3))"""))
def _r4(spark, sf):
    return rebalance.hard_negatives(_train(spark, sf), log(spark, sf, TRAIN_AS_OF), TRAIN_AS_OF)
