"""Reconciliation of stored features with recomputed ones, over all keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.catalog import sql
from footfall.catalog.registry import AS_OF, add, log, open_log, query
from footfall.operators import features, history, reconcile, rollup, variants
from footfall.operators.rollup import of_type
from footfall.schema import BUY, CART, CATEGORY_FEATURES, ITEM_FEATURES, USER_FEATURES, VIEW
from footfall.session import materialise_all, scratch_path
from footfall.sources import tables


def _fresh_count(spark, sf, key: str, code: int, name: str):
    """A count straight from the raw rows of one type."""
    rows = history.before(log(spark, sf, AS_OF), AS_OF).where(of_type(code))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _agree(key: str, feature: str, population: str) -> str:
    return f"""
SELECT '{feature}' AS feature, count(*) AS keys, 0::BIGINT AS only_fresh, 0::BIGINT AS only_stored,
  0::BIGINT AS differing
FROM (SELECT DISTINCT {key} FROM {population})"""


@query("q1_item_views", sql.with_(sql.history(), _agree("item_id", "total_pv", "h WHERE behavior_type = 1")))
def _q1_item(spark, sf):
    stored = features.item_features(open_log(spark, sf), ["total_pv"]).where(F.col("total_pv").isNotNull())
    return reconcile.counts_agree(stored, _fresh_count(spark, sf, "item_id", VIEW, "total_pv"), "item_id", "total_pv")


@query("q1_user_buys", sql.with_(sql.history(), _agree("user_id", "total_buy", "h WHERE behavior_type = 4")))
def _q1_user(spark, sf):
    stored = features.user_features(open_log(spark, sf), ["total_buy"]).where(F.col("total_buy").isNotNull())
    return reconcile.counts_agree(stored, _fresh_count(spark, sf, "user_id", BUY, "total_buy"), "user_id", "total_buy")


@query("q1_category_carts", sql.with_(sql.history(), _agree("item_category", "cart_count", "h WHERE behavior_type = 3")))
def _q1_category(spark, sf):
    stored = features.category_features(open_log(spark, sf), ["cart_count"]).where(F.col("cart_count") > 0)
    fresh = _fresh_count(spark, sf, "item_category", CART, "cart_count")
    return reconcile.counts_agree(stored, fresh, "item_category", "cart_count")


@query("q1_user_views_without_cutoff", sql.with_(sql.history(), """
SELECT 'total_views' AS feature, count(*) AS keys, count(*) FILTER (WHERE s.user_id IS NULL) AS only_fresh,
  count(*) FILTER (WHERE f.user_id IS NULL) AS only_stored, count(*) FILTER (WHERE s.n <> f.n) AS differing
FROM (SELECT user_id, count(*) AS n FROM h WHERE behavior_type = 1 GROUP BY user_id) s
FULL JOIN (SELECT user_id, count(*) AS n FROM log WHERE behavior_type = 1 GROUP BY user_id) f USING (user_id)"""))
def _q1_uncut(spark, sf):
    """Stored counts end at the cutoff; the recount does not, so users active later differ."""
    stored = features.user_features(open_log(spark, sf), ["total_views"]).where(F.col("total_views").isNotNull())
    fresh = log(spark, sf).where(of_type(VIEW)).groupBy("user_id").agg(F.count(F.lit(1)).alias("total_views"))
    return reconcile.counts_agree(stored, fresh, "user_id", "total_views")


def _all_features(entity: str, key: str, build, view: str, ctes: str, names: list[str]) -> None:
    """Every feature of an entity: the stored table, read back, against one recomputed from the log."""
    listed, counts = ", ".join(f"'{n}'" for n in names), ", ".join(f"count({n})" for n in names)

    def run(spark, sf):
        h = open_log(spark, sf)
        path = scratch_path(spark, f"{entity}_feature")
        tables.write_table(build(h), path)
        return reconcile.all_agree(tables.read_table(spark, path), build(open_log(spark, sf)), key)

    def run_by_fingerprint(spark, sf):
        stored, fresh = (scratch_path(spark, f"{entity}_{side}") for side in ("feature", "fresh"))
        for path in (stored, fresh):
            tables.write_table(build(open_log(spark, sf)), path)
        return reconcile.agree_by_fingerprint(tables.read_table(spark, stored), tables.read_table(spark, fresh), key)

    want = sql.with_(f"{sql.history()},\n{ctes}", f"""
SELECT unnest([{listed}]) AS feature, keys, unnest(counts) AS present, 0::BIGINT AS only_fresh, 0::BIGINT AS only_stored,
  0::BIGINT AS differing FROM (SELECT count(*) AS keys, [{counts}] AS counts FROM {view})""")
    add(f"q1_all_{entity}_features", run, want)
    add(f"q1_all_{entity}_features_by_fingerprint", run_by_fingerprint, want)


_all_features("user", "user_id", features.user_features, "user_f", sql.users(), USER_FEATURES)
_all_features("item", "item_id", features.item_features, "item_f", sql.items(), ITEM_FEATURES)
_all_features("category", "item_category", features.category_features, "cat_f", sql.categories(), CATEGORY_FEATURES)


@query("q2_item_view_not_buy", sql.with_(sql.history(), _agree(
    "item_id", "view_not_buy_rate", "prs WHERE n_view > 0 AND n_buy = 0")))
def _q2(spark, sf):
    """Two independent plans: sums over the pair table, and the anti join."""
    h = open_log(spark, sf)
    stored = features.item_features(h, ["view_not_buy_rate"]).where(F.col("view_not_buy_rate") > 0)
    fresh = variants.not_bought_by_pair(h.rows, "item_id", VIEW, "view_not_buy_rate")
    return reconcile.ratios_agree(stored, fresh, "item_id", "view_not_buy_rate")


@query("q2_filled_against_missing", sql.with_(sql.history(), """
SELECT 'cart_rate' AS feature, count(*) AS keys, 0::BIGINT AS only_fresh, 0::BIGINT AS only_stored,
  count(*) FILTER (WHERE v > 0 AND c = 0) AS differing
FROM (SELECT item_id, sum(n_view) AS v, sum(n_cart) AS c FROM prs GROUP BY item_id)"""))
def _q2_filled(spark, sf):
    """Where the stored rate is missing and the plain one 0, the two definitions differ."""
    h = open_log(spark, sf)
    stored = features.item_features(h, ["cart_rate"])
    fresh = variants.zero_filled_rates(h.rows, "item_id", variants.item_rates())
    return reconcile.ratios_agree(stored, fresh, "item_id", "cart_rate")


@query("q2_filled_by_fingerprint", sql.with_(sql.history(), """
SELECT 'cart_rate' AS feature, count(*) AS keys, count(*) FILTER (WHERE v > 0 AND c > 0) AS present, 0::BIGINT AS only_fresh,
  0::BIGINT AS only_stored, count(*) FILTER (WHERE v > 0 AND c = 0) AS differing
FROM (SELECT item_id, sum(n_view) AS v, sum(n_cart) AS c FROM prs GROUP BY item_id)"""))
def _q2_fingerprint(spark, sf):
    """The same by fingerprints: only the buckets of items viewed and never carted are joined."""
    h = open_log(spark, sf)
    sides = {
        "stored": features.item_features(h, ["cart_rate"]),
        "fresh": variants.zero_filled_rates(h.rows, "item_id", variants.item_rates()).select("item_id", "cart_rate"),
    }
    return reconcile.agree_by_fingerprint(*materialise_all(sides), "item_id")


@query("q3_hour_among_ties", sql.with_(f"{sql.history()},\n{sql.users()}", """
SELECT user_id, active_hour, TRUE AS is_peak FROM user_f"""))
def _q3(spark, sf):
    h = open_log(spark, sf)
    stored = features.user_features(h, ["active_hour"])
    return reconcile.hour_is_tied(stored, variants.tied_hours(h.rows), "user_id", "active_hour")


@query("q4_drill_down", sql.with_(f"{sql.history()},\n{sql.users()}", """
SELECT user_id, total_views, total_buy, view_not_buy_rate FROM user_f
WHERE user_id = (SELECT min(user_id) FROM h)"""))
def _q4(spark, sf):
    """One key recomputed: the filter on the key reaches the scan below every grouping."""
    h = open_log(spark, sf)
    key = h.rows.agg(F.min("user_id").alias("k")).scalar()
    one = history.History(h.rows.where(F.col("user_id") == key))
    return features.user_features(one, ["total_views", "total_buy", "view_not_buy_rate"])


@query("q5_duplicate_keys", sql.with_(sql.history(), """
SELECT user_id, count(*) AS rows FROM (SELECT user_id, item_id FROM prs) GROUP BY user_id HAVING count(*) > 1"""))
def _q5(spark, sf):
    """On a table that does repeat the key (the pair table), so that the probe finds something."""
    return reconcile.duplicate_keys(rollup.pairs(open_log(spark, sf).rows), "user_id")
