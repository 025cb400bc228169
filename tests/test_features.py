"""Hand-made logs for the rules that the given data hardly reaches."""

from __future__ import annotations

from datetime import datetime

import pytest

from footfall.operators import assemble, features, history, rollup, variants
from footfall.schema import VIEW

AS_OF = datetime(2014, 12, 18)
LAST = (99, 990, 9, 1, "2014-12-17 23")


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def log(make_log):
    return make_log([
        LAST,
        (1, 10, 1, 1, "2014-12-17 10"),
        (2, 10, 1, 4, "2014-12-17 11"),
        (3, 11, 1, 1, "2014-12-17 09"), (3, 11, 1, 4, "2014-12-17 09"),
        (4, 20, 2, 1, "2014-12-10 01"), (4, 20, 2, 1, "2014-12-10 02"), (4, 21, 2, 1, "2014-12-10 03"),
        (4, 21, 2, 4, "2014-12-10 04"),
        (5, 30, 3, 1, "2014-12-11 09"), (5, 31, 3, 1, "2014-12-11 21"),
        (6, 40, 4, 1, "2014-12-14 23"), (6, 40, 4, 1, "2014-12-14 22"),
        (7, 41, 4, 2, "2014-12-17 00"), (8, 41, 4, 2, "2014-12-16 23"),
        (9, 50, 5, 4, "2014-12-18 00"), (9, 51, 5, 4, "2014-12-19 00"), (9, 50, 5, 1, "2014-12-12 05"),
        (10, 60, 6, 4, "2014-12-01 00"), (10, 60, 6, 4, "2014-12-01 01"), (11, 60, 6, 4, "2014-12-01 02"),
        (12, 70, 7, 4, "2014-12-18 03"),
    ])


@pytest.fixture(scope="module")
def users(log):
    return _by(features.user_features(history.open_history(log, AS_OF)), "user_id")


@pytest.fixture(scope="module")
def items(log):
    return _by(features.item_features(history.open_history(log, AS_OF)), "item_id")


def test_views_only(users):
    u = users[1]
    assert [u[n] for n in ("cart_rate", "buy_rate", "tendency_index", "buy_recency")] == [None] * 4
    assert u["view_not_buy_rate"] == 1.0


def test_buy_without_view(users):
    names = ("total_views", "buy_rate", "hesitation_buying_rate", "view_not_buy_rate")
    assert [users[2][n] for n in names] == [None] * 4
    assert users[2]["total_buy"] == 1


def test_tendency_needs_all_three(users, log):
    assert users[3]["tendency_index"] is None
    filled = variants.zero_filled_rates(log, "user_id", variants.tendency_rates())
    assert _by(filled, "user_id")[3]["tendency_index"] == 1.0


def test_distinct_against_event_share(users, log):
    assert users[4]["view_not_buy_rate"] == 0.5
    by_event = variants.not_bought_by_event(rollup.pairs(log), "n_view", "rate")
    assert _by(by_event, "user_id")[4]["rate"] == 2 / 3


def test_hour_tie(users, log):
    assert users[5]["active_hour"] == 9
    tied = variants.tied_hours(log).where("user_id = 5").collect()
    assert sorted(r.active_hour for r in tied) == ["09", "21"]


def test_window_edge_is_inside(users):
    assert users[6]["last_3day_pv"] == 1
    assert users[6]["last_7day_pv"] == 2


def test_days_are_floored(users):
    assert users[7]["first_active_time"] == 0
    assert users[8]["first_active_time"] == 1


def test_label_day(users, log):
    assert users[9]["total_buy"] is None
    labels = {(r.user_id, r.item_id) for r in assemble.labels(log, AS_OF).collect()}
    assert labels == {(9, 50), (12, 70)}
    two_days = {(r.user_id, r.item_id) for r in assemble.labels(log, AS_OF, 2).collect()}
    assert (9, 51) in two_days
    labelled = {(r.user_id, r.item_id): r.label for r in assemble.labelled(log, AS_OF).collect()}
    assert labelled[(9, 50)] == 1
    assert (12, 70) not in labelled
    assert sum(labelled.values()) == 1


def test_band_rates_are_missing_not_zero(users):
    assert users[1]["morning_active_rate"] == 1.0
    assert users[1]["night_active_rate"] is None


def test_repeat_buyer(items):
    assert items[60]["repurchase_index"] == 0.5
    assert items[60]["items_pv_ranking"] is None
    assert items[60]["peak_view_hour"] is None
    assert items[60]["peak_buy_hour"] == 0


def test_rank_ties(make_log):
    views = [(1, 1, 1, 1, f"2014-12-01 0{h}") for h in range(5)]
    views += [(1, 2, 1, 1, f"2014-12-01 0{h}") for h in range(5)]
    views += [(1, 3, 1, 1, f"2014-12-01 0{h}") for h in range(3)] + [(1, 4, 1, 4, "2014-12-01 00")]
    found = _by(features.item_features(history.open_history(make_log(views), AS_OF), ["items_pv_ranking"]), "item_id")
    assert [found[i]["items_pv_ranking"] for i in (1, 2, 3, 4)] == [1, 1, 3, None]


def test_category_without_buys_is_zero(log):
    c = _by(features.category_features(history.open_history(log, AS_OF)), "item_category")[3]
    assert (c["buy_count"], c["buy_rate"], c["peak_buy_hour"], c["total_pv"]) == (0, 0.0, 0, 2)


def test_empty_history_fails(log):
    with pytest.raises(ValueError):
        history.require_nonempty(history.before(log, datetime(2000, 1, 1)))
    with pytest.raises(ValueError, match="no rows before the cutoff"):
        history.open_history(log, datetime(2000, 1, 1), required=True)


def test_given_reference_moment(log):
    given = history.open_history(log, AS_OF, now=datetime(2014, 12, 17, 23))
    scanned = history.open_history(log, AS_OF)
    names = ["last_3day_pv", "buy_recency", "first_active_time"]
    assert _by(features.user_features(given, names), "user_id") == _by(
        features.user_features(scanned, names), "user_id"
    )


def test_session_zone_takes_no_part(spark, log):
    names = ["active_hour", "buy_recency", "first_active_time", "morning_active_rate"]
    plain = _by(features.user_features(history.open_history(log, AS_OF), names), "user_id")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _by(features.user_features(history.open_history(log, AS_OF), names), "user_id") == plain
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_invariants(users, log):
    for u in users.values():
        assert u["impulsive_buying_rate"] == u["buy_rate"]
        bands = [u[f"{b}_active_rate"] or 0.0 for b in ("morning", "afternoon", "night")]
        assert sum(bands) == pytest.approx(1.0)
    h = history.open_history(log, AS_OF)
    views = sum(r.total_pv for r in features.category_features(h, ["total_pv"]).collect())
    assert views == sum(u["total_views"] or 0 for u in users.values())


def test_pair_form_against_anti_join(log):
    h = history.open_history(log, AS_OF)
    pair_form = {
        k: v["view_not_buy_rate"]
        for k, v in _by(features.item_features(h, ["view_not_buy_rate"]), "item_id").items()
        if v["view_not_buy_rate"]
    }
    anti = variants.not_bought_by_pair(h.rows, "item_id", VIEW, "rate")
    assert {r.item_id: r.rate for r in anti.collect()} == pair_form
