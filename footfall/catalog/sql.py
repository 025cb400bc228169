"""SQL building blocks of the oracles. They state each definition directly, not our plans."""

from __future__ import annotations

from datetime import datetime, timedelta

from footfall.catalog.registry import AS_OF, TRAIN_AS_OF, TRAIN_DAYS
from footfall.schema import CATEGORY_FEATURES, ITEM_FEATURES, NOT_INPUTS, SEED, USER_FEATURES

LOG = """log AS (
  SELECT user_id, 100 * (user_id % 10) + k AS item_id, k % 20 AS item_category, bt AS behavior_type,
         date_trunc('hour', ts)::TIMESTAMP AS time
  FROM (SELECT user_id, ts, json_extract_string(props, '$.k')::BIGINT AS k,
               CASE event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3
                               WHEN 'purchase' THEN 4 END AS bt
        FROM events)
  WHERE bt IS NOT NULL)"""


def stamp(moment: datetime) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


def history(as_of: datetime | None = AS_OF) -> str:
    where = f" WHERE time < {stamp(as_of)}" if as_of else ""
    return f"""{LOG},
h AS (SELECT *, hour(time)::INTEGER AS hr, epoch(time)::BIGINT AS t FROM log{where}),
ref AS (SELECT max(t) AS ref_t FROM h),
prs AS (SELECT user_id, item_id, count(*) AS n_all, count(*) FILTER (WHERE behavior_type = 1) AS n_view,
               count(*) FILTER (WHERE behavior_type = 2) AS n_fav,
               count(*) FILTER (WHERE behavior_type = 3) AS n_cart,
               count(*) FILTER (WHERE behavior_type = 4) AS n_buy
        FROM h GROUP BY user_id, item_id)"""


def _counts(key: str, name: str) -> str:
    def views(days: int) -> str:
        return f"nullif(count(*) FILTER (WHERE behavior_type = 1 AND t >= ref_t - {days * 86400}), 0)"

    def typed(code: int) -> str:
        return f"nullif(count(*) FILTER (WHERE behavior_type = {code}), 0)"

    def band(where: str) -> str:
        return f"nullif(count(*) FILTER (WHERE {where}), 0)"

    return f"""{name} AS (
  SELECT {key}, count(*) AS n_all, {typed(1)} AS n_view, {typed(2)} AS n_fav, {typed(3)} AS n_cart,
         {typed(4)} AS n_buy, {views(1)} AS v1, {views(3)} AS v3, {views(7)} AS v7,
         min(t) AS first_t, max(t) AS last_t, max(t) FILTER (WHERE behavior_type = 4) AS buy_t,
         any_value(ref_t) AS ref_t, {band('hr BETWEEN 6 AND 13')} AS n_morning,
         {band('hr BETWEEN 14 AND 21')} AS n_afternoon, {band('hr >= 22 OR hr < 6')} AS n_night
  FROM h, ref GROUP BY {key})"""


def _sets(key: str, name: str) -> str:
    def never(kind: str) -> str:
        top = f"count(*) FILTER (WHERE n_{kind} > 0 AND n_buy = 0)"
        return f"{top}::DOUBLE / nullif(count(*) FILTER (WHERE n_{kind} > 0), 0) AS {kind}_not_buy_rate"

    return f"""{name} AS (
  SELECT {key}, {never('view')}, {never('cart')}, {never('fav')}, count(*) AS partners,
         sum(n_all)::DOUBLE / count(*) AS depth,
         count(*) FILTER (WHERE n_buy > 1)::DOUBLE / nullif(count(*) FILTER (WHERE n_buy > 0), 0) AS again
  FROM prs GROUP BY {key})"""


def _peak(key: str, name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT {key}, hr AS peak FROM (
    SELECT {key}, hr, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, hr) AS rn
    FROM h WHERE {where} GROUP BY {key}, hr) WHERE rn = 1)"""


_USER = {
    "total_behavior": "n_all", "total_views": "n_view", "last_1day_pv": "v1", "last_3day_pv": "v3",
    "last_7day_pv": "v7", "activity_growth_rate": "v3::DOUBLE / v7", "total_cart": "n_cart",
    "cart_rate": "n_cart::DOUBLE / n_view", "total_fav": "n_fav", "fav_rate": "n_fav::DOUBLE / n_view",
    "total_buy": "n_buy", "buy_rate": "n_buy::DOUBLE / n_view",
    "first_active_time": "((ref_t - first_t) // 86400)::BIGINT",
    "last_active_time": "((ref_t - last_t) // 86400)::BIGINT",
    "buy_recency": "(ref_t - buy_t)::DOUBLE / 3600",
    "tendency_index": "(n_buy + n_cart)::DOUBLE / n_view", "view_not_buy_rate": "view_not_buy_rate",
    "cart_not_buy_rate": "cart_not_buy_rate", "fav_not_buy_rate": "fav_not_buy_rate",
    "impulsive_buying_rate": "n_buy::DOUBLE / n_view", "hesitation_buying_rate": "n_view::DOUBLE / n_buy",
    "interest_concentration": "top_n::DOUBLE / n_all", "active_hour": "peak",
    "morning_active_rate": "n_morning::DOUBLE / n_all", "afternoon_active_rate": "n_afternoon::DOUBLE / n_all",
    "night_active_rate": "n_night::DOUBLE / n_all",
}
_ITEM = {
    "total_pv": "n_view", "last3day_pv": "v3", "last7day_pv": "v7", "popularity_growth_rate": "v3::DOUBLE / v7",
    "items_pv_ranking": "rnk", "cart_count": "n_cart", "favorite_count": "n_fav", "buy_count": "n_buy",
    "cart_rate": "n_cart::DOUBLE / n_view", "favorite_rate": "n_fav::DOUBLE / n_view",
    "buy_rate": "n_buy::DOUBLE / n_view", "uv": "partners", "view_not_buy_rate": "view_not_buy_rate",
    "cart_not_buy_rate": "cart_not_buy_rate", "fav_not_buy_rate": "fav_not_buy_rate",
    "interest_depth": "depth", "repurchase_index": "again",
    "buy_recency_hours": "(ref_t - buy_t)::DOUBLE / 3600", "peak_view_hour": "pv.peak", "peak_buy_hour": "pb.peak",
}
_CATEGORY = {
    "total_pv": "n_view", "cart_count": "n_cart", "favorite_count": "n_fav", "buy_count": "n_buy",
    "users_count": "users", "buy_rate": "n_buy::DOUBLE / n_view", "peak_view_hour": "pv.peak",
    "peak_buy_hour": "pb.peak",
}


def _listed(exprs: dict[str, str], names: list[str], fill: bool = False) -> str:
    return ", ".join(f"coalesce({exprs[n]}, 0) AS {n}" if fill else f"{exprs[n]} AS {n}" for n in names)


def users() -> str:
    return f"""{_counts('user_id', 'ua')},
{_sets('user_id', 'us')},
{_peak('user_id', 'uh')},
uc AS (SELECT user_id, max(n) AS top_n FROM (
  SELECT user_id, item_category, count(*) AS n FROM h GROUP BY user_id, item_category) GROUP BY user_id),
user_f AS (SELECT user_id, {_listed(_USER, USER_FEATURES)}
  FROM ua JOIN us USING (user_id) JOIN uh USING (user_id) JOIN uc USING (user_id))"""


def items() -> str:
    return f"""{_counts('item_id', 'ia')},
{_sets('item_id', 'isets')},
{_peak('item_id', 'ipv', 'behavior_type = 1')},
{_peak('item_id', 'ipb', 'behavior_type = 4')},
irank AS (SELECT item_id, rank() OVER (ORDER BY n_view DESC) AS rnk FROM ia WHERE n_view IS NOT NULL),
item_f AS (SELECT item_id, {_listed(_ITEM, ITEM_FEATURES)}
  FROM ia JOIN isets USING (item_id) LEFT JOIN irank USING (item_id)
  LEFT JOIN ipv pv USING (item_id) LEFT JOIN ipb pb USING (item_id))"""


def categories() -> str:
    return f"""{_counts('item_category', 'ca')},
{_peak('item_category', 'cpv', 'behavior_type = 1')},
{_peak('item_category', 'cpb', 'behavior_type = 4')},
cu AS (SELECT item_category, count(DISTINCT user_id) AS users FROM h GROUP BY item_category),
cat_f AS (SELECT item_category, {_listed(_CATEGORY, CATEGORY_FEATURES, fill=True)}
  FROM ca JOIN cu USING (item_category) LEFT JOIN cpv pv USING (item_category)
  LEFT JOIN cpb pb USING (item_category))"""


def order_by(seed: object, *keys: str, prefix: str = "") -> str:
    named = ", ".join(prefix + k for k in keys)
    return f"md5(concat_ws('|', '{seed}', {named})), {named}"


ROW = ("user_id", "item_id", "item_category")


def labelled(as_of: datetime, days: int) -> str:
    end = as_of + timedelta(days=days)
    return f"""cand AS (SELECT DISTINCT user_id, item_id, item_category FROM log
  WHERE behavior_type IN (1, 2, 3) AND time < {stamp(as_of)}),
lbl AS (SELECT DISTINCT user_id, item_id, 1 AS label FROM log
  WHERE behavior_type = 4 AND time >= {stamp(as_of)} AND time < {stamp(end)}),
lab AS (SELECT cand.*, coalesce(label, 0)::INTEGER AS label FROM cand LEFT JOIN lbl USING (user_id, item_id))"""


def sampled(ratio: int = 10, seed: object = SEED) -> str:
    return f"""base AS (
  SELECT user_id, item_id, item_category, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY {order_by(seed, *ROW)}) AS rn FROM lab)
  WHERE label = 1 OR rn <= {ratio} * (SELECT count(*) FROM lab WHERE label = 1))"""


# How the joined table names what clashes.
_X_USER = {"cart_rate", "buy_rate", "view_not_buy_rate", "cart_not_buy_rate", "fav_not_buy_rate"}
_XY_ITEM = {"total_pv", "cart_count", "favorite_count", "buy_count", "peak_view_hour", "peak_buy_hour"}


def _joined_names() -> tuple[list[str], list[str], list[str]]:
    users_ = [f"{n}_x" if n in _X_USER else n for n in USER_FEATURES]
    items_ = [f"{n}_y" if n in _X_USER else f"{n}_x" if n in _XY_ITEM else n for n in ITEM_FEATURES]
    cats = [f"{n}_y" if n in _XY_ITEM else n for n in CATEGORY_FEATURES]
    return users_, items_, cats


def feature_columns() -> list[str]:
    return [c for part in _joined_names() for c in part]


def input_columns() -> list[str]:
    return ["item_category"] + [c for c in feature_columns() if c not in NOT_INPUTS]


def joined() -> str:
    parts = []
    sources = (("u", USER_FEATURES), ("i", ITEM_FEATURES), ("c", CATEGORY_FEATURES))
    for (alias, source), shown in zip(sources, _joined_names()):
        parts += [f"coalesce({alias}.{n}, 0) AS {s}" for n, s in zip(source, shown)]
    return f"""ft AS (SELECT b.user_id, b.item_id, b.item_category, b.label, {', '.join(parts)}
  FROM base b LEFT JOIN user_f u USING (user_id) LEFT JOIN item_f i ON b.item_id = i.item_id
  LEFT JOIN cat_f c ON b.item_category = c.item_category)"""


def _allot(source: str, name: str, count: str, total: str, out: str) -> str:
    return f"""{name}q AS (SELECT *, {count}::DOUBLE * {total} / sum({count}) OVER () AS q FROM {source}),
{name} AS (SELECT * EXCLUDE (q), (floor(q) + CASE WHEN row_number() OVER (ORDER BY q - floor(q) DESC, label)
  <= {total} - sum(floor(q)) OVER () THEN 1 ELSE 0 END)::BIGINT AS {out} FROM {name}q)"""


def split_sizes(source: str = "ft") -> str:
    return f"""k0 AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY label),
k1 AS (SELECT label, n, (total - ceil(0.3::DOUBLE * total))::BIGINT AS n_train FROM k0),
{_allot('k1', 'k2', 'n', 'n_train', 'train')},
k3 AS (SELECT *, n - train AS rest, sum(n - train) OVER () AS n_rest FROM k2),
k4 AS (SELECT * EXCLUDE (n_rest), (n_rest - ceil(n_rest::DOUBLE / 3))::BIGINT AS n_val FROM k3),
{_allot('k4', 'k5', 'rest', 'n_val', 'val')},
sizes AS (SELECT label, n, train, val, rest - val AS test FROM k5)"""


def split_rows(source: str = "ft", seed: object = SEED) -> str:
    return f"""{split_sizes(source)},
cut AS (SELECT * EXCLUDE (rn, n_train, n_val), CASE WHEN rn <= n_train THEN 'train'
    WHEN rn <= n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM (SELECT f.*, s.train AS n_train, s.val AS n_val,
          row_number() OVER (PARTITION BY f.label ORDER BY {order_by(seed, *ROW, prefix='f.')}) AS rn
        FROM {source} f JOIN sizes s ON f.label = s.label)),
train AS (SELECT * EXCLUDE (split) FROM cut WHERE split = 'train'),
valid AS (SELECT * EXCLUDE (split) FROM cut WHERE split = 'val')"""


def base_only() -> str:
    """Up to the sampled base of the training queries."""
    return f"{LOG},\n{labelled(TRAIN_AS_OF, TRAIN_DAYS)},\n{sampled()}"


def full_table() -> str:
    return ",\n".join([
        history(TRAIN_AS_OF), users(), items(), categories(), labelled(TRAIN_AS_OF, TRAIN_DAYS), sampled(),
        joined(),
    ])


def full_split() -> str:
    return f"{full_table()},\n{split_rows()}"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
