"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local threads. Each query is run from its
inputs, with nothing prepared left over, and its whole result is consumed. One untimed query first
starts the JVM's workers.
"""

from __future__ import annotations

import json
import os
import time

from footfall.catalog import QUERIES
from footfall.catalog.registry import forget, matrices, prepared
from footfall.session import build_session

HEADLINE = [
    "user_features", "item_features", "category_features", "i8_items_pv_ranking", "u22_interest_concentration",
    "v1_view_not_buy_by_event", "v12_view_not_buy_anti_join", "j2_three_lookups", "q2_item_view_not_buy",
    "b4_sample_negatives", "b6_feature_table",
]
# These start from the written training table, as users of the pipeline do; writing it is b6.
FROM_TABLE = [
    "d1_stratified_split", "f2_variance_filter", "f4_drop_redundant", "r2_oversample_1_0", "r3_undersample_1_0",
    "r1_smote_1_0", "m8_roc_auc", "m9_roc_curve",
]
# These start from the matrices of the chosen features; choosing them is timed as choose_features.
FITS = [
    "m2_early_stopping", "m4_logistic_regression", "f9_permutation_importance", "m10_learning_curve",
    "m11_model_comparison", "m12_rebalancing_grid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("a1_group_count")
    times = {}
    for name in HEADLINE:
        forget()
        times[name] = run(name)
    forget()
    prepared(spark, sf_dir)
    for name in FROM_TABLE:
        times[name] = run(name)
    start = time.perf_counter()
    matrices(spark, sf_dir)
    times["choose_features"] = round(time.perf_counter() - start, 3)
    for name in FITS:
        times[name] = run(name)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
