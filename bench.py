"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to completion with the ``noop`` sink, which evaluates all
rows and columns without writing them. Each one runs $BENCH_REPEAT times (2) and
the best time counts, so that compiling the JVM code is not part of it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from surveyloom.queries import QUERIES
from surveyloom.session import get_session

HEADLINE = [
    "a00_priority_rates", "b02_normalize_text", "b09_b15_indicator_flags", "b27_derived_indicators", "c01_filter_prefix",
    "d02_merge_with_audit", "d03_merge_all", "d10_knn_join", "e04_count_if_by_order", "e06_rollup_roster",
    "e07_rollup_education", "e10_numeric_by_target", "e12_profile_columns", "e13_numeric_summary", "e16_iqr_outliers",
    "e20_corr_pairs", "e21_key_audit", "e29_histogram", "f01_first_per_group", "f03_rank_min", "f05_share_of_total",
    "g03_best_per_objective", "j02_rule_violations", "j07_classify_features", "j14_model_ready", "k02_anova_f",
    "k02b_anova_f_many_classes", "k08_mutual_info", "l01b_stratified_split_many_classes", "l02_stratified_folds_counts",
    "l06_standard_scale", "l08_smote_balance", "m01_logistic_scores", "m02_tree_scores", "m12_saved_model_scores_whole_table",
    "k06_ordinal_encode", "k08b_neighbour_information", "l05b_one_hot_level_per_customer", "m03_forest_scores", "f04_mean_rank", "p04_threshold_sweep", "p05b_roc_auc_continuous", "p06_average_precision", "p07_roc_curve",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start-up is not part of any query
    times = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_REPEAT", "2"))):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
