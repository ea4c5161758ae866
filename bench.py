"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from lodestone import plans
from lodestone.session import build_session, clear_scratch

HEADLINES = [
    "rp_yearly_sales", "rp_zscore", "rp_by_experience", "rp_ad_top3", "rp_ip_top", "rp_hourly_flow", "jn_inner_sql", "jn_star", "jn_lookup_null",
    "prj_audience", "ag_statcounter", "ag_count_distinct", "ag_hist_wide", "ag_median", "ag_bestseller", "ag_collect_list", "wn_rank",
    "wn_row_number", "wn_running_sum_avg", "wn_equal_freq_bins", "wn_top3_group", "wn_delta", "set_distinct", "st_sliding", "st_user_clicks",
    "udf_aggregator", "fe_standard", "fe_chisq", "tx_token_counts", "tx_tfidf", "ev_auc", "ev_mapk", "ml_linreg", "ml_kmeans", "ml_fpgrowth",
    "rc_item_cosine", "rc_item_based", "rc_simrank", "tx_word2vec", "ml_als_topn", "rp_model_compare",
    "ml_sgd_sweep", "ml_tree_levels", "rc_part_sampled",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    conf = {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.lodestone.spread": cpus,  # the tables come in one row group each
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the engine before the clock
    seconds = {}
    for name in names.split(",") if names else HEADLINES:
        start = time.perf_counter()
        plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_scratch(spark)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
