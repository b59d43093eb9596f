"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
from pyspark.sql import SparkSession  # noqa: E402

from pitchline.queries import QUERIES  # noqa: E402

HEADLINE = ["feat_goal_difference", "feat_team_performance", "feat_home_advantage", "feat_head_to_head", "feat_rest_days", "feat_recent_form", "feat_rolling_stats", "feat_all_prefixed", "hist_team_stats", "clean_full", "contract_violations", "prof_describe", "prof_corr_pairs", "ds_build_from_result", "split_chrono_assign", "prep_standard_scale", "eval_auc"]


def main() -> None:
    d, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["feat_goal_difference"](spark, d).write.format("noop").mode("overwrite").save()  # compiles what all share
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(d.rstrip("/").rpartition("sf")[2] or 0)}))


if __name__ == "__main__":
    main()
