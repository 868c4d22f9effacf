"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsegrid.plans.queries import REGISTRY  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

HEADLINE = [
    "filter_count", "filter_sort_top20", "grouped_stats", "grouped_stats_native", "profile_columns",
    "rename_sanitize_cast", "label_distribution", "time_norm", "segment_metrics", "segment_reg_metrics",
    "pollution_tumbling", "pollution_sliding", "pollution_all", "traffic_exact", "traffic_sliding",
    "traffic_approx", "pollution_json_roundtrip", "xml_emissions", "grid_to_wgs84", "pollution_map_layer",
    "traffic_map_layer", "residual_hist", "prob_hist", "longest_case_trace", "hash_split", "capped_sample",
    "budget_sample", "greedy_budget_sample", "residual_density", "time_norm_per_case", "landing_stream",
    "stream_pollution_update", "stream_pollution_final", "stream_traffic", "rf_reg", "auc_scales",
    "traffic_approx_sliding", "stream_compacted", "stream_map_layer", "xml_rejects",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["filter_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
