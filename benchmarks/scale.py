"""Times core operators on an enlarged, skewed copy of the given tables.

usage: python benchmarks/scale.py SF_DIR FACTOR WORK_DIR

Every row is repeated FACTOR times with shifted keys and times; a third of all rows goes to one case, cell and
vehicle. The copy is written to WORK_DIR once, so that the timed jobs read Parquet with many splits.
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsegrid.operators import evaluation, reports, sampling, stats  # noqa: E402
from pulsegrid.operators.latest import latest_per_cell  # noqa: E402
from pulsegrid.operators.windows import WindowSpec, pollution_results, traffic_results  # noqa: E402
from pulsegrid.plans.views import class_predictions, emissions, labelled_vitals, value_predictions  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402


def enlarged(df: DataFrame, factor: int) -> DataFrame:
    spread = df.repartition(32)
    return spread.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))


def hot(column: str, value) -> F.Column:
    return F.when(F.col("copy") % 3 == 0, F.lit(value)).otherwise(F.col(column))


def main(sf_dir: str, factor: int, work_dir: str) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("scale", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": "32", "spark.driver.memory": "20g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.local.dir": work_dir,
    })
    spark.sparkContext.setLogLevel("ERROR")
    vitals = enlarged(labelled_vitals(spark, sf_dir), factor).withColumns({
        "case_name": hot("case_name", "vsd_case01_fulldata_01.csv"),
        "RelativeTimeMilliseconds": F.col("RelativeTimeMilliseconds") + F.col("copy") * 7,
    })
    vitals.write.parquet(f"{work_dir}/vitals")
    events = enlarged(emissions(spark, sf_dir), factor).withColumns({
        "lat": hot("lat", 40.4002), "lon": hot("lon", -3.7002), "vehicle_id": hot("vehicle_id", "veh1"),
        "event_time": F.col("event_time") + F.make_dt_interval(secs=F.col("copy") % 60),
    })
    events.write.parquet(f"{work_dir}/events")
    vitals, events = spark.read.parquet(f"{work_dir}/vitals"), spark.read.parquet(f"{work_dir}/events")
    timed_rows = evaluation.with_time_norm(vitals)
    sliding = {"size": "10 minutes", "slide": "2 minutes"}
    jobs = {
        "count_above": stats.count_above(vitals, "HR", 100),
        "first_above": stats.first_above(vitals, "HR", 100, tie_break=("case_name",)),
        "grouped_stats": stats.grouped_stats(vitals, "HR"),
        "segment_classification": evaluation.classification_metrics(
            class_predictions(timed_rows), conditions=evaluation.segments()),
        "segment_regression": evaluation.regression_metrics(
            value_predictions(timed_rows), conditions=evaluation.segments()),
        "capped_sample": sampling.capped_sample(vitals, 10_000, ["row_key", "copy"]),
        "probability_histogram": reports.probability_histogram(
            class_predictions(vitals).withColumn("segment", F.lit("full_test")), ["rule_perfusion", "rule_pressure"]),
        "pollution_sliding_panes": pollution_results(events, WindowSpec(**sliding), "all"),
        "pollution_sliding_direct": pollution_results(events, WindowSpec(**sliding, pre_aggregate=False), "all"),
        "traffic_exact_sliding": traffic_results(events, WindowSpec(**sliding, distinct="exact")),
        "traffic_approx_sliding": traffic_results(events, WindowSpec(**sliding)),
        "latest_per_cell": latest_per_cell(pollution_results(events, WindowSpec(**sliding), "CO2")),
    }
    print(f"rows: vitals {vitals.count():,}, events {events.count():,}")
    for name, df in jobs.items():
        seconds = []
        for _ in range(2):
            started = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        print(f"{name:28s} first {seconds[0]:7.2f} s, second {seconds[1]:7.2f} s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), sys.argv[3])
