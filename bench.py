"""Headline queries timed on local[$BENCH_CPUS] over $BENCH_SF_DIR; one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from workbench.catalogue import queries

HEADLINE = (
    "r7_weekly_risk_source",
    "r13_event_attribution",
    "g3_verdict",
    "e15_outcome_table",
    "m9_revenue_table",
    "m11_cnrc",
    "c7_contact_history",
    "a5_month_cost",
    "q1_null_percentage",
    "d3_funnel",
    "d5_population_summaries",
    "d7_segment_summaries",
    "d8_behavior_reference",
    "d15_behavior_profiles",
    "d16_outcome_contrasts",
    "d17_treatment_contrasts",
    "d19_bootstrap_intervals",
    "v2_box_statistics",
    "v7_journey_links",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        # Building plans in Python costs more than running them at this size.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = queries()
    # One untimed query per code path that every session pays once.
    catalogue["d3_funnel"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
