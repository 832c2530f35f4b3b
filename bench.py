"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the input folder (default sf0.1), BENCH_CPUS the local threads (default 8).
``derive`` is the time to build the flow and lookup tables from the driver's tables;
``training_table`` and ``imputed_table`` are the tables that several queries start from. Each query is run once, in full.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "q03_mirror_join",
    "q08_convert_hs_impute",
    "q09_unit_ratios",
    "q10_unit_value_median",
    "q16_training_set",
    "q24_ols_small",
    "q27_trim_rounds",
    "q34_imputation_summary",
    "q33_mirror_output",
    "q38_ppml",
    "q42_coefficient_table",
    "q53_fit_store_impute",
    "q43_page_elements",
    "q44_page_tables",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from mirrorflow.sources.scratch import clear_scratch, local_session

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mirrorflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = local_session(builder)
    spark.sparkContext.setLogLevel("ERROR")

    from catalogue.derive import fixture
    from catalogue.queries import QUERIES, imputed, training_table

    times: dict[str, float] = {}
    shared = {"derive": lambda fx: (fx.flows, fx.lookups), "training_table": training_table, "imputed_table": imputed}
    for name, build in shared.items():
        start = time.perf_counter()
        build(fixture(spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
