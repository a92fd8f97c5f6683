"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores).
``stage_inputs`` is the time to write the dirty input tables the queries read.
"""

from __future__ import annotations

import json
import os
import time

from tamiz.runtime import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_text", "fold_key", "phone_clean", "missing_report", "profile_columns", "exact_dups",
    "repeated_ids", "unify_variants", "canonical_lookup", "repeated_names", "row_lineage",
    "html_records", "page_fields_map", "clean_table", "transform_log", "fuzzy_pairs",
    "decision_summary", "quality_report",
]


def main() -> None:
    # The small staged tables are split for all cores, as large ones are by their size.
    spark = local_session(CPUS, "tamiz-bench", conf={
        "spark.sql.files.minPartitionNum": CPUS, "spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "64k",
    })
    spark.sparkContext.setLogLevel("OFF")
    from workload import fixtures
    from workload.all_queries import QUERIES

    times = {}
    start = time.time()
    for text in (fixtures.DIRTY_TEXT, fixtures.PHONES, fixtures.SCHOOLS, fixtures.CATALOG,
                 fixtures.PRODUCTS, fixtures.HTML_FILES):
        fixtures.fixture(spark, SF_DIR, text)
    times["stage_inputs"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR,
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
