"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. After one cold round
over all queries each runs twice warm, writing all its rows to the no-op sink; the better run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from driver.queries import QUERIES  # noqa: E402

HEADLINE = (
    "productivity_by_country",
    "underperforming_by_country",
    "worst_routes",
    "dedup_latest",
    "effectiveness_by_country",
    "effectiveness_by_partner",
    "oth_by_fleet",
    "oth_by_hour",
    "late_night_by_country",
    "hour_corruption_matrix",
    "overlap_pairs",
    "overlap_adjacent",
    "overlap_summary",
    "consistency_profile",
    "partner_duplication",
    "audit_unified",
    "dq_fk_orphans",
    "dq_null_profile",
    "clean_dates",
    "network_kpis",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("waybill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    cold = {name: round(timed(name), 3) for name in HEADLINE}
    warm = {name: round(min(timed(name), timed(name)), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of warm seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
