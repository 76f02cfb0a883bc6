"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from ledgerloom.queries import QUERIES
from ledgerloom.session import local_session

HEADLINE = [
    "monthly_kpis",
    "group_sum",
    "dedup_subset",
    "kpi_fact_build",
    "surrogate_delta",
    "row_number_per_year",
    "formula_tree",
    "report_mapping",
    "ytd_cumulative",
    "lag_previous",
    "month_from_fx_cumulative",
    "cost_block",
    "unit_conversion",
    "currency_block",
    "monthly_publish",
    "order_total",
    "stock_after",
    "order_validate",
    "replace_slice",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shuffle_partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, shuffle_partitions, spark__driver__memory="12g")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The whole result is computed and thrown away.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
