"""Time the headline queries and print one JSON line.

Every query runs twice from the source tables; the second, warm run is reported. The
result is computed in full and thrown away (``noop`` sink), so no time goes into
bringing rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from spendfall.plans.star_queries import star_queries  # noqa: E402
from spendfall.session import build_session  # noqa: E402

HEADLINE = [
    "usage_index",
    "dq_report",
    "cascade_allocation",
    "cascade_residual",
    "residual_report",
    "reconciliation",
    "recon_by_line",
    "lineage",
    "application_tco",
    "bu_showback",
    "driver_comparison",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "spendfall-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = star_queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name}))
    spark.stop()


if __name__ == "__main__":
    main()
