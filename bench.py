"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quayside.plans import catalog
from quayside.session import build_session

WARM_UP_DIR = "/root/testdata/sf0.001"
HEADLINE = (
    "triage_payloads",
    "triage_status_counts",
    "extract_results",
    "idem_first_delivery",
    "idem_replay_rate",
    "dedup_fuzzy_match",
    "dedup_one_block",
    "enrich_lookup",
    "enrich_attempts",
    "breaker_states",
    "intake_results",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed round over the smallest tables: JVM start, class loading, code generation and
    # Python workers are not what is measured.
    for name in names:
        catalog.QUERIES[name](spark, WARM_UP_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
