"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

from meterbook.catalog import MODELS, run
from meterbook.scenarios import SCENARIOS
from meterbook.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))

# Everything the models compute from the landed text, then what runs over stored tables.
HEADLINE = [
    *MODELS,
    "event_properties",
    "inc_fact_after_late_rows",
    "scd2_history",
    *[name for name in SCENARIOS if name.startswith(("dq_", "qry_"))],
    "ingest_reject_reasons",
    "inc_stored_fact_after_late_rows",
    "inc_invoices_after_update",
    "inc_landed_usage_refreshed",
    "scd2_subscription_history",
    "stream_daily_usage",
]


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": str(CPUS)})
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query loads classes and compiles the common code paths.
    run("mart_mrr", spark, FOLDER).collect()
    # Built once and shared by the queries over stored tables; timed by itself.
    times: dict[str, float] = {}
    from meterbook.scenarios import built
    from meterbook.sources.bindings import Bindings

    begin = time.time()
    built(Bindings(spark, FOLDER))
    times["full_build"] = round(time.time() - begin, 3)
    for name in sys.argv[1:] or HEADLINE:
        begin = time.time()
        run(name, spark, FOLDER).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
