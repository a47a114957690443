"""Time every registered query on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spokewise.plans.sales import SalesTables  # noqa: E402
from spokewise.registered import REGISTERED  # noqa: E402
from spokewise.session import build_session, staging  # noqa: E402

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "spokewise-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = SalesTables(spark, folder)
    # One untimed run, so that the first query does not pay for starting Spark.
    REGISTERED["sales_by_year"].build(tables).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in REGISTERED:
        with staging(spark):
            start = time.perf_counter()
            REGISTERED[name].build(tables).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "registered queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
