"""Time the headline queries; prints one JSON line.

Every query runs twice over whole tables; the second run counts, the first
one is listed beside it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daybook.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "full_refresh",
    "full_refresh_in_chunks",
    "first_dates",
    "daily_aggregates",
    "running_totals",
    "incremental_update",
    "dynamic_overwrite",
    "update_from_table",
    "append_indexed",
    "upsert_stored",
    "surrogate_key",
    "summary_full",
    "clean_transactions",
    "dedup_first",
    "append_ignore",
    "load_transactions",
    "control_totals",
    "column_profile",
    "extract_window",
    "csv_round_trip",
    "stream_ingest",
    "merchant_export",
    "id_strip_and_pad",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "daybook-bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    first = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    second = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
