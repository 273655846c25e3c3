"""Time every report at one scale and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.registry import load_all  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def run(spark, report, folder: str) -> float:
    """Seconds to compute all rows and columns of a report."""
    started = time.perf_counter()
    report(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:]
    spark = build_session(
        app_name="bench",
        master=f"local[{cpus}]",
        settings={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    reports = {n: r for n, r in load_all()[0].items() if not names or n in names}
    run(spark, reports.get("tumbling_count_hour") or next(iter(reports.values())), folder)
    times = {name: round(run(spark, r, folder), 3) for name, r in reports.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_report_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
