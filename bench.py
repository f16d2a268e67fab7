"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query runs in full
into a sink that keeps nothing; planning jobs and intermediate tables count. Results are not
rounded, as they are for the comparison with SQL. Before the clock starts every query runs
once on the smallest tables beside that folder, so that the JVM is warm.
BENCH_QUERIES may name other queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from weekloom import build_session  # noqa: E402

HEADLINE = (
    "sales_features",
    "lag_features",
    "pit_join",
    "training_features",
    "pit_join_broadcast",
    "pit_join_events",
    "materialize_latest",
    "materialize_sales",
    "online_lookup",
    "online_service",
    "on_demand_features",
    "chrono_split",
    "scaled_features",
    "training_matrix",
    "generate_sales",
    "batch_score",
    "sales_features_incremental",
    "materialize_incremental",
    "pit_join_bucketed",
    "chrono_split_three",
    "permutation_split",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries.ROUNDING = False

    def run(name: str, where: str) -> None:
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()

    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(name, small)

    # A fixed piece of work, so that rounds on machines of different speed can be compared.
    began = time.perf_counter()
    spark.range(0, 100_000_000, 1, int(cpus)).selectExpr("sum(hash(id, id + 1))").collect()
    calibration = round(time.perf_counter() - began, 3)

    seconds, rows = {}, {}
    for name in names:
        began = time.perf_counter()
        run(name, folder)
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    for name in ("training_features",):
        if name in seconds:
            rows[name] = QUERIES["entity_spine_friday"](spark, folder).count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {n: round(r / seconds[n]) for n, r in rows.items()},
                "calibration_sec": calibration,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
