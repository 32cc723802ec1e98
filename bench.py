"""Benchmark: the ten analytics queries, and the load path behind them.

Prints one JSON line. The headline is the sum over the ten queries computed straight
from the given tables (median of three runs after a warm-up). ``star.*`` are the same
queries over the stored star schema; ``load.*`` are steps of a run over raw records.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from devtide.operators import star  # noqa: E402
from devtide.plans.analytics import QUERIES  # noqa: E402
from devtide.plans.binding import AS_OF, BoundStar  # noqa: E402
from devtide.plans.raw_binding import EXTRACTED_AT, RawRecords  # noqa: E402
from devtide.session import local_session  # noqa: E402
from devtide.sources import landing, staging  # noqa: E402
from devtide.sources.warehouse import Warehouse, months_filter  # noqa: E402

RUNS = 3
FACTS = ("fact_commit", "fact_pull_request", "fact_review", "fact_issue")


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def median(run: Callable[[], object], runs: int = RUNS) -> float:
    run()
    return round(statistics.median(timed(run) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="devtide-bench-")
    spark = local_session(cpus, "devtide-bench", **{"spark.checkpoint.dir": scratch})
    bound = BoundStar(spark, sf_dir)
    times = {}
    for name, query in QUERIES.items():
        times[name] = median(lambda q=query: q(bound, AS_OF).collect())
    headline = round(sum(times.values()), 3)

    warehouse = Warehouse(spark, f"{scratch}/warehouse")
    load = warehouse.begin("bench")
    for table in FACTS:
        load.put_months(table, bound[table], [])
    load.publish()
    stored = dict(bound) | {table: warehouse.read(table) for table in FACTS}
    for name, query in QUERIES.items():
        times[f"star.{name}"] = median(lambda q=query: q(stored, AS_OF).collect())

    raw = RawRecords(spark, sf_dir)
    landed = {e: landing.write_landing(raw[e], scratch, "bench", e, EXTRACTED_AT) for e in raw}

    def classify() -> None:
        for entity in landed:
            rows = landing.read_landing(spark, scratch, "bench", entity)
            staging.write_classified(rows, scratch, "bench", entity)

    times["load.check_and_flatten"] = median(classify, 1)

    pulls = warehouse.read("fact_pull_request")
    months = [r[0] for r in pulls.select("event_month").distinct().orderBy("event_month").collect()]
    recent = months[-max(1, len(months) // 100) :]

    def merge() -> None:
        change = warehouse.begin("merge")
        rows = change.keep_incoming(
            "fact_pull_request",
            pulls.filter(F.col("event_month").isin(recent)).withColumn("title", F.lit("x")),
        )
        touched = change.touched_months("fact_pull_request", rows, ["pull_request_key"])
        target = change.read("fact_pull_request").filter(
            months_filter("fact_pull_request", touched)
        )
        merged = star.merge_fact("fact_pull_request", target, rows)
        change.put_months("fact_pull_request", merged, touched, rows)

    times["load.merge_recent_months"] = median(merge)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "ten analytics queries, sum of medians",
                "value": headline,
                "unit": "sec",
                "queries": times,
                "raw_records": sum(landed.values()),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
