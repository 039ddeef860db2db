"""Times the headline plans and prints one JSON line.

Each layer is landed as Parquet once, as the jobs do it, and every plan is timed over the layer it
reads in production; nothing is cached between plans or runs. A figure is the median of the timed
runs after one warm-up run. `layers` has the seconds it took to land each layer, and `raw` those of one run of
each plan as a whole, from the raw table, the measure of earlier baselines.

    BENCH_SF_DIR  tables, default /root/testdata/sf0.1
    BENCH_CPUS    cores, default all
    BENCH_RUNS    timed runs per plan, default 3
    BENCH_WHOLE   set to time every registered query from the raw tables instead
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.registry import QUERIES
from tramline.operators.last_known import attach_delay
from tramline.operators.proximity import flag_bunching
from tramline.plans import dashboard, history, marts, quality
from tramline.plans.enrich import enrich
from tramline.plans.staging import stage_events
from tramline.session import local_session, scratch_folder
from tramline.sources import feed, sample

Plan = Callable[[], DataFrame]


def run(plan: Plan) -> float:
    start = time.perf_counter()
    plan().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def land(spark: SparkSession, folder: str, tables: str) -> tuple[Callable[[str], DataFrame], dict[str, float]]:
    """Lands every layer and returns a reader of them and what each took."""
    took = {}

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    layers: dict[str, Plan] = {
        "messages": lambda: sample.messages_with_gaps(spark, tables),
        "positions": lambda: sample.positions(spark, tables),
        "updates": lambda: sample.trip_updates(spark, tables),
        "enriched": lambda: enrich(read("positions"), read("updates")),
        "silver": lambda: sample.repolled(read("enriched")),
        "staged": lambda: stage_events(read("silver")),
        "live": lambda: dashboard.live_state(read("enriched")),
    }
    for name, plan in layers.items():
        start = time.perf_counter()
        plan().write.parquet(f"{folder}/{name}")
        took[name] = round(time.perf_counter() - start, 3)
    return read, took


def headline(spark: SparkSession, read: Callable[[str], DataFrame]) -> dict[str, Plan]:
    agencies = sample.agencies(spark)

    def board() -> DataFrame:
        return dashboard.board_rows(read("live"), agencies)

    return {
        "decode_positions": lambda: feed.decode_positions(read("messages")),
        "attach_delay": lambda: attach_delay(read("positions"), read("updates")),
        "bunching": lambda: flag_bunching(read("positions")),
        "silver_events": lambda: sample.repolled(enrich(read("positions"), read("updates"))),
        "staged_events": lambda: stage_events(read("silver")),
        "busiest_routes": lambda: marts.busiest_routes(read("staged")),
        "delay_by_hour": lambda: marts.delay_by_hour(read("staged")),
        "operator_performance": lambda: marts.operator_performance(read("staged"), agencies),
        "headway_adherence": lambda: marts.headway_adherence(read("staged")),
        "top_routes_by_delay": lambda: marts.top_routes_by_delay(read("staged")),
        "live_state": lambda: dashboard.live_state(read("enriched")),
        "network_kpis": lambda: dashboard.network_kpis(board()),
        "vehicle_board": lambda: dashboard.vehicle_board(board()),
        "delay_trend_1min": lambda: history.delay_trend(read("silver")),
        "dq_stale_delay": lambda: quality.stale_delays(read("staged")),
    }


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("BENCH_WHOLE"):
        plans = {name: (lambda q=query: q(spark, tables)) for name, query in QUERIES.items()}
        layers = {}
    else:
        read, layers = land(spark, scratch_folder(spark, "bench"), tables)
        plans = headline(spark, read)
    times = {}
    for name, plan in plans.items():
        run(plan)
        times[name] = round(statistics.median(run(plan) for _ in range(runs)), 3)
    raw = {name: round(run(lambda name=name: QUERIES[name](spark, tables)), 3) for name in times if layers}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline plans over landed layers",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": tables.rstrip("/").rsplit("sf", 1)[-1],
                "layers": layers,
                "landing": round(sum(layers.values()), 3),
                "raw": raw,
                "raw_total": round(sum(raw.values()), 3),
                "cores": spark.sparkContext.defaultParallelism,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
