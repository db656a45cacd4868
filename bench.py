"""Time the headline queries and the gated run; prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1). BENCH_CPUS: local cores.
Each query is built and run to a sink that discards the rows: one warm-up, then the median of three.
``gated_run`` ingests CSV sources derived from the same tables through Bronze, Silver and Gold with
all quality gates.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from degraus import get_session, scratch_dir
from degraus.plans.run import Lake, run
from suite.queries import REGISTRY
from suite.sources import write_sources

HEADLINE = [
    "scan_filter", "cast_lenient", "unpivot_latest", "dedup_last", "headline_pick", "bool_cast", "integrated",
    "static_enrich", "national_gap", "dict_decode", "ref_integrity", "gold_entity", "uf_rollup", "uf_comparison",
    "yoy_change", "uf_ranking", "muni_delta", "attainment_summary", "micro_history", "micro_uf_rank",
    "histogram_fixed", "median", "corr_matrix", "table_profile", "dq_report", "stream_valid", "stream_dedup",
    "stream_monitor",
]
RUNS = 3


def _timed(step) -> float:
    start = time.perf_counter()
    step()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        app="degraus-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    times = {}
    for name in HEADLINE:
        def step(fn=REGISTRY[name]):
            fn(spark, sf).write.format("noop").mode("overwrite").save()

        step()
        times[name] = round(statistics.median(_timed(step) for _ in range(RUNS)), 3)

    work = scratch_dir(spark, "bench")
    raw = write_sources(spark, sf, f"{work}/raw")
    outcomes = []

    def gated(i):
        outcomes.append(run(Lake(spark, f"{work}/lake-{i}", raw)))

    gated("warm")
    times["gated_run"] = round(statistics.median(_timed(lambda i=i: gated(i)) for i in range(RUNS)), 3)
    if not all(o.published for o in outcomes):
        raise RuntimeError(f"gated run stopped at {[o.stopped_at for o in outcomes]}")

    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
