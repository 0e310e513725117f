"""Bench: run the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is planned and executed into the ``noop`` sink (every row is produced, nothing is
written), once as warm-up and then ``$BENCH_RUNS`` times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listenkpi import queries as Q  # noqa: E402
from listenkpi.session import drop_scratch, local_session  # noqa: E402

HEADLINE = [
    "genre_kpis",
    "daily_genre_kpis",
    "top_songs",
    "top_genres",
    "daily_genre_kpis_per_play",
    "daily_genre_kpis_events",
    "csv_roundtrip_kpis",
    "kpi_upsert",
    "kpi_incremental",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = Q.REGISTRY[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in sys.argv[1:] if q in Q.REGISTRY] or [q for q in HEADLINE if q in Q.REGISTRY]
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else None, app="listenkpi-bench")
    times: dict[str, float] = {}
    for name in only:
        run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, Python imports
        samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {samples}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
