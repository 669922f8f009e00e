"""Benchmark: the refresh chain and headline queries at one scale factor.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
    BENCH_EVENT_LOG_DIR (optional: write a Spark event log there for tools/stage_times.py)

Prints ONE JSON line: {"metric", "value" (sum of the chain's median seconds),
"unit": "sec", "queries": {name: median sec}, "sf", ...}.  Each step writes
its table (like a refresh does) or collects its small result, so every
timing covers real work; a warm-up run precedes the measured runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from pyspark.sql import functions as F  # noqa: E402

from spokes.operators import facts, incremental, kpis, marts, quality, stations, zones  # noqa: E402
from spokes.operators import staging  # noqa: E402
from spokes.plans import registry  # noqa: E402
from spokes.session import local_session, work_dir  # noqa: E402
from spokes.sources import fixtures  # noqa: E402
from spokes.sources import zones as zone_src  # noqa: E402

CHAIN = ("fct_rides", "dim_stations", "agg_rides_daily", "zone_metrics")


def one_run(spark, sf_dir: str) -> dict[str, float]:
    t: dict[str, float] = {}
    root = work_dir(spark, "bench")
    # Land the staged trips once (the raw/staging table of a deployment); the
    # chain then reads that table like the models read their sources.
    # A distributed ingest lands many files; the fixture's beta rows come from
    # one lineitem file, so spread them (round-robin) like a landing would.
    s = time.perf_counter()
    staged = staging.union_rides(*fixtures.staged_trips(spark, sf_dir).values())
    staged.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.partitionBy("system").parquet(
        f"{root}/staged"
    )
    t["land_trips"] = time.perf_counter() - s
    unioned = spark.read.parquet(f"{root}/staged")

    s = time.perf_counter()
    incremental.write_fact(facts.fct_rides(unioned), f"{root}/fct")
    t["fct_rides"] = time.perf_counter() - s
    fct = incremental.read_fact(spark, f"{root}/fct")

    s = time.perf_counter()
    stations.dim_stations(unioned).write.parquet(f"{root}/dim")
    t["dim_stations"] = time.perf_counter() - s
    dim = spark.read.parquet(f"{root}/dim")

    s = time.perf_counter()
    marts.agg_rides_daily(fct).write.parquet(f"{root}/daily")
    t["agg_rides_daily"] = time.perf_counter() - s
    daily = spark.read.parquet(f"{root}/daily")

    # Zone seeds (polygon meta, population, station -> zone) are static inputs
    # of the zone mart, loaded like seed files; built and written first.
    s = time.perf_counter()
    zone_src.zone_meta(zone_src.grid_cell_meta(spark, sf_dir), "neighborhood").write.parquet(
        f"{root}/seed_meta"
    )
    zone_src.zone_population(spark, sf_dir, "neighborhood").write.parquet(f"{root}/seed_pop")
    zone_src.station_zone_map(dim, spark, sf_dir, "neighborhood", registry.ZONE_SYSTEM).write.parquet(
        f"{root}/seed_map"
    )
    specs = []
    for name, spec in zone_src.BOUNDARIES.items():
        _, b_meta, b_pop, b_map = registry.zone_inputs(spark, sf_dir, name, registry.warehouse.Warehouse(
            unioned=unioned, fct=fct, daily=None, _dim=dim))
        for part, df in (("meta", b_meta), ("pop", b_pop), ("map", b_map)):
            df.write.parquet(f"{root}/seed_{name}_{part}")
        display = (spec["display_col"],) if spec["display_col"] else ()
        specs.append(marts.Boundary(name, spec["id_col"], *(spark.read.parquet(f"{root}/seed_{name}_{p}")
                                                             for p in ("map", "meta", "pop")), display))
    t["zone_seeds"] = time.perf_counter() - s
    meta, pop, mapping = (spark.read.parquet(f"{root}/seed_{n}") for n in ("meta", "pop", "map"))

    s = time.perf_counter()
    mart = marts.zone_rollup(fct, mapping, meta, pop, registry.ZONE_SYSTEM, "neighborhood_name")
    mart.write.parquet(f"{root}/zone")
    zm = zones.zone_metrics(spark.read.parquet(f"{root}/zone"), "neighborhood_name",
                            registry.FILTER.month_start, registry.FILTER.month_end)
    zm.collect()
    t["zone_metrics"] = time.perf_counter() - s

    # Incremental run with nothing new (the reference's recorded no-op run).
    s = time.perf_counter()
    incremental.run_incremental(spark, unioned, f"{root}/fct")
    t["fct_incremental_noop"] = time.perf_counter() - s

    # All four boundary marts from one fact scan.
    s = time.perf_counter()
    for name, m in marts.zone_rollups(fct, specs, registry.ZONE_SYSTEM).items():
        m.write.parquet(f"{root}/zone_all_{name}")
    t["zone_marts_all4"] = time.perf_counter() - s

    # The whole data-quality suite: one grouped aggregate per model, zone marts included.
    s = time.perf_counter()
    frames = {"fct_rides": fct, "dim_stations": dim, "agg_rides_daily": daily, "rides_unioned": unioned}
    frames |= {f"stg_{x}": unioned.where(F.col("system") == x) for x in ("alpha", "beta")}
    frames |= {f"agg_zone_{b.name}": spark.read.parquet(f"{root}/zone_all_{b.name}") for b in specs}
    quality.report(quality.run_suites(frames, registry.dq_suites())).collect()
    t["dq_suite"] = time.perf_counter() - s

    f = registry.FILTER
    headline = {
        "overview_kpis": lambda: kpis.overview_kpis(daily, f),
        "duration_stats": lambda: kpis.duration_stats(daily, f),
        "busiest_quietest_day": lambda: kpis.busiest_quietest_day(daily, f),
        "city_summary": lambda: kpis.city_summary(daily, dim, fct, f),
        "top_start_stations_geo": lambda: kpis.top_stations_geo(fct, dim, f, "start", 10),
        "top_routes_geo": lambda: kpis.top_routes_geo(fct, dim, f, 5),
        "rides_by_hour": lambda: kpis.rides_by_hour(fct, f),
        "shortest_between_stations": lambda: kpis.shortest_between_stations(fct, f),
    }
    for name, q in headline.items():
        s = time.perf_counter()
        q().collect()
        t[name] = time.perf_counter() - s
    return t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # Stage/task timings for tools/stage_times.py (written to a scratch folder).
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, 4 * cpus), app="spokes-bench", extra=extra)
    one_run(spark, sf_dir)  # warm-up: JIT, codegen caches, OS page cache
    samples: dict[str, list[float]] = {}
    for _ in range(runs):
        for k, v in one_run(spark, sf_dir).items():
            samples.setdefault(k, []).append(v)
    med = {k: round(statistics.median(v), 4) for k, v in samples.items()}
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() + spark.read.parquet(f"{sf_dir}/events.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "refresh_chain_seconds",
        "value": round(sum(med[k] for k in CHAIN), 4),
        "unit": "sec",
        "queries": med,
        "sf": float(m.group(1)) if m else sf_dir,
        "trip_rows": rows,
        "cpus": cpus,
        "runs": runs,
        "chain": list(CHAIN),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
