"""Print condensed physical plans of the headline operators (writes PLANS.md).

usage: python tools/plans.py [sf_dir] > PLANS.md
Plans are taken from the written warehouse (fact partitioned by started_month),
the way the KPI queries run after a refresh.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spokes.operators import facts, kpis, marts, stations, zones  # noqa: E402
from spokes.plans import registry, warehouse  # noqa: E402
from spokes.session import local_session, work_dir  # noqa: E402
from spokes.sources import zones as zone_src  # noqa: E402

KEEP = re.compile(
    r"(Exchange|BroadcastExchange|HashAggregate|SortAggregate|ObjectHashAggregate|SortMergeJoin|BroadcastHashJoin|"
    r"ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|WindowGroupLimit|Window |Generate|FileScan|Filter|"
    r"Sort \[|MapInPandas|Union|Expand)"
)


def condensed(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "", line)
            out.append(line[:420] if "FileScan" in line else line[:220])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(shuffle_partitions=8)
    wh = warehouse.materialize(spark, warehouse.fixture_warehouse(spark, sf), work_dir(spark, "plans"))
    f = registry.FILTER
    meta = zone_src.zone_meta(zone_src.grid_cell_meta(spark, sf), "neighborhood")
    pop = zone_src.zone_population(spark, sf, "neighborhood")
    mapping = zone_src.station_zone_map(wh.dim, spark, sf, "neighborhood", registry.ZONE_SYSTEM)
    mart = marts.zone_rollup(wh.fct, mapping, meta, pop, registry.ZONE_SYSTEM, "neighborhood_name")
    items = {
        "fct_rides (dedup -> features -> B3), from the unioned staging": facts.fct_rides(wh.unioned),
        "dim_stations": stations.dim_stations(wh.unioned),
        "agg_rides_daily (from the written fact)": marts.agg_rides_daily(wh.fct),
        "zone_rollup (neighborhood)": mart,
        "zone_metrics": zones.zone_metrics(mart, "neighborhood_name", f.month_start, f.month_end),
        "top_routes_geo": kpis.top_routes_geo(wh.fct, wh.dim, f, 5),
        "rides_by_hour (partition + pushed filters on the written fact)": kpis.rides_by_hour(wh.fct, f),
        "city_summary": kpis.city_summary(wh.daily, wh.dim, wh.fct, f),
    }
    print("# Physical plans of the headline operators\n")
    print(f"Generated by `python tools/plans.py {sf}` (local[*], shuffle partitions 8, AQE initial plans).")
    print("Only operators that decide cost are kept: scans (pushed filters, read schema), exchanges,")
    print("aggregates (partial/final), joins, windows, generators.\n")
    for title, df in items.items():
        print(f"## {title}\n\n```")
        print("\n".join(condensed(df)))
        print("```\n")


if __name__ == "__main__":
    main()
