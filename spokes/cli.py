"""Command line: one refresh run (land -> fact -> dimension -> marts -> checks).

    spark-submit spokes_refresh.py refresh --landing <dir> --root <dir> [--full-refresh]
    python -m spokes.cli refresh --landing <dir> --root <dir> --local

Under ``spark-submit`` the submitted session (master, ``spark.checkpoint.dir``)
is used as is; ``--local`` starts a local session for trying it out.  Exits
non-zero when a check fails with severity error, a file is rejected or a source
is stale beyond its error threshold.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .plans.refresh import RefreshConfig, refresh, seeded_boundaries
from .session import apply_defaults, ensure_checkpoint_dir, local_session
from .sources import trips_csv


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="spokes")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="ingest new trip files and rebuild the marts")
    r.add_argument("--landing", required=True, help="folder with monthly trip CSVs")
    r.add_argument("--root", required=True, help="shared folder holding raw, fact, dimension and marts")
    r.add_argument("--full-refresh", action="store_true", help="rebuild the fact instead of an incremental run")
    r.add_argument("--seeds", help="folder with the boundaries' seed CSVs: their zone marts are built")
    r.add_argument("--zone-layer", help="GeoJSON zones (property zone_id): stations and population are worked out")
    r.add_argument("--tract-layer", help="GeoJSON census tracts (property GEOID), with --zone-layer")
    r.add_argument("--census", help="census API response for the tracts, with --zone-layer")
    r.add_argument("--zone-system", help="the system whose stations the zones hold")
    r.add_argument("--fixture-systems", action="store_true", help="route alpha/beta fixture files instead")
    r.add_argument("--local", action="store_true", help="start a local[*] session")
    args = ap.parse_args(argv)

    spark = local_session() if args.local else SparkSession.builder.getOrCreate()
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    patterns = trips_csv.FIXTURE_SYSTEM_PATTERNS if args.fixture_systems else trips_csv.REFERENCE_SYSTEM_PATTERNS
    cfg = RefreshConfig(landing=args.landing, root=args.root, patterns=dict(patterns),
                        full_refresh=args.full_refresh,
                        coord_type="double" if args.fixture_systems else "decimal(18,15)",
                        boundaries=seeded_boundaries(spark, args.seeds) if args.seeds else (),
                        zone_layer=args.zone_layer, tract_layer=args.tract_layer, census=args.census)
    if args.zone_layer and not (args.tract_layer and args.census):
        ap.error("--zone-layer needs --tract-layer and --census")
    if args.zone_system:
        cfg.zone_system = args.zone_system
    out = refresh(spark, cfg, as_of=dt.datetime.now())
    summary = {r["status"]: r["n"] for r in trips_csv.ingest_summary(out["ingest"]).collect()}
    print(f"loaded: {summary.get('loaded', 0)}   skipped: {summary.get('skipped', 0)}   "
          f"failed: {summary.get('failed', 0)}")
    report = {r["status"]: r["n"] for r in out["dq_report"].collect()}
    print("checks: " + "  ".join(f"{k}={report.get(k, 0)}" for k in ("PASS", "WARN", "ERROR")))
    for row in out["dq_results"].where("failures > 0").orderBy("model", "test").collect():
        print(f"  [{row['severity']}] {row['model']}.{row['test']}: {row['failures']}")
    stale = {r["source"]: r["status"] for r in out["freshness"].collect()}
    print("freshness: " + "  ".join(f"{k}={v}" for k, v in sorted(stale.items())))
    return 1 if report.get("ERROR", 0) or summary.get("failed", 0) or "error" in stale.values() else 0


if __name__ == "__main__":
    sys.exit(main())
