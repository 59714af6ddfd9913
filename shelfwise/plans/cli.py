"""Command line: land sources, rebuild or update the snapshot, materialise marts, report runs.

    python -m shelfwise land --sf-dir /root/testdata/sf0.1 --out /shared/landing
    python -m shelfwise rebuild --sources /shared/landing --root /shared/snapshot --as-of 2024-02-01
    python -m shelfwise incremental --sources /shared/landing --root /shared/snapshot --as-of 2024-02-02
    python -m shelfwise marts --root /shared/snapshot --out /shared/marts --as-of 2024-02-01
    python -m shelfwise report --telemetry /shared/telemetry

Paths must be on storage every executor sees.  The session is taken from the
environment (``spark-submit`` settings); nothing here sets cluster resources.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import time

from pyspark.sql import SparkSession

from shelfwise.operators import extract, marts
from shelfwise.plans import pipeline, publish, storage, telemetry
from shelfwise.sources.adapter import SOURCE_NAMES
from shelfwise.sources.tables import load_sources, read_parquet_sources

BASE_NAMES = list(extract.BASE_TABLES) + ["branch_locations"]


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("shelfwise").getOrCreate()
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="shelfwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("land")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--out", required=True)
    for name in ("rebuild", "incremental"):
        p = sub.add_parser(name)
        p.add_argument("--sources", required=True)
        p.add_argument("--root", required=True)
        p.add_argument("--as-of", default=_dt.date.today().isoformat())
        p.add_argument("--workers", type=int, default=4)
        p.add_argument("--telemetry")
        p.add_argument("--run-id", type=int, default=int(time.time()))
        if name == "rebuild":
            p.add_argument("--sample", type=int, help="keep only the first rows of each table")
    p = sub.add_parser("marts")
    p.add_argument("--root", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", default=_dt.date.today().isoformat())
    p.add_argument("--names", default="")
    p = sub.add_parser("report")
    p.add_argument("--telemetry", required=True)
    a = ap.parse_args(argv)
    spark = _session()

    if a.cmd == "land":
        out = pipeline.land_sources(spark, load_sources(spark, a.sf_dir), a.out)
        return {"stats": out["stats"]}
    if a.cmd in ("rebuild", "incremental"):
        src = read_parquet_sources(spark, a.sources, SOURCE_NAMES)
        as_of = _dt.date.fromisoformat(a.as_of)
        tm = telemetry.Telemetry(spark, a.telemetry) if a.telemetry else None
        if a.cmd == "rebuild":
            return pipeline.rebuild(spark, src, a.root, as_of, telemetry=tm, run_id=a.run_id,
                                    workers=a.workers, sample=a.sample)
        return pipeline.incremental(spark, src, a.root, as_of, workers=a.workers, telemetry=tm, run_id=a.run_id)
    if a.cmd == "marts":
        base = publish.read_snapshot(spark, a.root, BASE_NAMES)
        as_of = _dt.date.fromisoformat(a.as_of)
        wanted = {n for n in a.names.split(",") if n}
        written = {}
        for mid, (name, fn) in marts.MARTS.items():
            if wanted and mid not in wanted and name not in wanted:
                continue
            written[name] = publish.write_table(fn(base, as_of), storage.join(a.out, name))
        return {"marts": written}
    run, stage = telemetry.Telemetry(spark, a.telemetry).tables()
    totals, per_run = telemetry.run_report(run, stage)
    for title, df in (("runs", totals), ("recent runs", telemetry.recent_runs(run)),
                      ("stage summary", telemetry.stage_summary(run, stage)),
                      ("failures", telemetry.failure_analysis(run, stage))):
        print(f"== {title}")
        df.show(50, truncate=False)
    return {"runs": totals.first().asDict()}
