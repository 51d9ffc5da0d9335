"""Command line: one subcommand per job, for ``spark-submit``.

    spark-submit userlens/cli.py logs --src <logs> --start 2024-01-01 --end 2024-01-02 \\
        --mapping-url jdbc:... --target <root>

The session comes from the cluster (``getOrCreate``); connection settings are
passed as ``--opt key=value`` (e.g. ``user``, ``password``, ``driver``).
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

if __package__ in (None, ""):  # run as a file (spark-submit userlens/cli.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from userlens.plans import jobs  # noqa: E402
from userlens.session import ensure_checkpoint_dir  # noqa: E402


def _opts(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="userlens")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("logs", help="behaviour logs -> log documents (replace)")
    p.add_argument("--src", required=True)
    p.add_argument("--start", required=True)
    p.add_argument("--end", required=True)
    p.add_argument("--mapping-url", required=True)
    p.add_argument("--target", required=True)
    p = sub.add_parser("orders", help="recent orders -> new order documents (newest per uuid)")
    p.add_argument("--src", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--days", type=int, default=2)
    p = sub.add_parser("users-bulk", help="registration text -> user documents (replace)")
    p.add_argument("--path", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--quarantine", required=True, help="folder for the lines that can't be read")
    p.add_argument("--strict-dates", action="store_true")
    p = sub.add_parser("users", help="new database users -> user documents (upsert)")
    p.add_argument("--url", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--target", required=True)
    p = sub.add_parser("tracks", help="footprint logs -> per-user tracks (upsert)")
    p.add_argument("--src", required=True)
    p.add_argument("--start", required=True)
    p.add_argument("--end", required=True)
    p.add_argument("--target", required=True)
    p = sub.add_parser("idcards", help="database id cards -> enriched user fields (upsert)")
    p.add_argument("--url", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--min-uid", type=int, required=True)
    p.add_argument("--bounds", type=int, nargs=2)
    p.add_argument("--partitions", type=int, default=8)
    p.add_argument("--strict-dates", action="store_true")
    p = sub.add_parser("devices", help="recent devices -> device documents (upsert)")
    p.add_argument("--src", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--days", type=int, default=7)
    p = sub.add_parser("compact", help="fold an append-versioned snapshot to one row per key")
    p.add_argument("--target", required=True)
    p.add_argument("--key", default="_id")
    p.add_argument("--partition-by", default=None)
    p = sub.add_parser("show", help="print some rows of a snapshot")
    p.add_argument("--target", required=True)
    p.add_argument("--rows", type=int, default=10)
    for sp in sub.choices.values():
        sp.add_argument("--as-of", default=None, help="'now' for windows and guards (UTC)")
        sp.add_argument("--opt", action="append", help="JDBC option key=value")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"userlens-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    as_of = a.as_of or _now()
    opts = _opts(a.opt)
    if a.job == "logs":
        jobs.run_build_log_documents(spark, a.src, a.start, a.end, {"url": a.mapping_url, **opts}, a.target)
    elif a.job == "orders":
        jobs.run_sync_new_orders(spark, a.src, a.target, as_of, a.days)
    elif a.job == "users-bulk":
        jobs.run_load_users_bulk(spark, a.path, a.target, a.quarantine, a.strict_dates)
    elif a.job == "users":
        jobs.run_load_users_incremental(spark, a.url, a.table, a.target, as_of, options=opts)
    elif a.job == "tracks":
        jobs.run_build_user_tracks(spark, a.src, a.start, a.end, a.target)
    elif a.job == "idcards":
        jobs.run_enrich_user_idcards(spark, a.url, a.table, a.target, as_of, a.min_uid,
                                     tuple(a.bounds) if a.bounds else None, a.partitions, opts,
                                     strict_dates=a.strict_dates)
    elif a.job == "devices":
        jobs.run_sync_recent_devices(spark, a.src, a.target, as_of, a.days)
    elif a.job == "compact":
        from userlens.operators.keyed import compact_snapshot
        compact_snapshot(spark, a.target, a.key, a.partition_by)
    elif a.job == "show":
        from userlens.operators.filters import preview
        from userlens.operators.keyed import read_snapshot
        table = read_snapshot(spark, a.target)
        if table is None:
            raise SystemExit(f"no snapshot at {a.target}")
        preview(table, a.rows).show(truncate=False)


if __name__ == "__main__":
    main()
