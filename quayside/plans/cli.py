"""Command line for the loads (run with ``spark-submit -m`` or ``python -m``).

    python -m quayside.plans.cli journal --mapping mapping.json --table load_data_reference \
        --landing s3://landing/reference --root s3://tables --as-of "2024-06-01 00:00:00"
    python -m quayside.plans.cli tick    --mapping mapping.json --table load_data_reference ... --archive s3://done
    python -m quayside.plans.cli claims  --mapping mapping.json --table load_data_talons ...
    python -m quayside.plans.cli routed  --mapping mapping.json --registered load_data_talons ...
    python -m quayside.plans.cli health  --tables t1 t2

The session comes from ``SparkSession.builder.getOrCreate()``: cluster
settings are the submitter's.  ``--now`` defaults to ``--as-of``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from ..sinks.snapshot import VersionedTable
from ..sources.catalog import table_health
from ..spec import load_specs
from .flows import run_claims_files, run_journal, run_routed_claims


def _table(spark, root, name, keys=(), buckets=None):
    return VersionedTable(spark, name, root=f"{root.rstrip('/')}/{name}" if root else None, keys=keys,
                          buckets=buckets)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quayside")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("journal", "tick", "claims", "routed"):
        p = sub.add_parser(name)
        p.add_argument("--mapping", required=True)
        p.add_argument("--landing", required=True)
        p.add_argument("--root", default=None, help="folder of the versioned tables")
        p.add_argument("--as-of", required=True)
        p.add_argument("--now", default=None)
        p.add_argument("--buckets", type=int, default=None)
        p.add_argument("--min-age", type=float, default=60)
        p.add_argument("--required", nargs="*", default=None)
        if name == "routed":
            p.add_argument("--registered", nargs="+", required=True)
        else:
            p.add_argument("--table", required=True)
        if name == "journal":
            p.add_argument("--latest-only", action="store_true")
        if name in ("journal", "claims"):
            p.add_argument("--quarantine", action="store_true",
                           help="set bad rows aside in <table>_quarantine instead of failing")
        if name == "tick":
            p.add_argument("--archive", default=None, help="move files loaded on an earlier tick here")
    h = sub.add_parser("health")
    h.add_argument("--tables", nargs="+", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "health":
        table_health(spark, args.tables).show(truncate=False)
        return 0
    specs = load_specs(args.mapping)
    now = args.now or args.as_of
    if args.cmd == "journal":
        spec = specs[args.table]
        target = _table(spark, args.root, spec.table_name, spec.keys, args.buckets)
        bad = _table(spark, args.root, f"{spec.table_name}_quarantine") if args.quarantine else None
        res = run_journal(spark, spec, args.landing, target, args.as_of, now, args.required, args.min_age,
                          latest_only=args.latest_only, on_bad="quarantine" if bad else "error", quarantine=bad)
    elif args.cmd == "tick":
        from ..streaming.ingest import run_once

        spec = specs[args.table]
        target = _table(spark, args.root, spec.table_name, spec.keys, args.buckets)
        ledger = _table(spark, args.root, f"{spec.table_name}_ledger")
        res = run_once(spark, spec, args.landing, target, ledger, args.as_of, now, args.required, args.min_age,
                       archive_dir=args.archive)
    elif args.cmd == "claims":
        spec = specs[args.table]
        normal = _table(spark, args.root, f"{spec.table_name}_normal", spec.keys, args.buckets)
        repeated = _table(spark, args.root, f"{spec.table_name}_complex")
        bad = _table(spark, args.root, f"{spec.table_name}_quarantine") if args.quarantine else None
        res = run_claims_files(spark, spec, args.landing, normal, repeated, args.as_of, now, args.required or (),
                               args.min_age, on_bad="quarantine" if bad else "error", quarantine=bad)
    else:
        first = specs[args.registered[0]]
        normal = _table(spark, args.root, f"{first.table_name}_normal", first.keys, args.buckets)
        repeated = _table(spark, args.root, f"{first.table_name}_complex")
        from ..functions.tokens import LEGACY_CLAIMS_REQUIRED

        required = LEGACY_CLAIMS_REQUIRED if args.required is None else args.required
        _, report = run_routed_claims(spark, list(specs.values()), args.registered, args.landing, normal, repeated,
                                      required)
        report.show(truncate=False)
        return 0
    res.report.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
