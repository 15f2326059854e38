"""Command line: ``python -m loomlog <import|query|casevotes> …``.

    python -m loomlog import  --input 'logs/*.json' --table out/logs [--lenient [--quarantine bad/]]
    python -m loomlog import  --input 'logs/*.json' --store out/store --batch 2015-01-01 [--lenient]
    python -m loomlog query   --table out/logs_hourly_by_ts_id --date 20150101Z [--date …]
    python -m loomlog query   --store out/store --date 20150101Z
    python -m loomlog casevotes --input data/case-votes/ [--top 20]

A batch imported into a store may be imported again: it replaces what it brought.
Results are printed whole, row by row as they arrive (one partition at a
time in the driver); only ``top_attributes`` is a top list.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from loomlog.plans import reports
from loomlog.session import build_session
from loomlog.sinks.snapshots import SnapshotStore


def _print(df) -> None:
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="loomlog")
    sub = ap.add_subparsers(dest="cmd", required=True)
    imp = sub.add_parser("import")
    imp.add_argument("--input", required=True)
    into = imp.add_mutually_exclusive_group(required=True)
    into.add_argument("--table", help="folder of the default table; the hourly one lies beside it")
    into.add_argument("--store", help="snapshot store: both tables, rejected lines and statistics in one commit")
    imp.add_argument("--batch", help="name of this batch, with --store")
    imp.add_argument("--lenient", action="store_true")
    imp.add_argument("--quarantine", help="folder for lines that cannot be imported (default: they fail the import)")
    q = sub.add_parser("query")
    of = q.add_mutually_exclusive_group(required=True)
    of.add_argument("--table", help="folder of the hourly table")
    of.add_argument("--store")
    q.add_argument("--date", action="append", required=True)
    cv = sub.add_parser("casevotes")
    cv.add_argument("--input", required=True)
    cv.add_argument("--top", type=int, default=20)
    args = ap.parse_args(argv)
    if args.cmd == "import" and bool(args.store) != bool(args.batch):
        ap.error("--store and --batch go together")

    spark = build_session(app=f"loomlog-{args.cmd}")
    if args.cmd == "import" and args.store:
        store = SnapshotStore(spark, args.store)
        version = reports.import_batch(store, args.batch, args.input, args.lenient)
        r = store.read(reports.STATS_TABLE, version).where(F.col("batch") == args.batch).first()
        print(f"version {version}: batch {args.batch}, {r['records']} records, {r['imported']} imported, {r['rejected']} rejected")
    elif args.cmd == "import":
        default, hourly = reports.import_logs(spark, args.input, args.table, args.lenient,
                                              args.quarantine)
        print(f"default table rows: {default.count()}, hourly table rows: {hourly.count()}")
    elif args.cmd == "query":
        hourly = SnapshotStore(spark, args.store).read(reports.HOURLY_TABLE) if args.store else spark.read.parquet(args.table)
        for name, df in reports.event_report(spark, hourly, args.date).items():
            print(f"-- {name}")
            _print(df.orderBy(*df.columns[:3]))
    else:
        for name, df in reports.case_vote_report(spark, args.input, args.top).items():
            print(f"-- {name}")
            _print(df)
    spark.stop()


if __name__ == "__main__":
    main()
