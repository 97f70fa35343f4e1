"""Command line for the daily workflow (submit with spark-submit or run locally).

  python -m tempora ingest   --raw ROOT --table purchase_cdc --input PATH [--quarantine PATH]
  python -m tempora snapshot --raw ROOT --gold PATH --as-of YYYY-MM-DD [--mode auto|full|incremental]
  python -m tempora backfill --raw ROOT --gold PATH --from YYYY-MM-DD --to YYYY-MM-DD
  python -m tempora report   --gold PATH [--as-of YYYY-MM-DD] [--whole] [--output FOLDER]
  python -m tempora margin   --raw ROOT --as-of YYYY-MM-DD [--output FOLDER]

Without ``--quarantine`` a delivery with a bad or conflicting row is refused.
``--output`` writes the whole report as parquet; ``--show`` only limits what
is printed.
"""

from __future__ import annotations

import argparse
import sys

from tempora import schemas as S
from tempora.plans import jobs
from tempora.session import get_session


def _deliver(report, args) -> None:
    if args.output:
        report.write.parquet(args.output)
    report.show(args.show, truncate=False)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tempora")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--raw", required=True)
    a.add_argument("--table", required=True, choices=[S.PURCHASE, S.EXTRA, S.ITEM, S.COST])
    a.add_argument("--input", required=True, help="parquet folder of one delivery")
    a.add_argument("--quarantine")
    b = sub.add_parser("snapshot")
    b.add_argument("--raw", required=True)
    b.add_argument("--gold", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--mode", default="auto", choices=["auto", "full", "incremental"])
    e = sub.add_parser("backfill")
    e.add_argument("--raw", required=True)
    e.add_argument("--gold", required=True)
    e.add_argument("--from", dest="first", required=True)
    e.add_argument("--to", dest="last", required=True)
    c = sub.add_parser("report")
    c.add_argument("--gold", required=True)
    c.add_argument("--as-of")
    c.add_argument("--whole", action="store_true", help="all seven columns")
    c.add_argument("--output")
    c.add_argument("--show", type=int, default=50)
    d = sub.add_parser("margin")
    d.add_argument("--raw", required=True)
    d.add_argument("--as-of", required=True)
    d.add_argument("--output")
    d.add_argument("--show", type=int, default=50)
    args = ap.parse_args(argv)

    spark = get_session()
    if args.cmd == "ingest":
        batch = spark.read.schema(S.raw_schema(args.table)).parquet(args.input)
        print(jobs.ingest(spark, batch, args.raw, args.table, args.quarantine))
    elif args.cmd == "snapshot":
        written = jobs.daily_snapshot(spark, args.raw, args.gold, args.as_of, args.mode)
        print("written" if written else "already stored")
    elif args.cmd == "backfill":
        print("written:", [d.isoformat() for d in jobs.backfill(spark, args.raw, args.gold, args.first, args.last)])
    elif args.cmd == "report":
        report = jobs.as_of_report(spark, args.gold, args.as_of, args.whole) if args.as_of else \
            jobs.current_report(spark, args.gold, args.whole)
        _deliver(report, args)
    elif args.cmd == "margin":
        _deliver(jobs.margin_report(spark, args.raw, args.as_of), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
