"""Command line: the batch, an incremental refresh, the breakout report, SQL.

    python -m tidemark run     --raw data/raw --out warehouse [--on-fail raise]
    python -m tidemark refresh --raw data/raw --out warehouse --dates 2024-01-02 [...]
    python -m tidemark report  --out warehouse [--n 10]
    python -m tidemark sql     --out warehouse "SELECT ... FROM breakout_repos"
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="full refresh: load, stage, marts, checks, breakouts")
    r.add_argument("--raw", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--on-fail", default="warn", choices=["warn", "raise"])
    f = sub.add_parser("refresh", help="rebuild only some snapshot dates")
    f.add_argument("--raw", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--dates", nargs="+", required=True)
    f.add_argument("--on-fail", default="warn", choices=["warn", "raise"])
    p = sub.add_parser("report", help="top breakouts by multiplier")
    p.add_argument("--out", required=True)
    p.add_argument("--n", type=int, default=10)
    q = sub.add_parser("sql", help="read-only SQL over the warehouse tables")
    q.add_argument("--out", required=True)
    q.add_argument("query")
    q.add_argument("--limit", type=int, default=None, help="print only so many rows (the count is always given)")
    args = ap.parse_args(argv)

    from tidemark import get_spark
    from tidemark.plans import pipeline

    spark = get_spark()
    if args.cmd in ("run", "refresh"):
        if args.cmd == "run":
            out = pipeline.run(spark, args.raw, args.out, on_fail=args.on_fail)
        else:
            out = pipeline.refresh(spark, args.raw, args.out, args.dates, on_fail=args.on_fail)
        if not out:
            print("No raw data found; existing tables kept.")
            return 0
        if "row_count" in out:
            print(f"rows loaded: {out['row_count'].first()[0]}")
        out["quality"].show(truncate=False)
        print(f"breakouts: {out['breakout_repos'].count()}")
        return 0
    tables = pipeline.open_warehouse(spark, args.out)
    if args.cmd == "report":
        if "breakout_repos" not in tables:
            print("No breakout table yet: run the pipeline first.")
            return 1
        from tidemark.operators.metrics import breakout_report

        breakout_report(tables["breakout_repos"], args.n).show(args.n, truncate=False)
        return 0
    from tidemark.operators.explorer import ReadOnlyViolation, explore_paged

    try:
        pages = explore_paged(spark, args.query)
    except ReadOnlyViolation as e:
        print(f"Query rejected: {e}")
        return 2
    rows, shown = pages.rows, pages.rows if args.limit is None else min(pages.rows, args.limit)
    (pages.page(0, shown) if shown else pages.result).show(shown, truncate=False)
    pages.drop()
    print(f"{rows} rows" + (f", {rows - shown} not shown" if shown < rows else ""))
    return 0


if __name__ == "__main__":
    sys.exit(main())
