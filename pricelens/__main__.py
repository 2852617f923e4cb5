"""Command line: list the registered queries or run one and write its result.

    python -m pricelens list
    python -m pricelens run crisis_scores --sf-dir /data/tables --out /reports/crisis --format csv
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="pricelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list queries with the operators they cover")
    run = sub.add_parser("run", help="run one query and write the result")
    run.add_argument("name")
    run.add_argument("--sf-dir", required=True, help="folder with the input tables")
    run.add_argument("--out", required=True, help="output folder")
    run.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    run.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    from pricelens.plans.registry import load_all
    qs = load_all()
    if a.cmd == "list":
        for n, q in qs.items():
            print(f"{n}\t{q.inventory}\t{'oracle' if q.sql else 'rows-only'}")
        return 0
    if a.name not in qs:
        print(f"unknown query {a.name}", file=sys.stderr)
        return 2
    from pricelens.session import get_spark
    from pricelens.sources.sinks import write_csv, write_parquet
    spark = get_spark(a.master)
    df = qs[a.name].build(spark, a.sf_dir)
    (write_csv if a.format == "csv" else write_parquet)(df, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
