"""Run a registered query by name.

    python -m platehub list
    python -m platehub run <name> [--param NAME=VALUE ...] [--sf DIR] [--out PATH] [--format parquet|json] [--show N]

``list`` shows the parameters that a query declares, with types and defaults.
``--out`` writes the whole result with Spark (nothing is collected);
``--show`` prints at most N rows.  An unknown name is an error.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    from .plans.lookups import NamedSql, run_named
    from .plans.registry import ORACLE, QUERIES

    ap = argparse.ArgumentParser(prog="python -m platehub")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("name")
    run.add_argument("--param", action="append", default=[], metavar="NAME=VALUE", help="value of a declared parameter")
    run.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the input parquet tables")
    run.add_argument("--out", help="write the result here")
    run.add_argument("--format", default="parquet", choices=["parquet", "json"])
    run.add_argument("--show", type=int, default=0, help="print at most N rows")
    run.add_argument("--master", help="Spark master, e.g. local[8] (default: from the environment)")
    run.add_argument("--shuffle-partitions", type=int, help="initial shuffle width (cluster default 4096)")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name in sorted(QUERIES):
            fn = QUERIES[name]
            declared = [f"{k}: {t} = {fn.defaults[k]!r}" for k, t in fn.types.items()] if isinstance(fn, NamedSql) else []
            print(name + ("" if name in ORACLE else "  (no SQL twin)") + (f"  ({', '.join(declared)})" if declared else ""))
        return 0
    if args.name not in QUERIES:
        print(f"unknown query {args.name!r}; try: python -m platehub list", file=sys.stderr)
        return 2

    params = dict(p.partition("=")[::2] for p in args.param)
    try:
        if isinstance(QUERIES[args.name], NamedSql):
            QUERIES[args.name].values(params)
        elif params:
            raise ValueError(f"{args.name} takes no parameters")
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2

    from .session import build_session

    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    df = run_named(QUERIES, args.name, spark, args.sf, params)
    if args.out:
        df.write.mode("overwrite").format(args.format).save(args.out)
    if args.show:
        df.show(args.show, truncate=False)
    if not args.out and not args.show:
        df.write.format("noop").mode("overwrite").save()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
