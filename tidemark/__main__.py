"""Run registered queries from the command line.

    python -m tidemark list
    python -m tidemark run user_profile --tables /data/sf1 --out /data/out/user_profile
    python -m tidemark run user_click_show_tumbling --tables /data/sf1 --show 20

Tables are read as ``{tables}/{name}.parquet``. Results are written as
parquet (``--out``) or printed (``--show``); nothing is collected otherwise.
The streaming application itself is ``tidemark/app.py``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.plans.catalog import QUERIES
from tidemark.plans.streaming import STREAM_QUERIES


def all_queries() -> dict:
    out = dict(QUERIES)
    out.update({name: fn for name, (fn, _) in STREAM_QUERIES.items()})
    return out


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="python -m tidemark", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="names of the registered queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("name", choices=sorted(all_queries()))
    run.add_argument("--tables", required=True, help="folder with {table}.parquet files")
    run.add_argument("--out", help="write the result here as parquet")
    run.add_argument("--show", type=int, default=0, help="print this many rows")
    a = p.parse_args(argv)
    if a.cmd == "list":
        for name in sorted(all_queries()):
            print(name)
        return
    spark = SparkSession.builder.appName(f"tidemark-{a.name}").getOrCreate()
    df = all_queries()[a.name](spark, a.tables)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    if a.show:
        df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
