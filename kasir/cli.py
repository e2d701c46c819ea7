"""Command line for the three batch actions (run with spark-submit or python -m kasir.cli).

  sales    rebuild the 10 sales tables           (Q01-Q10)
  menu     rebuild the 3 menu tables              (Q11-Q13)
  ingest   load report files of one kind          (append or overwrite)

Input tables default to their catalog names; ``--table key=name`` points one
at another catalog table or a parquet path (keys as in
``kasir.sources.tables.TABLES``).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):          # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from kasir.config import DEFAULT  # noqa: E402
from kasir.session import ensure_job_conf, release_staged  # noqa: E402


def _tables(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        if not v:
            raise SystemExit(f"--table expects key=name, got {p!r}")
        out[k] = v
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="kasir")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("sales", "menu"):
        p = sub.add_parser(name)
        p.add_argument("--table", action="append", default=[], help="key=catalog.table or path")
        p.add_argument("--as-of", default=None, help="tracker as-of day (default: today, UTC)")
        p.add_argument("--store-partitions", type=int, default=None)
    p = sub.add_parser("ingest")
    p.add_argument("kind", choices=["sales", "menu", "service_time"])
    p.add_argument("paths", nargs="+")
    p.add_argument("--mode", choices=["append", "overwrite"], default="append")
    p.add_argument("--target", default=None, help="table to load (default: the kind's table)")
    p.add_argument("--date-format", action="append", default=[], help="date layout tried after ISO, e.g. d/M/yyyy")
    p.add_argument("--date-layout", choices=["cell", "column"], default="cell", help="parse dates cell by cell, or by "
                   "the layout that a column's first value shows in each file")
    p.add_argument("--check", action="store_true", help="list every bad cell before anything is written")
    p.add_argument("--once", action="store_true", help="leave out files whose content was loaded before")
    a = ap.parse_args(argv)

    own = spark is None
    spark = spark or SparkSession.builder.appName(f"kasir-{a.cmd}").getOrCreate()
    ensure_job_conf(spark)
    if a.cmd == "ingest":
        from kasir.plans.ingest import BadCells, ingest
        from kasir.functions.casts import DATE_FORMATS
        try:
            result = ingest(spark, a.paths, a.kind, a.mode, a.target, tuple(a.date_format) or DATE_FORMATS,
                            a.date_layout, a.check, a.once)
        except BadCells as e:
            result = {"rows": 0, "bad_cells": e.count, "first": [r.asDict() for r in e.cells.limit(100).collect()]}
    else:
        from kasir.plans import pipeline
        from kasir.sources.tables import load_menu, load_sales
        cfg = DEFAULT.with_(as_of=a.as_of, store_partitions=a.store_partitions)
        if a.cmd == "sales":
            result = pipeline.run_sales(spark, load_sales(spark, _tables(a.table)), cfg)
        else:
            result = pipeline.run_menu(spark, load_menu(spark, _tables(a.table)), cfg)
    if own:
        release_staged(spark)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
