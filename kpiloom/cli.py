"""Command line: build the warehouse, run the data tests, show a model.

    python -m kpiloom run   --tpch /root/testdata/sf0.01 --out /path/wh
    python -m kpiloom test  --raw /data/raw --raw-format csv [--out /path/wh]
    python -m kpiloom build --raw /data/raw --out /path/wh      # run, then test the written tables
    python -m kpiloom show  rpt_medical_group_performance_monthly --tpch /root/testdata/sf0.001
    python -m kpiloom failing TEST_NAME --tpch /root/testdata/sf0.001    # first failing rows of one test

``test`` and ``build`` exit with status 1 when a test of severity *error*
fails; failing *warn* tests are reported but do not fail the run.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from kpiloom.params import REPORT_YEAR, KpiParams
from kpiloom.plans.models import MODEL_NAMES, KpiWarehouse
from kpiloom.plans.quality_suite import DECLARED_TESTS, TEST_TYPES
from kpiloom.session import cluster_conf, get_session
from kpiloom.sources.raw import BAD_ROWS, read_raw_dir, rejected_counts
from kpiloom.sources.sink import read_table, replace_table
from kpiloom.sources.tpch_fixture import derive_raw

REJECTED = "rejected_rows"


def _warehouse(spark, args) -> KpiWarehouse:
    params = KpiParams(report_year=args.report_year, rate_scale=args.rate_scale)
    if args.tpch:
        return KpiWarehouse(derive_raw(spark, args.tpch), params, buckets=args.buckets)
    return KpiWarehouse(read_raw_dir(spark, args.raw, args.raw_format, args.bad_rows), params, buckets=args.buckets)


def _report_rejected(wh: KpiWarehouse, out: str, fmt: str) -> None:
    """Write the malformed rows beside the models and print their number by table and file."""
    rejected = getattr(wh.raw, "rejected", None)
    if rejected is None:
        return
    path = os.path.join(out, REJECTED)
    replace_table(rejected, path, fmt)
    counts = rejected_counts(read_table(rejected.sparkSession, path, fmt))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    print(f"REJECTED {total} rows -> {path}")
    for r in counts.orderBy(F.desc("rows"), "table", "file").limit(50).collect():      # a report of the worst files
        print(f"REJECTED {r['rows']:>8d}  {r['table']}  {r['file']}")


def _report_tests(wh: KpiWarehouse, kinds, models=None) -> int:
    # One action evaluates every test; the result has one row per declared test (bounded).
    tests = [t for t in DECLARED_TESTS if not models or t.model in models]
    if not tests:
        print("Done. no tests selected")
        return 0
    rows = wh.data_tests(kinds, tests).orderBy("model", "test_name").collect()
    failed = 0
    for r in rows:
        if r["status"] != "pass":
            print(f"{r['status'].upper():5s} {r['failures']:>8d}  {r['test_name']}  (severity {r['severity']})")
        failed += r["status"] == "fail"
    counts = {s: sum(r["status"] == s for r in rows) for s in ("pass", "warn", "fail")}
    print(f"Done. PASS={counts['pass']} WARN={counts['warn']} ERROR={counts['fail']} TOTAL={len(rows)}")
    return 1 if failed else 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="kpiloom")
    ap.add_argument("command", choices=["run", "test", "build", "show", "failing"])
    ap.add_argument("model", nargs="?", help="model to show, or test whose failing rows to show")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tpch", help="derive the raw tables from TPC-H parquet in this folder")
    src.add_argument("--raw", help="folder with the four raw tables")
    ap.add_argument("--raw-format", default="csv")
    ap.add_argument("--bad-rows", default="fail", choices=BAD_ROWS, help="malformed CSV or JSON rows: fail, or write them apart")
    ap.add_argument("--out", help="warehouse folder for the written models")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--buckets", type=int, default=None, help="buckets of the stored daily tables (Parquet), so monthly summaries need no shuffle")
    ap.add_argument("--master", default=None, help="Spark master (default: spark-submit's, else local)")
    ap.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="extra Spark setting")
    ap.add_argument("--cluster", metavar="EXECUTORS,CORES", help="size the shuffle for so many executors and cores of each")
    ap.add_argument("--select", nargs="*", help="models to write / test (default: all)")
    ap.add_argument("--tests", nargs="*", default=list(TEST_TYPES), choices=list(TEST_TYPES))
    ap.add_argument("--report-year", type=int, default=REPORT_YEAR, help="year of the annual reports")
    ap.add_argument("--rate-scale", type=int, default=None, help="round rates to this many decimals")
    args = ap.parse_args(argv)

    extra = cluster_conf(*map(int, args.cluster.split(","))) if args.cluster else {}
    extra.update(kv.split("=", 1) for kv in args.conf)
    spark = get_session(args.master, extra=extra)
    wh = _warehouse(spark, args)
    status = 0
    if args.command in ("run", "build"):
        if not args.out:
            ap.error("--out is required for run/build")
        for name, path in wh.materialize(args.out, args.format, args.select).items():
            print(f"OK {name} -> {path}")
        _report_rejected(wh, args.out, args.format)
    if args.command in ("test", "failing") and args.out:
        wh.attach(args.out, args.format)
    if args.command in ("test", "build"):
        status = _report_tests(wh, tuple(args.tests), args.select)
    if args.command == "failing":
        if args.model not in {t.name for t in DECLARED_TESTS}:
            ap.error(f"unknown test {args.model!r}")
        wh.failing_rows(args.model).show(50, truncate=False)
    if args.command == "show":
        if args.model not in MODEL_NAMES:
            ap.error(f"unknown model {args.model!r}; one of {', '.join(MODEL_NAMES)}")
        wh.presented(args.model).show(50, truncate=False)
    return status


if __name__ == "__main__":
    sys.exit(main())
