"""Command line: read a table, apply a rule file, write the outputs.

    python -m rowsieve --input data.csv --format csv --infer-schema \\
        --rules rules.json --ref products=products.csv \\
        --rejected /shared/dq --report quality_report.html --keys order_id

Prints the quality stats as JSON.  Runs on whatever master the session is
given (``spark-submit`` or ``--master``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from rowsieve.runner import RuleRunner
from rowsieve.session import configure
from rowsieve.sources.readers import read_csv


def _read(spark: SparkSession, path: str, fmt: str, infer: bool, schema: str | None):
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, infer_schema=infer)
    if fmt == "table":
        return spark.table(path)
    reader = spark.read.format(fmt)
    if schema:
        from rowsieve.sources.readers import as_schema

        reader = reader.schema(as_schema(schema))
    return reader.load(path)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rowsieve", description=__doc__.split("\n")[0])
    p.add_argument("--input", required=True, help="path, or table name with --format table")
    p.add_argument("--format", default="parquet", help="parquet | csv | json | orc | table")
    p.add_argument("--schema", help="explicit schema: JSON file / text or DDL")
    p.add_argument("--infer-schema", action="store_true", help="CSV: infer column types")
    p.add_argument("--rules", required=True, help="JSON rule file")
    p.add_argument("--ref", action="append", default=[], help="name=path[:format] reference table")
    p.add_argument("--rejected", help="base folder for rejected rows")
    p.add_argument("--split", help="folder for good and rejected rows (dq_status=...)")
    p.add_argument("--report", help="HTML report path")
    p.add_argument("--keys", default="", help="comma-separated key columns for summaries")
    p.add_argument("--master", help="Spark master, e.g. local[8]")
    args = p.parse_args(argv)

    builder = SparkSession.builder.appName("rowsieve")
    if args.master:
        builder = builder.master(args.master)
    spark = configure(builder.getOrCreate())

    refs = {}
    for item in args.ref:
        name, _, rest = item.partition("=")
        path, _, fmt = rest.partition(":")
        fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
        refs[name] = _read(spark, path, fmt, False, None)

    df = _read(spark, args.input, args.format, args.infer_schema, args.schema)
    keys = [k for k in args.keys.split(",") if k]
    runner = RuleRunner(df, refs=refs, keys=keys)
    runner.apply_rules(args.rules)
    if args.split:
        runner.result.write_split(args.split)
    if args.rejected:
        print("rejected rows:", runner.save_rejected(args.rejected), file=sys.stderr)
    if args.report:
        runner.generate_report(args.report, keys=keys or None)
    print(json.dumps(runner.get_quality_stats()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
