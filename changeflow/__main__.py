"""Batch jobs from the command line: ``spark-submit`` this package's ``__main__.py`` or ``python -m changeflow``.

    build --run 20260812T100000     all models; the mart only if its contract and checks hold
    check --run 20260812T100500     value checks on the published mart
    test                            column tests on the published models
    status                          the latest gauges of every job

The exit code is 1 if a build is blocked or a check or test fails.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from changeflow.operators.contracts import ContractViolation
from changeflow.plans import jobs
from changeflow.plans.tables import PublishBlocked


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="changeflow")
    parser.add_argument("command", choices=["build", "check", "test", "status"])
    parser.add_argument("--run", help="names this attempt; must sort after earlier ones")
    args = parser.parse_args(argv)
    if args.command in ("build", "check") and not args.run:
        parser.error("--run is required")
    spark = spark or SparkSession.builder.appName(f"changeflow {args.command}").getOrCreate()

    if args.command == "build":
        try:
            print(jobs.build(spark, args.run))
        except (PublishBlocked, ContractViolation) as blocked:
            print(f"blocked: {blocked}", file=sys.stderr)
            return 1
        return 0
    if args.command == "check":
        return 0 if jobs.check_mart(spark, args.run) else 1
    if args.command == "status":
        for row in jobs.job_status(spark).orderBy("job", "metric").collect():
            print(f"{row.job} {row.metric} {row.value:g}")
        return 0
    failed = jobs.run_column_tests(spark).where("failures > 0").collect()
    for row in failed:
        print(row, file=sys.stderr)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
