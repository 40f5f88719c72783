"""Command line: the whole run, or the change report of one period.

    spark-submit run_reports.py run --tables /data/staff --out /data/out
    spark-submit --packages <driver> run_reports.py run --out /data/out \\
        --url jdbc:mysql://host/employees --user u --password-file p --partitions 64
    spark-submit run_reports.py changes --tables /data/out/tables --out /data/out/reports \\
        --month-before 2000-05-01
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import changes_job, reports_job
from tidemark.session import configure
from tidemark.sources import read_jdbc_tables, read_tables, write_tables


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("run", "changes"):
        job = jobs.add_parser(name)
        job.add_argument("--out", required=True, help="folder for the results, any Hadoop URI")
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--tables", help="folder with one <table>.parquet each")
        source.add_argument("--url", help="JDBC URL of the database")
        job.add_argument("--user")
        job.add_argument("--password-file", type=Path)
        job.add_argument("--driver", default="com.mysql.cj.jdbc.Driver")
        job.add_argument("--partitions", type=int, default=64, help="parallel reads per table")
        job.add_argument("--start", help="first day of the change report")
        job.add_argument("--end", help="last day of the change report")
    jobs.choices["changes"].add_argument(
        "--month-before", help="report the calendar month before this day"
    )
    return parser.parse_args(arguments)


def load(spark: SparkSession, options: argparse.Namespace) -> dict[str, DataFrame]:
    if options.tables:
        return read_tables(spark, options.tables.rstrip("/"))
    login = {"user": options.user, "driver": options.driver}
    if options.password_file:
        login["password"] = options.password_file.read_text().strip()
    given = {k: v for k, v in login.items() if v}
    tables = read_jdbc_tables(spark, options.url, given, partitions=options.partitions)
    # Copied as it is, so that all further steps see one state of the database.
    return read_tables(spark, write_tables(tables, f"{options.out.rstrip('/')}/raw", specs={}))


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = SparkSession.builder.appName("staff-reports").getOrCreate()
    tables = load(configure(spark), options)
    configure(spark, *tables.values())
    out = options.out.rstrip("/")
    period = {k: v for k in ("start", "end") if (v := getattr(options, k))}
    if options.job == "run":
        paths = reports_job(spark, tables, out, **period)
    else:
        uri = changes_job(spark, tables, out, **period, month_before=options.month_before)
        paths = {"employee_changes": uri}
    for name, path in paths.items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
    SparkSession.active().stop()
