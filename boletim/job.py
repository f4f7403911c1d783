"""Entry point of the batch job, for ``spark-submit``."""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from boletim.plans.etl import run_pipeline
from boletim.sinks.load import CatalogTarget, JdbcTarget, Target
from boletim.sinks.tables import create_warehouse

log = logging.getLogger(__name__)


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="boletim", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the raw CSV datasets")
    parser.add_argument("--processed", required=True, help="folder of the cleaned Parquet datasets")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="ingestion time, UTC")
    parser.add_argument("--run-id", help="name of the run; a load tried again under it adds nothing")
    parser.add_argument("--on-error", choices=("log", "raise"), default="log")
    target = parser.add_mutually_exclusive_group()
    target.add_argument("--catalog-db", help="load tables of this catalog database")
    target.add_argument("--jdbc-url", help="load tables of this database")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-partitions", type=int, help="connections held at once")
    parser.add_argument("--jdbc-password-env", help="environment variable with the password")
    return parser.parse_args(argv)


def target_of(spark: SparkSession, args: argparse.Namespace) -> Target | None:
    if args.catalog_db:
        create_warehouse(spark, args.catalog_db)
        return CatalogTarget(spark, args.catalog_db)
    if args.jdbc_url:
        login = {"user": args.jdbc_user} if args.jdbc_user else {}
        if args.jdbc_password_env:
            login["password"] = os.environ[args.jdbc_password_env]
        if args.jdbc_partitions:
            login["numPartitions"] = str(args.jdbc_partitions)
        return JdbcTarget(args.jdbc_url, login, args.run_id)
    return None


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parse(argv)
    spark = (
        SparkSession.builder.appName("boletim").config("spark.sql.session.timeZone", "UTC")
    ).getOrCreate()
    run_ts = args.run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    target = target_of(spark, args)
    summary = run_pipeline(spark, args.raw, args.processed, run_ts, target, args.on_error)
    for row in summary.counts.orderBy("dataset").collect():
        log.info("%s: %d rows read, %d written", row["dataset"], row["lidas"], row["gravadas"])
    for load in summary.loads:
        log.info("load of %s: %s %s", load.table, load.status, load.message)


if __name__ == "__main__":
    main()
