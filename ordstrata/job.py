"""Run the whole job, for ``spark-submit`` or ``python -m ordstrata.job``.

    spark-submit ordstrata/job.py --root hdfs:///lake --customers hdfs:///in/customers \\
        --orders hdfs:///in/orders
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from ordstrata.plans.medallion import run_medallion
from ordstrata.session import build_session
from ordstrata.sinks.tables import Lake
from ordstrata.streaming.ingest import run_ingest


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--customers", required=True, help="customer file or folder of files")
    parser.add_argument("--orders", required=True, help="order file or folder of files")
    parser.add_argument("--namespace", default="ordstrata", help="prefix of the databases")
    parser.add_argument(
        "--load-ts",
        type=lambda text: dt.datetime.fromisoformat(text).astimezone(dt.timezone.utc),
        help="time of the load; give the same one again to repeat a failed run",
    )
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="date that ages refer to")
    parser.add_argument("--shuffle-partitions", type=int)
    parser.add_argument(
        "--skip-unchanged", action="store_true", help="add no load for the newest load's rows again"
    )
    parser.add_argument(
        "--by-run", action="store_true", help="keep the small results of every run"
    )
    parser.add_argument(
        "--once",
        action="store_true",
        help="load only files that no run has loaded before; ragged rows go to tables of their own",
    )
    parser.add_argument(
        "--by-name",
        action="store_true",
        help="like --once, with columns found by the files' headers and new ones added",
    )
    parser.add_argument(
        "--arrivals",
        action="store_true",
        help="the paths are folders; load every file that has arrived there, each as a load",
    )
    parser.add_argument(
        "--gated", action="store_true", help="keep the old version of a table whose new rows break rules"
    )
    parser.add_argument(
        "--lenient", action="store_true", help="set rows apart that hold no value of a column's type"
    )
    parser.add_argument(
        "--customer-buckets", type=int, help="lay silver tables out in so many buckets of customers"
    )
    given = parser.parse_args(arguments)

    spark = build_session("ordstrata", shuffle_partitions=given.shuffle_partitions)
    lake = Lake(spark, given.root, given.namespace)
    silver = {name: getattr(given, name) for name in ("gated", "lenient", "customer_buckets")}
    if given.arrivals:
        options = {"by_name": given.by_name, "skip_unchanged": given.skip_unchanged, **silver}
        log = run_ingest(lake, given.customers, given.orders, given.as_of, **options)
    else:
        log = run_medallion(
            lake,
            given.customers,
            given.orders,
            given.load_ts,
            given.as_of,
            skip_unchanged=given.skip_unchanged,
            by_run=given.by_run,
            once=given.once,
            by_name=given.by_name,
            **silver,
        )
    run = log.filter(F.col("DATA_RODADA") == log.agg(F.max("DATA_RODADA")).scalar())
    for row in run.collect():  # one per table written
        print(*row, sep=" | ")


if __name__ == "__main__":
    main()
