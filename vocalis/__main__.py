"""Batch jobs for spark-submit: ``run`` adds a batch to the store, ``report`` writes the report tables."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from vocalis import lexicons
from vocalis.plans import opinions
from vocalis.session import SETTINGS


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vocalis", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    run = jobs.add_parser("run", help="label the landed pages and add them to the store")
    run.add_argument("--landing", required=True, help="folder with search, details, comments and listings pages")
    run.add_argument("--store", required=True)
    run.add_argument("--batch", required=True, help="name of the batch, for example the date of the run")
    run.add_argument("--valences", help="tab-separated word valences; a small starter list without it")
    run.add_argument("--anchor", type=datetime.datetime.fromisoformat, help="end of the look-back window, default now (UTC)")
    run.add_argument("--mode", choices=["append", "replace"], default="append")
    run.add_argument("--exports", help="also write every stage as CSV and JSON Lines under this folder")
    report = jobs.add_parser("report", help="write the sentiment shares and the topic by sentiment matrix")
    report.add_argument("--store", required=True)
    report.add_argument("--out", required=True)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    builder = SparkSession.builder.appName("vocalis")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.job == "report":
        opinions.write_reports(spark, args.store, args.out)
        return
    anchor = args.anchor or datetime.datetime.now(datetime.timezone.utc)
    anchor = anchor if anchor.tzinfo else anchor.replace(tzinfo=datetime.timezone.utc)
    valences = lexicons.read_valences(spark, args.valences) if args.valences else lexicons.valence_table(spark)
    opinions.run(spark, args.landing, args.store, args.batch, anchor, valences, mode=args.mode)
    if args.exports:
        headlines, comments = opinions.read_batch(spark, args.landing, anchor)
        opinions.export_stages(headlines, comments, valences, args.exports)


if __name__ == "__main__":
    main()
