"""Command line for scheduled runs: ``python -m gridmart.jobs <step> ...``.

Each step is one Spark application; days are given as ``YYYY/MM/DD``.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmart.operators.cleaning import rejected_rows
from gridmart.plans.dimensions import type_seed
from gridmart.plans.warehouse import Warehouse
from gridmart.schemas import FEEDS, Feed
from gridmart.session import build_session
from gridmart.sources.landing import land, parse_day, read_landed
from gridmart.sources.pages import page_completeness, read_pages
from gridmart.sources.seeds import read_authority_seed, read_type_seed
from gridmart.streaming.ingest import landed_stream, start_append

FILES_PER_BATCH = 64


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gridmart")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=text, description=text)
        for option in options:
            if option == "--feed":
                sub.add_argument("--feed", choices=sorted(FEEDS), required=True)
            else:
                sub.add_argument(option, required=True)
        return sub

    def days(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--first", type=parse_day, required=True, help="first day")
        sub.add_argument("--last", type=parse_day, help="last day; the first if left out")

    pages = step("land", "flatten landed pages into daily Parquet", "--feed", "--pages", "--landing")
    pages.add_argument("--multi-line", action="store_true", help="pages span several lines")
    days(pages)
    days(step("stage", "append unseen landed rows", "--feed", "--landing", "--warehouse"))
    stream = step("stream", "append all newly landed rows", "--feed", "--landing", "--warehouse", "--checkpoint")
    stream.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH, help="files in a micro-batch")
    seeds = step("seed", "load the seed files", "--authorities", "--warehouse")
    seeds.add_argument("--types", help="type seed; the built-in types if left out")
    step("build", "rebuild the fact", "--warehouse")
    refresh = step("refresh", "rebuild some days of the fact", "--warehouse")
    which = refresh.add_mutually_exclusive_group(required=True)
    which.add_argument("--changed", action="store_true", help="the days that appends have touched since")
    which.add_argument("--first", type=parse_day, help="first day")
    refresh.add_argument("--last", type=parse_day, help="last day; the first if left out")
    check = step("check", "run the data checks", "--warehouse")
    check.add_argument("--first", type=parse_day, help="first day; all if left out")
    check.add_argument("--last", type=parse_day, help="last day; the first if left out")
    return parser


def _rejected(counted: Observation, raw: DataFrame, feed: Feed) -> int:
    """Rows that cleaning dropped; counted apart where the append's own pass was planned away."""
    try:
        return counted.get["rejected"]
    except (Py4JJavaError, KeyError):
        return rejected_rows(raw, feed).first()["rejected_rows"]


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments().parse_args(argv)
    spark = spark or build_session(f"gridmart-{args.step}")
    feed = FEEDS.get(getattr(args, "feed", ""))
    first = getattr(args, "first", None)
    last = getattr(args, "last", None) or first

    if args.step == "land":
        found = read_pages(spark, args.pages, feed, args.multi_line).filter(
            F.col("day").between(first, last)
        )
        found.persist()  # parsed once, for the check and for the landing
        days = page_completeness(found, feed, (first, last)).collect()  # a row per day
        whole = [row["day"] for row in days if not row["is_incomplete"]]
        if whole:  # an incomplete day never replaces what was landed before
            pages = found.filter(F.col("day").isin(whole)).dropDuplicates(["day", "response"])
            records = pages.select("day", F.explode("response.data").alias("record"))
            land(records.select("record.*", "day"), args.landing, feed)
        found.unpersist()
        short = sorted((row for row in days if row["is_incomplete"]), key=lambda row: row["day"])
        for row in short:
            print(row["feed"], row["day"], f"not landed: {row['collected']} of {row['announced']} rows")
        return 1 if short else 0

    house = Warehouse(spark, args.warehouse)
    if args.step == "stage":
        rejected = Observation()
        landed = read_landed(spark, args.landing, feed, first, last)
        house.append(landed, feed, rejected)
        print(feed.name, _rejected(rejected, landed, feed), "rows rejected")
    elif args.step == "stream":
        stream = landed_stream(spark, args.landing, feed, args.files_per_batch)
        start_append(stream, house.staged_table(feed), feed, args.checkpoint).awaitTermination()
    elif args.step == "seed":
        types = read_type_seed(spark, args.types) if args.types else type_seed(spark)
        house.load_seeds(read_authority_seed(spark, args.authorities), types)
    elif args.step == "build":
        house.build_fact()
    elif args.step == "refresh" and args.changed:
        changed = house.refresh_changed()
        print("all days" if changed is None else f"{len(changed)} days", "rebuilt")
    elif args.step == "refresh":
        house.refresh_fact(first, last)
    elif args.step == "check":
        report = house.check(first, last).collect()  # one row per check
        for row in sorted(report):
            print(row["failures"], row["test"], row["model"], row["column_name"])
        return 1 if any(row["failures"] for row in report) else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
