"""``python -m headway import FEED OUT``, ``export STORE OUT``, ``validate FEED [--report OUT]``: feeds are zip archives or folders."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.validation import summary
from .sources import schedule


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="headway", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, second, about in (("import", "out", "a feed to Parquet"), ("export", "out", "Parquet to a feed"), ("validate", None, "a feed's violations")):
        sub = commands.add_parser(name, help=about)
        sub.add_argument("feed_path")
        if second:
            sub.add_argument(second)
        else:
            sub.add_argument("--report", help="write all violations there, as CSV, instead of printing them")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("headway").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if args.command == "import":
            schedule.save(schedule.import_schedule(spark, args.feed_path), args.out)
            print(f"Imported {args.feed_path}")
        elif args.command == "export":
            schedule.export_schedule(schedule.load(spark, args.feed_path), args.out)
            print(f"Exported to {args.out}")
        else:
            found = schedule.import_schedule(spark, args.feed_path, mode="off").violations()
            for r in summary(found).orderBy("table", "column", "code").collect():  # a row for each rule at most
                print(f"{r['n']} x {r['table']}.{r['column']}: {r['code']}")
            if args.report:
                found.write.mode("overwrite").option("header", True).csv(args.report)
            else:
                for r in found.orderBy("table", "row_key", "column", "code").toLocalIterator():
                    print("\t".join(str(x) for x in r))
    except schedule.FeedError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
