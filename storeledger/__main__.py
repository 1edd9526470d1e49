"""``spark-submit`` entry: run the pipeline over a landing folder and show the report."""

import argparse

from pyspark.sql import SparkSession

from storeledger.plans import pipeline
from storeledger.session import configure
from storeledger.sources.pages import read_pages


def main() -> None:
    parser = argparse.ArgumentParser(prog="storeledger")
    parser.add_argument("landing", help="folder of landed pages (JSON lines)")
    parser.add_argument("out", help="folder for raw, mart and published tables")
    parser.add_argument(
        "--set-bad-pages-aside",
        action="store_true",
        help="load the good pages only; without it a bad page fails the run",
    )
    parser.add_argument(
        "--allow-gaps",
        action="store_true",
        help="load an incomplete landing; the gaps are kept in the table gaps",
    )
    args = parser.parse_args()

    spark = configure(SparkSession.builder.appName("storeledger").getOrCreate())
    pages = read_pages(spark, args.landing)
    if args.set_bad_pages_aside:
        pages = pipeline.set_bad_pages_aside(spark, pages, args.out)
    for name, rows in pipeline.run(spark, pages, args.out, args.allow_gaps).items():
        print(name)
        rows.show(truncate=False)


if __name__ == "__main__":
    main()
