"""``spark-submit`` entry: all reports for one transaction CSV."""

import argparse

from pyspark.sql import SparkSession

from salescope.plans import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="salescope", description=__doc__)
    parser.add_argument("source", help="transaction CSV file or folder")
    parser.add_argument("output", help="folder for the prepared table and the reports")
    parser.add_argument("--horizon-hours", type=float, default=1.0, help="what counts as a quick repurchase")
    parser.add_argument("--category", default=jobs.REPORT_CATEGORY, help="main category of the month-by-product report")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("salescope").getOrCreate()
    jobs.run(spark, options.source, options.output, options.horizon_hours, options.category)


if __name__ == "__main__":
    main()
