"""Quality report of a cleaned table.

    spark-submit --py-files vellumark.zip vellumark/plans/quality_job.py CLEANED REPORT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from vellumark.operators.quality import quality_report
from vellumark.plans.metrics import utc_stamp
from vellumark.session import build_session
from vellumark.sources.catalogue import read_table
from vellumark.sources.sinks import write_report


def run(spark: SparkSession, cleaned: str, report: str, approximate: bool = False) -> None:
    profile = quality_report(read_table(spark, cleaned), approximate=approximate)
    write_report(profile.withColumn("generated_at_utc", utc_stamp()), report)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("cleaned")
    parser.add_argument("report")
    parser.add_argument("--approximate", action="store_true")
    options = parser.parse_args()
    spark = build_session("catalogue-quality")
    run(spark, options.cleaned, options.report, options.approximate)
    spark.stop()


if __name__ == "__main__":
    main()
