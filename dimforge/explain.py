"""Print the formatted physical plan of registered queries.

    python -m dimforge.explain revenue_by_category [sf_dir]
"""

from __future__ import annotations

import sys


def main(argv):
    from pyspark.sql import SparkSession

    from .plans.catalog import QUERIES

    keys = [a for a in argv[1:] if not a.startswith("/")] or ["revenue_by_category"]
    dirs = [a for a in argv[1:] if a.startswith("/")]
    sf_dir = dirs[0] if dirs else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for k in keys:
        print(f"===== {k}")
        QUERIES[k](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
