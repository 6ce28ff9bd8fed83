"""Command line: build the warehouse from a CSV archive.

    python -m wardmart ARCHIVE ROOT
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from wardmart.operators import quality
from wardmart.plans.catalog import outlives_session, publish
from wardmart.plans.refresh import refresh


def main(archive: str, root: str) -> None:
    spark = SparkSession.builder.appName("wardmart").getOrCreate()
    star, tests = refresh(spark, archive, root)
    print("lines dropped:", star.rejected)
    tests.where("status = 'fail'").show(100, truncate=False)
    quality.summary(star.build()).show(truncate=False)
    quality.require_integrity(star.build())
    lasting = outlives_session(spark)
    publish(star, lasting)
    if not lasting:
        print("the catalog is in memory: the tables stay as files below", root, "and the views end here")


if __name__ == "__main__":
    main(*sys.argv[1:3])
