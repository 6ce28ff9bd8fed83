"""The daily run: check the files, load them, build the star, test it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from wardmart.operators import quality
from wardmart.plans.star import Star
from wardmart.sources.ingest import ingest
from wardmart.sources.store import TableStore


def refresh(spark: SparkSession, archive: str, root: str) -> tuple[Star, DataFrame]:
    """Build everything from the CSV archive into ``root``.

    Returns the warehouse and the result of the 75 column tests. Missing files and
    empty raw tables stop the run; failed column tests are reported, not raised. How
    many lines of each table's files did not fit is in ``star.rejected``.
    """
    store = TableStore(spark, root)
    rejected: dict[str, int] = {}
    star = Star(ingest(spark, archive, store, rejected=rejected), store)
    star.rejected = rejected
    marts = star.build()
    tests = [
        quality.column_unique(marts),
        quality.column_not_null(marts),
        quality.column_accepted_values(marts),
        quality.column_relationships(marts),
    ]
    return star, reduce(DataFrame.unionByName, tests)
