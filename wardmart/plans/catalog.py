"""Publish a built warehouse in the session catalog, layer by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardmart.plans.layers import BETWEEN, MARTS, STAGED, create_database, publish_tables
from wardmart.plans.registry import INTERMEDIATE, QUERIES, STAGING
from wardmart.plans.star import Star


def outlives_session(spark: SparkSession) -> bool:
    """Whether the session's catalog keeps its entries when the application ends."""
    return spark.conf.get("spark.sql.catalogImplementation") != "in-memory"


def publish(star: Star, lasting: bool = False) -> None:
    """Raw tables and marts as catalog tables over their files; the layers between as views.

    Tables are replaced as a whole. Statistics are computed for the marts, so the
    optimizer knows their row counts as well as their sizes.

    The views end with the session, unless they are to be ``lasting``: then they are
    stored and become permanent views. That takes a catalog that lasts; with one in memory it is an
    error, raised before anything is built.
    """
    if lasting and not outlives_session(star.spark):
        raise ValueError(
            "lasting views need a persistent catalog, and this session's is in memory: "
            "set spark.sql.catalogImplementation=hive and a metastore"
        )
    publish_tables(star)
    for name in star.build():
        star.spark.sql(f"analyze table {MARTS}.{name} compute statistics")
    if lasting:
        publish_views(star)
    else:
        for name, view in _views(star).items():
            view.createOrReplaceTempView(name)


def publish_views(star: Star) -> None:
    """Staging and intermediate tables stored, and a permanent view over the files of each.

    A view is replaced in one step by a view over the new files, so readers never miss it.
    """
    for database in (STAGED, BETWEEN):
        create_database(star, database)
    for name, view in _views(star).items():
        star.store.write(name, view)
        database = STAGED if name in STAGING else BETWEEN
        star.spark.sql(f"create or replace view {database}.{name} as {view_text(star, name)}")


def view_text(star: Star, name: str) -> str:
    """The statement of a view: its columns by name, from the files of the stored table."""
    columns = ", ".join(f"`{column}`" for column in star.store.read(name).columns)
    return f"select {columns} from parquet.`{star.store.path(name)}`"


def _views(star: Star) -> dict[str, DataFrame]:
    staged = {name: star.staging(name) for name in STAGING}
    return staged | {name: QUERIES[name](star) for name in INTERMEDIATE}
