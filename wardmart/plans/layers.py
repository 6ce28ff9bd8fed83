"""The layers of the warehouse in the session catalog: databases, tables, listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.plans.star import Star

# Layer names.
RAW, STAGED, BETWEEN, MARTS = "raw", "analytics_staging", "analytics_intermediate", "analytics_marts"


def create_database(star: Star, database: str) -> None:
    star.spark.sql(f"create database if not exists {database} location '{star.store.root}/{database}'")


def publish_tables(star: Star) -> None:
    """Catalog tables over the files of the stored raw tables and the marts."""
    spark, store = star.spark, star.store
    marts = star.build()
    layers = {RAW: [name for name in star.raw if name in store.names()], MARTS: list(marts)}
    for database, names in layers.items():
        create_database(star, database)
        for name in names:
            spark.sql(f"drop table if exists {database}.{name}")
            spark.sql(f"create table {database}.{name} using parquet location '{store.path(name)}'")
            if name == "fct_kunjungan":
                spark.catalog.recoverPartitions(f"{database}.{name}")  # one folder per month of arrival


def listing(star: Star, database: str = MARTS) -> list[str]:
    """Names of the tables in a layer."""
    return sorted(t.name for t in star.spark.catalog.listTables(database) if not t.isTemporary)


def listed_rows(star: Star) -> DataFrame:
    """(layer, table_name, row_count): the marts as the catalog lists them, each with its rows."""
    publish_tables(star)
    counts = star.store.row_counts(listing(star))
    return counts.select(F.lit(MARTS).alias("layer"), "table_name", "row_count")
