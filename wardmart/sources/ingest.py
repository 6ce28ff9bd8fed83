"""CSV archive to raw Parquet tables: presence check, load, row-count gate."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmart.sources.schemas import RAW_FILES, raw_schema
from wardmart.sources.store import TableStore

_BAD_LINE = "_bad_line"


def source_files(spark: SparkSession, archive: str) -> DataFrame:
    """Path and size of every expected file; raises FileNotFoundError naming all missing ones.

    Only the two metadata columns of the binary source are read, never the content.
    """
    found: list[DataFrame] = []
    missing: list[str] = []
    for relative in (f for files in RAW_FILES.values() for f in files):
        path = f"{archive.rstrip('/')}/{relative}"
        try:
            files = spark.read.format("binaryFile").load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
        else:
            found.append(files.select(F.lit(relative).alias("file"), F.col("length").alias("bytes")))
    if missing:
        raise FileNotFoundError(f"missing source files: {missing}")
    return reduce(DataFrame.unionByName, found)


def read_csv(
    spark: SparkSession, paths: list[str], schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """Rows that fit the schema in every column; a row that does not is dropped whole.

    A header that does not name the schema's columns in their order is an error.
    ``multi_line`` is for files with line breaks inside quotes; such a file is read by
    one task, as it cannot be split.

    Take all columns of the result: Spark parses only the selected ones, so a bad
    value in an unselected column would let its row through. ``ingest`` writes the
    table to Parquet before anything else reads it.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "DROPMALFORMED")
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(paths)
    )


def read_csv_counted(
    spark: SparkSession, paths: list[str], schema: T.StructType, multi_line: bool = False
) -> tuple[DataFrame, Observation]:
    """The same rows as ``read_csv``, and how many were dropped.

    The observation has ``read`` and ``rejected`` once the rows have been written; they
    are counted on the way, without another scan.
    """
    rows = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(_BAD_LINE, T.StringType())]))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD_LINE)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(paths)
    )
    counts = Observation()
    bad = F.col(_BAD_LINE).isNotNull()
    observed = rows.observe(counts, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("rejected"))
    return observed.where(~bad).drop(_BAD_LINE), counts


def ingest(
    spark: SparkSession,
    archive: str,
    store: TableStore,
    multi_line: Collection[str] = (),
    rejected: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Load every raw table with full refresh and return them by name.

    ``multi_line`` names the tables whose files have line breaks inside quotes.
    ``rejected`` is filled with the number of lines dropped from each table's files.
    """
    source_files(spark, archive).collect()
    raw, counts = {}, {}
    for name, files in RAW_FILES.items():
        paths = [f"{archive.rstrip('/')}/{f}" for f in files]
        rows, counts[name] = read_csv_counted(spark, paths, raw_schema(name), name in multi_line)
        raw[name] = store.write(name, rows)
    require_rows(raw)
    if rejected is not None:
        rejected |= {name: seen.get["rejected"] for name, seen in counts.items()}
    return raw


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table and a last row with the total, in one job."""
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in sorted(tables.items())
        ],
    )
    return with_total(counts)


def with_total(counts: DataFrame) -> DataFrame:
    """(table_name, row_count) with a last row for all tables."""
    rolled = counts.rollup("table_name").agg(F.sum("row_count").alias("row_count"))
    return rolled.select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count")


def require_rows(tables: dict[str, DataFrame]) -> None:
    """Raise when a table is empty. Stops each table at its first row, counting nothing."""
    empty = [name for name, df in sorted(tables.items()) if df.isEmpty()]
    if empty:
        raise ValueError(f"empty tables: {empty}")
