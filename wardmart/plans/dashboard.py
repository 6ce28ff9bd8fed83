"""The tables behind the dashboard charts: the business queries, aggregated once more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.operators.dimensions import MONTH_NAMES
from wardmart.plans import business
from wardmart.plans.business import Marts, in_order


def _sums(df: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(name).alias(name) for name in measures])


def chart_bq1_line(m: Marts) -> DataFrame:
    months = business.bq1_data_window(m)
    return _sums(months, ["periode"], ["total_kunjungan"]).orderBy("periode")


def chart_bq1_stacked(m: Marts) -> DataFrame:
    months = business.bq1_data_window(m)
    return _sums(months, ["periode"], ["rawat_inap", "rawat_jalan"]).orderBy("periode")


def chart_bq2_top10(m: Marts, limit: int = 10) -> DataFrame:
    totals = _sums(business.bq2_rank_desc(m), ["nama_departemen"], ["total_kunjungan"])
    return totals.orderBy(*in_order("-total_kunjungan", "nama_departemen")).limit(limit)


def chart_bq3_table(m: Marts) -> DataFrame:
    measures = ["total_kunjungan", "avg_los_jam", "min_los_jam", "max_los_jam"]
    totals = _sums(business.bq3_los_all(m), ["nama_departemen"], measures)
    return totals.orderBy(*in_order("-avg_los_jam", "nama_departemen"))


def chart_bq4_table(m: Marts) -> DataFrame:
    measures = ["total_kunjungan", "rawat_inap", "rawat_jalan"]
    by = ["tahun", "bulan", "nama_bulan", "nama_departemen"]
    totals = _sums(business.bq4_department_load(m), by, measures)
    return totals.orderBy(*in_order("tahun", "bulan", "-total_kunjungan", "nama_departemen"))


def chart_bq4_heatmap(m: Marts) -> DataFrame:
    """Department by month name, all years together; one row per cell."""
    load = business.bq4_department_load(m)
    return _sums(load, ["nama_departemen", "nama_bulan"], ["total_kunjungan"])


def chart_bq4_heatmap_wide(m: Marts) -> DataFrame:
    """The same with one column per month name. Naming them saves a pass to find them."""
    load = business.bq4_department_load(m)
    return load.groupBy("nama_departemen").pivot("nama_bulan", MONTH_NAMES).agg(F.sum("total_kunjungan"))


def chart_bq5_line(m: Marts) -> DataFrame:
    measures = ["conversion_rate_persen", "total_converted", "total_tidak_converted"]
    return _sums(business.bq5_conversion_full(m), ["periode"], measures).orderBy("periode")
