"""The five business questions over the star schema, in each of their forms.

``m`` maps mart names to DataFrames. Facts are reduced by surrogate key before
they meet a dimension: the join then sees one row per key instead of one per
event, and names are attached to a few rows only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.functions.scalar import (
    count_where,
    month_label,
    month_number,
    months_before,
    percent,
    round_half,
    rows,
)

c = F.col
Marts = Mapping[str, DataFrame]

MONTH = ["tahun", "bulan", "nama_bulan"]
TOP = 5


def in_order(*columns: str) -> list[Column]:
    """Ascending with NULL last; a leading '-' makes a column descending, NULL last too."""
    return [
        c(name[1:]).desc_nulls_last() if name.startswith("-") else c(name).asc_nulls_last()
        for name in columns
    ]


# question 1: visits per month


def bq1_status(m: Marts, as_of: Column) -> DataFrame:
    """Visits with status code 1 in the 12 months up to ``as_of``."""
    visits = _since(m, months_before(as_of, 12)).where(c("kode_status_kunjungan") == 1)
    return _monthly(m, visits, "total_kunjungan", "total_rawat_inap", "total_rawat_jalan")


def bq1_trend(m: Marts, as_of: Column) -> DataFrame:
    """All visits of the last 12 months and the inpatient share."""
    visits = _since(m, months_before(as_of, 12))
    months = _monthly(m, visits, "total_kunjungan", "total_rawat_inap", "total_rawat_jalan")
    share = percent(c("total_rawat_inap"), c("total_kunjungan"), 1)
    return months.withColumn("pct_rawat_inap", share)


def bq1_bench(m: Marts, as_of: Column) -> DataFrame:
    return _monthly(m, _since(m, months_before(as_of, 12)), "total", "rawat_inap", "rawat_jalan")


def bq1_data_window(m: Marts) -> DataFrame:
    """Months from the data's own last period on.

    The threshold is highest year and highest month, each on its own, less 11 as a
    plain number. It is not a 12-month window, and is kept as defined. It is taken
    over the months already counted, so the fact is read once.
    """
    months = _monthly(m, m["fct_kunjungan"], "total_kunjungan", "rawat_inap", "rawat_jalan")
    everything = Window.partitionBy()
    last = month_number(F.max("tahun").over(everything), F.max("bulan").over(everything))
    return (
        months.withColumn("batas", last - 11)
        .where(month_number(c("tahun"), c("bulan")) >= c("batas"))
        .select(
            *MONTH,
            month_label(c("tahun"), c("bulan")).alias("periode"),
            "total_kunjungan",
            "rawat_inap",
            "rawat_jalan",
        )
        .orderBy(*in_order("tahun", "bulan"))
    )


# question 2: visits per department


def bq2_rank_cross(m: Marts) -> DataFrame:
    """Share of the grand total and rank from both ends; the total is a scalar subquery."""
    counts = _per_department(m)
    grand_total = counts.agg(F.sum("total_kunjungan")).scalar()
    return counts.select(
        "nama_departemen",
        "total_kunjungan",
        percent(c("total_kunjungan"), grand_total, 2).alias("persentase_dari_total"),
        _rank("-total_kunjungan").alias("rank_tertinggi"),
        _rank("total_kunjungan").alias("rank_terendah"),
    ).orderBy(*in_order("-total_kunjungan", "nama_departemen"))


def bq2_rank_window(m: Marts) -> DataFrame:
    """As above with the total as a window over the counted departments."""
    counts = _per_department(m)
    total = F.sum("total_kunjungan").over(Window.partitionBy())
    return counts.select(
        "nama_departemen",
        "total_kunjungan",
        percent(c("total_kunjungan"), total, 1).alias("persentase"),
        _rank("-total_kunjungan").alias("rank_tertinggi"),
        _rank("total_kunjungan").alias("rank_terendah"),
    ).orderBy(*in_order("-total_kunjungan", "nama_departemen"))


def bq2_rank_desc(m: Marts) -> DataFrame:
    return bq2_rank_cross(m).drop("rank_terendah")


def bq2_bench(m: Marts) -> DataFrame:
    counts = _per_department(m).withColumnRenamed("total_kunjungan", "total")
    return counts.orderBy(*in_order("-total", "nama_departemen"))


# question 3: length of stay per department


def bq3_los_inpatient(m: Marts) -> DataFrame:
    stays = m["fct_kunjungan"].where(c("is_rawat_inap") & c("durasi_kunjungan_jam").isNotNull())
    return _stay(m, stays).select(
        "nama_departemen",
        round_half(c("avg_jam"), 2).alias("avg_los_jam"),
        round_half(c("min_jam"), 2).alias("min_los_jam"),
        round_half(c("max_jam"), 2).alias("max_los_jam"),
        c("n").alias("total_kunjungan_rawat_inap"),
    ).orderBy(*in_order("-avg_los_jam", "nama_departemen"))


def bq3_los_days(m: Marts) -> DataFrame:
    """Inpatient stays longer than zero, in hours and in days."""
    stays = m["fct_kunjungan"].where(c("is_rawat_inap") & (c("durasi_kunjungan_jam") > 0))
    return _stay(m, stays).select(
        "nama_departemen",
        c("n").alias("total_rawat_inap"),
        round_half(c("avg_jam"), 2).alias("avg_los_jam"),
        round_half(c("avg_jam") / 24.0, 2).alias("avg_los_hari"),
        round_half(c("min_jam"), 1).alias("min_jam"),
        round_half(c("max_jam"), 1).alias("max_jam"),
    ).orderBy(*in_order("-avg_los_jam", "nama_departemen"))


def bq3_los_all(m: Marts) -> DataFrame:
    """Every visit with a known stay, with its in- and outpatient counts."""
    stays = m["fct_kunjungan"].where(c("durasi_kunjungan_jam").isNotNull())
    return _stay(m, stays).select(
        "nama_departemen",
        c("n").alias("total_kunjungan"),
        round_half(c("avg_jam"), 2).alias("avg_los_jam"),
        round_half(c("min_jam"), 2).alias("min_los_jam"),
        round_half(c("max_jam"), 2).alias("max_los_jam"),
        c("inap").alias("total_rawat_inap"),
        c("jalan").alias("total_rawat_jalan"),
    ).orderBy(*in_order("-avg_los_jam", "nama_departemen"))


def bq3_bench(m: Marts) -> DataFrame:
    stays = m["fct_kunjungan"].where(c("is_rawat_inap") & (c("durasi_kunjungan_jam") > 0))
    return _stay(m, stays).select(
        "nama_departemen", round_half(c("avg_jam"), 2).alias("avg_los_jam"), c("n").alias("total")
    ).orderBy(*in_order("-avg_los_jam", "nama_departemen"))


# question 4: workload per month


def bq4_doctor_status(m: Marts) -> DataFrame:
    """Busiest five doctors of each month over visits with status 1, ties kept."""
    visits = m["fct_kunjungan"].where(c("kode_status_kunjungan") == 1)
    loads = _doctor_load(m, visits, ["nama_dokter", "nama_departemen"])
    return (
        _top(loads, "peringkat")
        .select(
            *MONTH,
            "nama_dokter",
            c("nama_departemen").alias("nama_departemen_dokter"),
            c("total_kunjungan").alias("total_kunjungan_ditangani"),
        )
        .orderBy(*in_order("tahun", "bulan", "-total_kunjungan_ditangani", "nama_dokter"))
    )


def bq4_doctor_top5(m: Marts, limit: int = 100) -> DataFrame:
    """Busiest five doctors of each month with their rank; the first ``limit`` rows of the report."""
    loads = _doctor_load(m, m["fct_kunjungan"], ["nama_dokter", "nama_departemen"])
    order = in_order("tahun", "bulan", "-total_kunjungan", "nama_dokter", "nama_departemen")
    return (
        _top(loads, "rank_bulan")
        .select(*MONTH, "nama_dokter", "nama_departemen", "total_kunjungan", "rank_bulan")
        .orderBy(*order)
        .limit(limit)
    )


def bq4_bench(m: Marts, limit: int = 100) -> DataFrame:
    """By doctor name alone, so doctors sharing a name count as one."""
    loads = _doctor_load(m, m["fct_kunjungan"], ["nama_dokter"])
    return (
        _top(loads, "rn")
        .select(
            "tahun",
            "bulan",
            c("nama_dokter").alias("nama_lengkap"),
            c("total_kunjungan").alias("total"),
            "rn",
        )
        .orderBy(*in_order("tahun", "bulan", "-total", "nama_lengkap"))
        .limit(limit)
    )


def bq4_department_load(m: Marts) -> DataFrame:
    """Every department's visits per month and its rank in the month."""
    months = _calendar(m, MONTH)
    counted = (
        m["fct_kunjungan"]
        .groupBy("departemen_key", "tanggal_masuk_key")
        .agg(rows().alias("n"), *_in_and_out("inap", "jalan"))
        .join(months, "tanggal_masuk_key")
        .join(_departments(m), "departemen_key")
        .groupBy(*MONTH, "nama_departemen")
        .agg(
            F.sum("n").alias("total_kunjungan"),
            F.sum("inap").alias("rawat_inap"),
            F.sum("jalan").alias("rawat_jalan"),
        )
    )
    return counted.withColumn("rank_departemen", _rank("-total_kunjungan", "tahun", "bulan")).orderBy(
        *in_order("tahun", "bulan", "-total_kunjungan", "nama_departemen")
    )


# question 5: appointments that became visits


def bq5_conversion(m: Marts) -> DataFrame:
    months = _conversion(m, "total_kunjungan_dari_appt")
    rate = percent(c("total_converted"), c("total_kunjungan_dari_appt"), 2)
    return months.withColumn("conversion_rate_persen", rate)


def bq5_conversion_guard(m: Marts) -> DataFrame:
    months = _conversion(m, "total_dari_appointment")
    rate = percent(c("total_converted"), c("total_dari_appointment"), 1)
    return months.withColumn("conversion_rate_persen", rate)


def bq5_conversion_full(m: Marts) -> DataFrame:
    total, converted = c("total_dari_appointment"), c("total_converted")
    return _conversion(m, "total_dari_appointment").select(
        *MONTH,
        month_label(c("tahun"), c("bulan")).alias("periode"),
        total,
        converted,
        (total - converted).alias("total_tidak_converted"),
        percent(converted, total, 2).alias("conversion_rate_persen"),
    )


def bq5_overall(m: Marts) -> DataFrame:
    booked = m["fct_kunjungan"].where("is_dari_appointment")
    rate = percent(count_where(c("is_appointment_converted")), rows(), 2)
    return booked.agg(rate.alias("avg_conversion_rate"))


# shared steps


def _calendar(m: Marts, columns: list[str]) -> DataFrame:
    """Calendar days in their role as arrival date. 2,922 rows for any data."""
    days = m["dim_tanggal"].where(c("tanggal").isNotNull())
    return F.broadcast(days.select(c("tanggal_key").alias("tanggal_masuk_key"), *columns))


def _departments(m: Marts) -> DataFrame:
    known = m["dim_departemen"].where(c("dep_id") != "UNKNOWN")
    return known.select("departemen_key", "nama_departemen")


def _since(m: Marts, day: Column) -> DataFrame:
    """Visits arriving on or after a day.

    Visits lie in folders by month of arrival, so earlier months are not listed. Keys
    follow the dates, so within the first month the day is a lower bound on the key
    that reaches the scan as a pushed filter.
    """
    first = m["dim_tanggal"].where(c("tanggal") >= day).agg(F.min("tanggal_key")).scalar()
    month = month_number(F.year(day), F.month(day))
    return m["fct_kunjungan_bulan"].where((c("bulan_masuk") >= month) & (c("tanggal_masuk_key") >= first))


def _in_and_out(inpatient: str, outpatient: str) -> list[Column]:
    return [
        count_where(c("is_rawat_inap")).alias(inpatient),
        count_where(~c("is_rawat_inap")).alias(outpatient),
    ]


def _monthly(m: Marts, visits: DataFrame, total: str, inpatient: str, outpatient: str) -> DataFrame:
    days = visits.groupBy("tanggal_masuk_key").agg(
        rows().alias(total), *_in_and_out(inpatient, outpatient)
    )
    return _months(m, days, total, inpatient, outpatient)


def _months(m: Marts, days: DataFrame, *counts: str) -> DataFrame:
    """Daily counts summed per month, in order.

    There are at most as many rows as calendar days, so they go to one task: months
    and their order then need no further shuffle.
    """
    months = days.repartition(1).join(_calendar(m, MONTH), "tanggal_masuk_key").groupBy(*MONTH)
    return months.agg(*[F.sum(n).alias(n) for n in counts]).orderBy(*in_order("tahun", "bulan"))


def _per_department(m: Marts) -> DataFrame:
    keys = m["fct_kunjungan"].groupBy("departemen_key").agg(rows().alias("n"))
    named = keys.join(_departments(m), "departemen_key").groupBy("nama_departemen")
    return named.agg(F.sum("n").alias("total_kunjungan"))


def _stay(m: Marts, stays: DataFrame) -> DataFrame:
    """Stay statistics per department name.

    Hours have two decimals, so they are summed as whole hundredths: the average
    does not depend on the order in which partial sums arrive.
    """
    hundredths = F.round(c("durasi_kunjungan_jam") * 100, 0).cast("bigint")
    keys = stays.groupBy("departemen_key").agg(
        rows().alias("n"),
        F.sum(hundredths).alias("jam"),
        F.min("durasi_kunjungan_jam").alias("min_jam"),
        F.max("durasi_kunjungan_jam").alias("max_jam"),
        *_in_and_out("inap", "jalan"),
    )
    named = keys.join(_departments(m), "departemen_key").groupBy("nama_departemen")
    return named.agg(
        F.sum("n").alias("n"),
        (F.sum("jam").cast("double") / 100.0 / F.sum("n").cast("double")).alias("avg_jam"),
        F.min("min_jam").alias("min_jam"),
        F.max("max_jam").alias("max_jam"),
        F.sum("inap").alias("inap"),
        F.sum("jalan").alias("jalan"),
    )


def _doctor_load(m: Marts, visits: DataFrame, names: list[str]) -> DataFrame:
    doctors = m["dim_dokter"].select(
        "dokter_key", c("nama_lengkap").alias("nama_dokter"), "nama_departemen"
    )
    return (
        visits.where(c("dokter_key") != -1)
        .join(_calendar(m, MONTH), "tanggal_masuk_key")
        .groupBy(*MONTH, "dokter_key")
        .agg(rows().alias("n"))
        .join(doctors, "dokter_key")
        .groupBy(*MONTH, *names)
        .agg(F.sum("n").alias("total_kunjungan"))
    )


def _top(loads: DataFrame, rank: str) -> DataFrame:
    """Rank within the month, ties kept. Spark limits each group before the shuffle."""
    return loads.withColumn(rank, _rank("-total_kunjungan", "tahun", "bulan")).where(c(rank) <= TOP)


def _rank(order: str, *groups: str) -> Column:
    return F.rank().over(Window.partitionBy(*groups).orderBy(*in_order(order)))


def _conversion(m: Marts, total: str) -> DataFrame:
    days = (
        m["fct_kunjungan"]
        .where("is_dari_appointment")
        .groupBy("tanggal_masuk_key")
        .agg(rows().alias(total), count_where(c("is_appointment_converted")).alias("total_converted"))
    )
    return _months(m, days, total, "total_converted")
