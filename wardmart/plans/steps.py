"""Single operators of the warehouse over the raw or staged tables, each on its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.functions.keys import ROW_ID, dense_key, with_row_id, with_unknown
from wardmart.functions.scalar import (
    count_where,
    date_or_null,
    elapsed_seconds,
    hours_between,
    int_or_null,
    money_or_null,
    month_label,
    month_number,
    months_before,
    percent,
    rows,
    time_of_day,
)
from wardmart.operators import facts, intermediate, nearest
from wardmart.operators.dimensions import calendar_days
from wardmart.plans.business import in_order
from wardmart.plans.star import Star
from wardmart.sources.ingest import read_csv, source_files
from wardmart.sources.schemas import RAW_FILES, raw_schema

c = F.col


# scans


def raw_diag_union(star: Star) -> DataFrame:
    return star.raw["stg_ehp__diag"]


def ingest_csv(star: Star) -> DataFrame:
    """Visits written as CSV with some unreadable values, and read back with those rows dropped.

    Every 50th room gets a word in a number column, every 70th a time that is none.
    """
    visits = star.raw["stg_ehp__vist"]
    room = F.substring("ROM_ID", 2, 5).try_cast("int")
    text = visits.select(
        *[c(name).cast("string").alias(name) for name in raw_schema("stg_ehp__vist").names]
    )
    broken = text.withColumns(
        {
            "VSTAT_CD": F.when(room % 50 == 7, "bad").otherwise(c("VSTAT_CD")),
            "VIS_EX": F.when(room % 70 == 9, "never").otherwise(c("VIS_EX")),
        }
    )
    folder = f"{star.store.root}/csv/visits"
    broken.write.mode("overwrite").option("header", True).csv(folder)
    loaded = read_csv(star.spark, [folder], raw_schema("stg_ehp__vist"))
    return star.store.write("raw_visits", loaded)


def source_presence(star: Star) -> DataFrame:
    """Raw tables written as the files of an archive; the files found there, and their lines, per table.

    The table that comes in two files is dealt over both by the hash of its rows.
    """
    archive = f"{star.store.root}/archive"
    lines = []
    for name, files in RAW_FILES.items():
        raw = star.raw[name]
        text = raw.select(*[c(column).cast("string").alias(column) for column in raw.columns])
        share = F.pmod(F.hash(*raw.columns), F.lit(len(files)))
        for number, file in enumerate(files):
            path = f"{archive}/{file}"
            part = text.where(share == number).write.mode("overwrite")
            part.option("header", True).option("escape", '"').csv(path)
            read = star.spark.read.schema(text.schema).option("header", True).option("escape", '"').csv(path)
            counted = read.agg(rows().alias("row_count"))
            lines.append(counted.select(F.lit(name).alias("table_name"), F.lit(file).alias("file"), "row_count"))
    found = source_files(star.spark, archive).groupBy("file").agg(F.sum("bytes").alias("bytes"))
    present = reduce(DataFrame.unionByName, lines).join(found.where("bytes > 0"), "file")
    return present.groupBy("table_name").agg(rows().alias("n_files"), F.sum("row_count").alias("row_count"))


def calendar_series(star: Star) -> DataFrame:
    """Every calendar day with the visits arriving on it."""
    arrivals = star.staging("stg_kunjungan").groupBy(c("tanggal_masuk").alias("tanggal"))
    counts = arrivals.agg(rows().alias("n"))
    days = calendar_days(star.spark).join(counts, "tanggal", "left")
    return days.select("tanggal", F.coalesce("n", F.lit(0)).alias("jumlah_kunjungan"))


# predicates


def filter_not_null(star: Star) -> DataFrame:
    visits = star.staging("stg_kunjungan").where(c("rom_id").isNotNull())
    return visits.select("refr_no", "medt_id", "rom_id")


def like_predicate(star: Star) -> DataFrame:
    confirmed = star.staging("stg_diagnosis").where(c("deskripsi_status").like("%Confirmed%"))
    return confirmed.select("refr_no", "urutan_diagnosis", "kode_diagnosis", "deskripsi_status")


def filter_last_12_months(star: Star, as_of: Column) -> DataFrame:
    recent = star.staging("stg_kunjungan").where(c("tanggal_masuk") >= months_before(as_of, 12))
    return recent.select("refr_no", "pat_id", "tanggal_masuk")


def scalar_subquery_month_window(star: Star) -> DataFrame:
    """Visits from the data's last period on, with the period as a scalar subquery."""
    year, month = F.year("tanggal_masuk"), F.month("tanggal_masuk")
    visits = star.staging("stg_kunjungan")
    last = visits.agg((month_number(F.max(year), F.max(month)) - 11).alias("batas")).scalar()
    months = visits.where(month_number(year, month) >= last).groupBy(
        month_number(year, month).alias("periode")
    )
    return months.agg(rows().alias("total_kunjungan"))


# joins


def join_left_ranked(star: Star) -> DataFrame:
    visits = with_row_id(star.staging("stg_kunjungan").select("refr_no", "medt_id"))
    teams = star.staging("stg_tim_medis")
    joined = intermediate.with_first_doctor(visits, teams, star.rows_per_task)
    return joined.select("refr_no", "medt_id", "stf_id")


def join_interval_30d(star: Star) -> DataFrame:
    return nearest.appointments_in_reach(
        star.staging("stg_kunjungan"), star.staging("stg_appointment")
    )


def join_nearest_match(star: Star) -> DataFrame:
    return star.nearest_appointments()


def join_star_lookup(star: Star) -> DataFrame:
    """Visits with every dimension key, -1 where none fits."""
    visits = star.keyed_visits().join(
        facts.date_lookup(star.table("dim_tanggal"), "tanggal_masuk", "tanggal_masuk_key"),
        "tanggal_masuk",
        "left",
    )
    keys = ["pasien_key", "dokter_key", "ruangan_key", "departemen_key", "tanggal_masuk_key"]
    return visits.select(
        "refr_no", "medt_id", *[F.coalesce(c(k), F.lit(-1).cast("bigint")).alias(k) for k in keys]
    )


def join_role_playing_date(star: Star) -> DataFrame:
    """Visits by arrival and departure month: the calendar joined in two roles."""
    days = star.table("dim_tanggal").where(c("tanggal").isNotNull())

    def role(name: str) -> DataFrame:
        period = month_label(c("tahun"), c("bulan")).alias(f"periode_{name}")
        return F.broadcast(days.select(c("tanggal_key").alias(f"tanggal_{name}_key"), period))

    pairs = star.table("fct_kunjungan").groupBy("tanggal_masuk_key", "tanggal_keluar_key")
    counts = pairs.agg(rows().alias("n"))
    named = counts.join(role("masuk"), "tanggal_masuk_key").join(role("keluar"), "tanggal_keluar_key")
    return named.groupBy("periode_masuk", "periode_keluar").agg(F.sum("n").alias("total_kunjungan"))


def join_fallback_lookup(star: Star) -> DataFrame:
    """Room and department of each diagnosis: its own, else its visit's, else unknown."""
    return star.diagnoses().select(
        "refr_no", "urutan_diagnosis", "kode_diagnosis", "waktu_diagnosis", "ruangan_key", "departemen_key"
    )


def anti_join_orphans(star: Star) -> DataFrame:
    """References without a target. A NULL reference counts, as in LEFT JOIN ... IS NULL.

    Both sides are reduced to distinct values before they are shuffled, so a value
    held by many rows moves once.
    """
    links = {
        "kunjungan-pasien": ("stg_kunjungan", "pat_id", "stg_pasien", "pat_id"),
        "kunjungan-ruangan": ("stg_kunjungan", "rom_id", "stg_ruangan", "rom_id"),
        "diagnosis-kunjungan": ("stg_diagnosis", "refr_no", "stg_kunjungan", "refr_no"),
        "dokter-departemen": ("stg_staff_dokter", "dep_id", "stg_departemen", "dep_id"),
    }
    parts = []
    for name, (child, reference, parent, key) in links.items():
        used = star.staging(child).groupBy(c(reference).alias("ref")).agg(rows().alias("n"))
        known = star.staging(parent).select(c(key).alias("ref")).distinct()
        missing = used.join(known, "ref", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        parts.append(missing.select(F.lit(name).alias("hubungan"), c("n").alias("jumlah_yatim")))
    return reduce(DataFrame.unionByName, parts)


# aggregates, windows, set operations


def agg_conditional_sum(star: Star) -> DataFrame:
    groups = star.staging("stg_tindakan_medis").groupBy("deskripsi_tipe")
    return groups.agg(
        rows().alias("total"),
        count_where(c("is_selesai")).alias("selesai"),
        count_where(~c("is_selesai")).alias("belum_selesai"),
        F.sum("total_biaya").alias("total_biaya"),
    )


def agg_count_distinct(star: Star) -> DataFrame:
    groups = star.staging("stg_diagnosis").groupBy("deskripsi_status")
    return groups.agg(
        rows().alias("total"), F.countDistinct("refr_no").alias("kunjungan_dengan_diagnosis")
    )


def window_row_number_pick(star: Star) -> DataFrame:
    return intermediate.best_policy(star.staging("stg_asuransi"))


def surrogate_key_dense(star: Star) -> DataFrame:
    """Team members numbered 1..n over the whole table."""
    members = with_row_id(star.staging("stg_tim_medis").drop("is_dokter"))
    order = [name for name in members.columns if name != ROW_ID]
    numbered = star.store.write("tim_medis", dense_key(star.store, "tim_medis", members, order, "anggota_key"))
    star.store.release("tim_medis__ordered")
    return numbered


def window_rank_global(star: Star) -> DataFrame:
    """Each code's rank by its total, from both ends.

    Ranks are worked out once per different total. Totals add up to the rows, so of n
    rows there are fewer than sqrt(2n) different ones: only those meet in one task.
    """
    counts = star.staging("stg_diagnosis").groupBy("kode_diagnosis").agg(rows().alias("total"))
    totals = counts.groupBy("total").agg(rows().alias("codes"))

    def rank(*order: str) -> Column:
        before = Window.orderBy(*in_order(*order)).rowsBetween(Window.unboundedPreceding, -1)
        return (F.coalesce(F.sum("codes").over(before), F.lit(0)) + 1).cast("int")

    ranks = totals.select("total", rank("-total").alias("rank_tertinggi"), rank("total").alias("rank_terendah"))
    return counts.join(ranks, "total").select("kode_diagnosis", "total", "rank_tertinggi", "rank_terendah")


def window_rank_partitioned(star: Star) -> DataFrame:
    year = F.year("tanggal_masuk").alias("tahun")
    groups = star.staging("stg_kunjungan").groupBy(year, "deskripsi_tipe", "deskripsi_status")
    within_year = Window.partitionBy("tahun").orderBy(*in_order("-total"))
    return groups.agg(rows().alias("total")).withColumn("peringkat", F.rank().over(within_year))


def window_sum_over_all(star: Star) -> DataFrame:
    counts = star.staging("stg_kunjungan").groupBy("deskripsi_status").agg(rows().alias("total"))
    everything = F.sum("total").over(Window.partitionBy())
    return counts.withColumn("persentase", percent(c("total"), everything, 1))


def topk_per_group(star: Star, k: int = 5) -> DataFrame:
    """The busiest team members of each role, ties kept."""
    counts = star.staging("stg_tim_medis").groupBy("deskripsi_peran", "stf_id").agg(rows().alias("total"))
    rank = F.rank().over(Window.partitionBy("deskripsi_peran").orderBy(*in_order("-total")))
    return counts.withColumn("peringkat", rank).where(c("peringkat") <= k)


def union_unknown_member(star: Star) -> DataFrame:
    doctors = star.staging("stg_staff_dokter").select("stf_id", "nama_lengkap", "gaji_tahunan")
    return with_unknown(doctors, {"stf_id": "UNKNOWN", "nama_lengkap": "Unknown"})


# scalar functions


def scalar_strings(star: Star) -> DataFrame:
    name = c("F_NAME")
    return star.raw["stg_ehp__patn"].select(
        c("PAT_ID").alias("pat_id"),
        F.trim(name).alias("dipangkas"),
        F.coalesce("M_NAME", F.lit("-")).alias("tengah"),
        F.concat(name, F.lit(" "), "L_NAME").alias("gabungan"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("setelah_pagar"),
        F.split_part(name, F.lit("#"), F.lit(3)).alias("di_luar"),
        F.lpad(c("GEN_CD").cast("string"), 2, "0").alias("kode_dua_digit"),
    )


def scalar_dates(star: Star, as_of: Column) -> DataFrame:
    """Date parts of every arrival day, with the visits on it."""
    day = c("tanggal_masuk")
    days = star.staging("stg_kunjungan").groupBy("tanggal_masuk").agg(rows().alias("total"))
    return days.select(
        day,
        "total",
        F.dayofmonth(day).alias("hari"),
        F.month(day).alias("bulan"),
        F.year(day).alias("tahun"),
        F.quarter(day).alias("kuartal"),
        F.weekofyear(day).alias("minggu"),
        (F.dayofweek(day) - 1).alias("hari_ke"),
        F.dayofyear(day).alias("hari_dalam_tahun"),
        F.when(F.month(day) <= 6, 1).otherwise(2).alias("semester"),
        F.date_sub(day, 30).alias("tiga_puluh_hari_sebelum"),
        (day >= months_before(as_of, 12)).alias("dalam_12_bulan"),
        month_label(F.year(day), F.month(day)).alias("periode"),
    )


def scalar_casts(star: Star) -> DataFrame:
    return star.raw["stg_ehp__stff"].select(
        c("STF_ID").alias("stf_id"),
        date_or_null(c("HIRE_DATE")).alias("tanggal_masuk"),
        date_or_null(c("ROLE_DATE")).alias("tanggal_peran"),
        int_or_null(F.substring("STF_ID", 2, 5)).alias("nomor"),
        int_or_null(c("HIRE_DATE")).alias("bukan_angka"),
        money_or_null(c("SAL_YR")).alias("gaji"),
        c("SAL_YR").cast("decimal(18,3)").alias("gaji_lebar"),
        c("DT_BRT").try_cast("timestamp_ntz").alias("lahir"),
        c("ROLE_CD").cast("string").alias("kode"),
    )


def scalar_math(star: Star) -> DataFrame:
    start, end = c("waktu_masuk"), c("waktu_keluar")
    seconds = elapsed_seconds(start, end)
    return star.staging("stg_kunjungan").select(
        "refr_no",
        "medt_id",
        seconds.cast("double").alias("detik"),
        F.abs(-seconds).cast("double").alias("jarak"),
        hours_between(start, end).alias("jam"),
        percent(c("kode_status"), c("kode_tipe"), 1).alias("rasio"),
        month_number(F.year(start), F.month(start)).alias("periode"),
        time_of_day(start).alias("jam_masuk"),
    )


# ad-hoc SQL

ADHOC_SQL = """
select d.nama_departemen, r.deskripsi_tipe, count(*) as total_kunjungan
from fct_kunjungan k
join dim_ruangan r on r.ruangan_key = k.ruangan_key
join dim_departemen d on d.departemen_key = k.departemen_key
group by d.nama_departemen, r.deskripsi_tipe"""
