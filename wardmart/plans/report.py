"""Figures of the validation report, and previews of the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.functions.scalar import count_where, percent, rows
from wardmart.plans.business import Marts, in_order
from wardmart.plans.star import KEYS, LOAD_COLUMNS, Star
from wardmart.sources.ingest import with_total

c = F.col


def mart_row_counts(star: Star) -> DataFrame:
    """Rows per mart with its layer, and the total."""
    name = c("table_name")
    layer = F.when(name.startswith("dim"), "DIM").when(name.startswith("fct"), "FCT").otherwise(name)
    return with_total(star.row_counts()).select(layer.alias("layer"), "table_name", "row_count")


def report_date_range(m: Marts) -> DataFrame:
    visits = m["fct_kunjungan"].where(c("waktu_masuk").isNotNull())
    return visits.agg(
        F.min("waktu_masuk").cast("date").alias("min_date"),
        F.max("waktu_masuk").cast("date").alias("max_date"),
    )


def report_visit_split(m: Marts) -> DataFrame:
    counts = m["fct_kunjungan"].agg(
        count_where(c("is_rawat_inap")).alias("rawat_inap"),
        count_where(~c("is_rawat_inap")).alias("rawat_jalan"),
        rows().alias("total"),
    )
    return counts.select(
        "*",
        percent(c("rawat_inap"), c("total"), 1).alias("pct_rawat_inap"),
        percent(c("rawat_jalan"), c("total"), 1).alias("pct_rawat_jalan"),
    )


def report_status_distribution(m: Marts) -> DataFrame:
    known = m["fct_kunjungan"].where(c("deskripsi_status_kunjungan").isNotNull())
    counts = known.groupBy("deskripsi_status_kunjungan").agg(rows().alias("total"))
    return counts.orderBy(*in_order("-total", "deskripsi_status_kunjungan"))


def report_entity_counts(m: Marts) -> DataFrame:
    """Members per dimension as the report defines them.

    Four of the five leave out the unknown member and then subtract one more; the
    calendar does not. The figures are kept as defined.
    """
    labels = {
        "dim_pasien": ("Pasien unik", 1),
        "dim_dokter": ("Dokter unik", 1),
        "dim_departemen": ("Departemen unik", 1),
        "dim_ruangan": ("Ruangan unik", 1),
        "dim_tanggal": ("Rentang tanggal (hari)", 0),
    }
    return reduce(
        DataFrame.unionByName,
        [
            m[name]
            .where(c(KEYS[name]) != -1)
            .agg((rows() - less).alias("jumlah"))
            .select(F.lit(label).alias("entitas"), "jumlah")
            for name, (label, less) in labels.items()
        ],
    )


def report_diagnosis_summary(m: Marts) -> DataFrame:
    return m["fct_diagnosis"].agg(
        rows().alias("total_diagnosis"),
        count_where(c("is_confirmed")).alias("confirmed"),
        count_where(c("is_diagnosis_utama")).alias("utama"),
        F.countDistinct("refr_no").alias("kunjungan_dengan_diagnosis"),
    )


def topk_dept_diagnosis(m: Marts, limit: int = 5) -> DataFrame:
    keys = m["fct_diagnosis"].where(c("departemen_key") != -1).groupBy("departemen_key")
    names = m["dim_departemen"].select("departemen_key", "nama_departemen")
    counts = keys.agg(rows().alias("n")).join(names, "departemen_key").groupBy("nama_departemen")
    totals = counts.agg(F.sum("n").alias("total"))
    return totals.orderBy(*in_order("-total", "nama_departemen")).limit(limit)


def report_treatment_summary(m: Marts) -> DataFrame:
    return m["fct_tindakan_medis"].agg(
        rows().alias("total_tindakan"),
        count_where(c("is_selesai")).alias("selesai"),
        count_where(c("is_operasi")).alias("operasi"),
        count_where(c("is_obat")).alias("pemberian_obat"),
        F.countDistinct("refr_no").alias("kunjungan_dengan_tindakan"),
    )


PREVIEW_COLUMNS = {
    "dim_tanggal": [
        "tanggal_key", "tanggal", "hari", "bulan", "tahun", "nama_hari", "nama_bulan", "is_weekend",
    ],
    "dim_pasien": [
        "pasien_key", "pat_id", "nama_lengkap", "jenis_kelamin", "tanggal_lahir",
        "golongan_darah", "status_pernikahan",
    ],
    "dim_dokter": [
        "dokter_key", "stf_id", "nama_lengkap", "nama_departemen", "deskripsi_peran",
        "status_karyawan",
    ],
    "dim_ruangan": [
        "ruangan_key", "rom_id", "nama_departemen", "deskripsi_tipe", "deskripsi_tujuan", "kapasitas",
    ],
    "fct_kunjungan": [
        "kunjungan_key", "pasien_key", "dokter_key", "departemen_key", "tanggal_masuk_key",
        "is_rawat_inap", "durasi_kunjungan_jam", "deskripsi_status_kunjungan",
    ],
    "fct_diagnosis": [
        "diagnosis_key", "pasien_key", "dokter_key", "departemen_key", "tanggal_diagnosis_key",
        "kode_diagnosis", "deskripsi_diagnosis", "is_confirmed", "is_diagnosis_utama",
    ],
    "fct_tindakan_medis": [
        "tindakan_key", "pasien_key", "dokter_key", "departemen_key", "tanggal_tindakan_key",
        "deskripsi_tipe_tindakan", "is_selesai", "is_operasi", "is_obat",
    ],
}


def preview(m: Marts, name: str, limit: int = 10) -> DataFrame:
    """The first rows of a mart by key.

    Keys run 1..n and tables are stored in key order, so the bound on the key
    skips nearly every row group of the scan. The unknown member stays out.
    """
    key = KEYS[name]
    return m[name].where(c(key).between(1, limit)).select(*PREVIEW_COLUMNS[name]).orderBy(key)


def preview_all(m: Marts, name: str) -> DataFrame:
    """A dimension shown whole, without the unknown member and load times."""
    key = KEYS[name]
    columns = PREVIEW_COLUMNS.get(name, [n for n in m[name].columns if n not in LOAD_COLUMNS])
    return m[name].where(c(key) != -1).select(*columns).orderBy(key)


def preview_visit_days(m: Marts, limit: int = 10) -> DataFrame:
    """The first calendar days, with the number of visits arriving on each."""
    days = calendar_use(m).where(c("tanggal_key") != -1).orderBy("tanggal_key").limit(limit)
    return days.select(*PREVIEW_COLUMNS["dim_tanggal"], "jumlah_kunjungan")


def calendar_use(m: Marts) -> DataFrame:
    """The date dimension with the number of visits arriving on each day."""
    arrivals = m["fct_kunjungan"].groupBy(c("tanggal_masuk_key").alias("tanggal_key"))
    counts = arrivals.agg(rows().alias("n"))
    days = m["dim_tanggal"].join(counts, "tanggal_key", "left")
    return days.withColumn("jumlah_kunjungan", F.coalesce("n", F.lit(0))).drop("n")
