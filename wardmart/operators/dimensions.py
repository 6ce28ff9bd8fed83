"""The five dimensions without their surrogate keys' unknown member.

Each function gives the attributes; ``plans.star`` numbers them and adds the
unknown member. Versioned dimensions hold the initial load only: one current
version per natural key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.functions.keys import ROW_ID

c = F.col

# Calendar range, validity start and Indonesian names.
CALENDAR = ("2020-01-01", "2027-12-31")
VALID_FROM = "2020-01-01"
DAY_NAMES = ["Minggu", "Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu"]
MONTH_NAMES = [
    "Januari", "Februari", "Maret", "April", "Mei", "Juni",
    "Juli", "Agustus", "September", "Oktober", "November", "Desember",
]

# The unknown member of each dimension. Columns not named are NULL.
UNKNOWN: dict[str, dict[str, object]] = {
    "dim_tanggal": {"tanggal_key": -1, "nama_hari": "Unknown", "nama_bulan": "Unknown"},
    "dim_pasien": {
        "pasien_key": -1,
        "pat_id": "UNKNOWN",
        "nama_lengkap": "Unknown",
        "nama_depan": "Unknown",
        "nama_tengah": "",
        "nama_belakang": "Unknown",
        "dw_valid_from": VALID_FROM,
        "dw_is_current": True,
    },
    "dim_dokter": {
        "dokter_key": -1,
        "stf_id": "UNKNOWN",
        "nama_lengkap": "Unknown",
        "nama_depan": "Unknown",
        "nama_belakang": "Unknown",
        "nama_departemen": "Unknown",
        "deskripsi_peran": "Doctor",
        "dw_valid_from": VALID_FROM,
        "dw_is_current": True,
    },
    "dim_departemen": {"departemen_key": -1, "dep_id": "UNKNOWN", "nama_departemen": "Unknown"},
    "dim_ruangan": {
        "ruangan_key": -1,
        "rom_id": "UNKNOWN",
        "departemen_id": "UNKNOWN",
        "nama_departemen": "Unknown",
    },
}


def calendar_days(spark: SparkSession) -> DataFrame:
    """One row per calendar day. Its 2,922 rows are fixed, whatever the data."""
    first, last = (F.lit(day).cast("date") for day in CALENDAR)
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("tanggal"))


def dim_tanggal(spark: SparkSession) -> DataFrame:
    """Days have no gaps, so a day's number in date order is its distance from the first."""
    day = c("tanggal")
    weekday = F.dayofweek(day) - 1
    weekend = weekday.isin(0, 6)
    number = F.datediff(day, F.lit(CALENDAR[0]).cast("date")) + 1
    return calendar_days(spark).select(
        number.cast("bigint").alias("tanggal_key"),
        day,
        F.dayofmonth(day).alias("hari"),
        F.month(day).alias("bulan"),
        F.year(day).alias("tahun"),
        F.quarter(day).alias("kuartal"),
        F.weekofyear(day).alias("minggu"),
        _pick(DAY_NAMES, weekday).alias("nama_hari"),
        _pick(MONTH_NAMES, F.month(day) - 1).alias("nama_bulan"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        F.when(F.month(day) <= 6, 1).otherwise(2).alias("semester"),
        F.dayofyear(day).alias("hari_dalam_tahun"),
    )


def dim_pasien(insured_patients: DataFrame) -> DataFrame:
    return insured_patients.select(
        "pat_id",
        "nama_lengkap",
        "nama_depan",
        "nama_tengah",
        "nama_belakang",
        "jenis_kelamin",
        "tanggal_lahir",
        "golongan_darah",
        "status_pernikahan",
        "nomor_kontak",
        "email",
        "jenis_penjamin",
        "nama_asuransi",
        *_first_version(),
        *_row_id(insured_patients),
    )


def dim_dokter(doctors: DataFrame, dpmt: DataFrame) -> DataFrame:
    names = dpmt.select(c("DEP_ID").alias("dep_id"), c("DEP_NAME").alias("dep_name"))
    return doctors.join(names, "dep_id", "left").select(
        "stf_id",
        "nama_lengkap",
        "nama_depan",
        "nama_belakang",
        "jenis_kelamin",
        "tanggal_lahir",
        c("dep_id").alias("departemen_id"),
        F.coalesce("dep_name", F.lit("Unknown")).alias("nama_departemen"),
        c("kode_peran").cast("string").alias("kode_peran"),
        "deskripsi_peran",
        "status_karyawan",
        "tanggal_masuk",
        "tanggal_peran",
        c("gaji_tahunan").cast("decimal(18,3)").alias("gaji_tahunan"),
        "nomor_kontak",
        "email",
        *_first_version(),
        *_row_id(doctors),
    )


def dim_departemen(departments: DataFrame) -> DataFrame:
    return departments.select(
        "dep_id", "nama_departemen", "deskripsi", "lokasi", "blok", "lantai", *_row_id(departments)
    )


def dim_ruangan(rooms: DataFrame) -> DataFrame:
    """Room ids may repeat; every row stays and gets its own key."""
    return rooms.select(
        "rom_id",
        c("dep_id").alias("departemen_id"),
        "nama_departemen",
        c("kode_tujuan").cast("string").alias("kode_tujuan"),
        "deskripsi_tujuan",
        c("kode_tipe").cast("string").alias("kode_tipe"),
        "deskripsi_tipe",
        "kapasitas",
        *_row_id(rooms),
    )


def _pick(names: list[str], position: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), position)


def _first_version() -> list[Column]:
    return [
        F.lit(VALID_FROM).cast("date").alias("dw_valid_from"),
        F.lit(None).cast("date").alias("dw_valid_to"),
        F.lit(True).alias("dw_is_current"),
    ]


def _row_id(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name == ROW_ID]
