"""Joins between staged entities: policy per patient, doctor per visit, appointment per visit.

The left sides carry a row id from their scan, for dealing out hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.functions.keys import ROW_ID
from wardmart.functions.scalar import hours_between
from wardmart.functions.skew import ROWS_PER_TASK, hot_keys, left_join_dealt
from wardmart.operators.nearest import PAYLOAD

c = F.col


def best_policy(policies: DataFrame) -> DataFrame:
    """One policy per patient: active first, then latest end date (none last).

    A maximum over a struct, so rows of one patient shrink to one before the
    shuffle; ranking would move and sort all of them. NULL is the smallest value
    in a struct comparison, which puts open-ended policies last.
    """
    order = ["is_aktif", "tanggal_selesai", "tanggal_mulai", "nama_asuransi", "jenis_penjamin"]
    best = policies.groupBy("pat_id").agg(F.max(F.struct(*order)).alias("best"))
    return best.select(
        "pat_id",
        c("best.jenis_penjamin").alias("jenis_penjamin"),
        c("best.nama_asuransi").alias("nama_asuransi"),
        c("best.is_aktif").alias("asuransi_aktif"),
    )


def int_pasien_dengan_asuransi(patients: DataFrame, policies: DataFrame) -> DataFrame:
    """Patients with their policy. ``pat_id`` is the key of patients, so none of them is hot."""
    kept = patients.drop("kode_jenis_kelamin", "ingst_tmstmp")
    return kept.join(best_policy(policies), "pat_id", "left")


def first_doctor(teams: DataFrame) -> DataFrame:
    """Lowest doctor id per team. Same row as rank 1, but combined before the shuffle."""
    doctors = teams.where("is_dokter")
    return doctors.groupBy("medt_id").agg(F.min("stf_id").alias("stf_id"))


def with_first_doctor(
    visits: DataFrame, teams: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    hot = hot_keys(visits, "medt_id", rows_per_task)
    return left_join_dealt(visits, first_doctor(teams), "medt_id", ROW_ID, hot)


def int_dokter_per_kunjungan(
    visits: DataFrame, teams: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    joined = with_first_doctor(visits, teams, rows_per_task)
    doctor = F.coalesce("stf_id", F.lit("UNKNOWN")).alias("stf_id_dokter")
    return joined.select(*visits.columns, doctor)


def int_kunjungan_enriched(
    visits: DataFrame, best: DataFrame, hot_visits: DataFrame
) -> DataFrame:
    """Visits with stay length and ``best``, the nearest appointment of the previous 30 days.

    The winner is picked per visit number, so visits sharing a number share it.
    """
    found = c("appt_refr_no").isNotNull()
    completed = F.coalesce("is_appointment_completed", F.lit(False))
    won = best.select("refr_no", *PAYLOAD)
    return left_join_dealt(visits, won, "refr_no", ROW_ID, hot_visits).select(
        *visits.columns,
        hours_between(c("waktu_masuk"), c("waktu_keluar")).alias("durasi_kunjungan_jam"),
        *[p for p in PAYLOAD if p != "is_appointment_completed"],
        found.alias("is_dari_appointment"),
        completed.alias("is_appointment_converted"),
    )
