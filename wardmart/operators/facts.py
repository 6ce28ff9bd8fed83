"""The three transaction facts: natural keys replaced by surrogate keys, -1 where none fits.

Rows multiply where a lookup has several rows for a key (duplicate room ids,
repeated visit numbers). That is the defined result; nothing is deduplicated.

Dimensions are read from their stored tables, so Spark knows their sizes: it
broadcasts one only below its threshold and otherwise shuffles both sides and
splits skewed partitions. The fixed-size calendar carries a hint, and rooms and doctors
if they are few by count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.functions.skew import left_join_spread

c = F.col

VISIT_ROW = "_visit_row"

FCT_KUNJUNGAN = [
    "pasien_key", "dokter_key", "ruangan_key", "departemen_key", "tanggal_masuk_key",
    "tanggal_keluar_key", "refr_no", "medt_id", "appt_refr_no", "kode_status_kunjungan",
    "deskripsi_status_kunjungan", "kode_tipe_kunjungan", "deskripsi_tipe_kunjungan",
    "kode_status_appointment", "deskripsi_status_appointment", "kode_tipe_appointment",
    "durasi_kunjungan_jam", "is_rawat_inap", "is_dari_appointment", "is_appointment_converted",
    "jam_masuk", "jam_keluar", "waktu_masuk", "waktu_keluar",
]
FCT_DIAGNOSIS = [
    "pasien_key", "dokter_key", "ruangan_key", "departemen_key", "tanggal_diagnosis_key",
    "refr_no", "urutan_diagnosis", "kode_diagnosis", "deskripsi_diagnosis", "kode_status",
    "deskripsi_status", "kode_tipe", "deskripsi_tipe", "total_biaya_diagnosis",
    "jumlah_diagnosis", "waktu_diagnosis", "is_diagnosis_utama", "is_confirmed",
]
FCT_TINDAKAN_MEDIS = [
    "pasien_key", "dokter_key", "ruangan_key", "departemen_key", "tanggal_tindakan_key",
    "refr_no", "urutan_tindakan", "kode_tindakan", "kode_tipe_tindakan",
    "deskripsi_tipe_tindakan", "kode_status_tindakan", "deskripsi_status_tindakan",
    "deskripsi_tindakan", "total_biaya_tindakan", "jumlah_tindakan", "waktu_tindakan",
    "is_selesai", "is_operasi", "is_obat",
]


def key_order(leading: list[str], columns: list[str]) -> list[str]:
    """Order for the surrogate key: the defining columns, then every other one to settle ties."""
    return leading + [name for name in columns if name not in leading]


def patient_lookup(dim_pasien: DataFrame) -> DataFrame:
    return dim_pasien.where(c("dw_is_current") & (c("pat_id") != "UNKNOWN")).select(
        "pat_id", "pasien_key"
    )


def doctor_lookup(dim_dokter: DataFrame) -> DataFrame:
    return dim_dokter.where(c("dw_is_current") & (c("stf_id") != "UNKNOWN")).select(
        c("stf_id").alias("stf_id_dokter"), "dokter_key"
    )


def room_lookup(dim_ruangan: DataFrame, dim_departemen: DataFrame) -> DataFrame:
    """Room id to room key and, through the room's department, department key."""
    departments = dim_departemen.where(c("dep_id") != "UNKNOWN").select(
        c("dep_id").alias("departemen_id"), "departemen_key"
    )
    rooms = dim_ruangan.where(c("rom_id") != "UNKNOWN")
    return rooms.join(departments, "departemen_id", "left").select(
        "rom_id", "ruangan_key", "departemen_key"
    )


def date_lookup(dim_tanggal: DataFrame, day: str, key: str) -> DataFrame:
    """The calendar in one of its roles: ``day`` to ``key``."""
    days = dim_tanggal.where(c("tanggal").isNotNull())
    return F.broadcast(days.select(c("tanggal").alias(day), c("tanggal_key").alias(key)))


def keyed_visits(
    visits: DataFrame, patients: DataFrame, doctors: DataFrame, rooms: DataFrame
) -> DataFrame:
    """Visits with their patient, doctor, room and department keys (NULL where none fits).

    All three facts need these lookups, so they are done once, per visit.
    """
    return (
        visits.join(patients, "pat_id", "left")
        .join(doctors, "stf_id_dokter", "left")
        .join(rooms, "rom_id", "left")
        .select(*visits.columns, "pasien_key", "dokter_key", "ruangan_key", "departemen_key")
    )


def fct_kunjungan(enriched: DataFrame, dim_tanggal: DataFrame) -> DataFrame:
    dated = enriched.join(
        date_lookup(dim_tanggal, "tanggal_masuk", "tanggal_masuk_key"), "tanggal_masuk", "left"
    ).join(
        date_lookup(dim_tanggal, "tanggal_keluar", "tanggal_keluar_key"), "tanggal_keluar", "left"
    )
    named = dated.withColumnsRenamed(
        {
            "kode_status": "kode_status_kunjungan",
            "deskripsi_status": "deskripsi_status_kunjungan",
            "kode_tipe": "kode_tipe_kunjungan",
            "deskripsi_tipe": "deskripsi_tipe_kunjungan",
            "kode_status_appt": "kode_status_appointment",
            "deskripsi_status_appt": "deskripsi_status_appointment",
            "kode_tipe_appt": "kode_tipe_appointment",
        }
    )
    return named.select(*[_or_unknown(name) for name in FCT_KUNJUNGAN])


def fct_diagnosis(
    diagnoses: DataFrame,
    visit_keys: tuple[DataFrame, DataFrame],
    rooms: DataFrame,
    dim_tanggal: DataFrame,
    hot_visits: DataFrame,
) -> DataFrame:
    """Room and department come from the diagnosis, each on its own, else from the visit.

    ``visit_keys`` are those of all other visit numbers, and of the hot ones.
    """
    own_room = rooms.withColumnsRenamed(
        {"ruangan_key": "own_room_key", "departemen_key": "own_department_key"}
    )
    located = diagnoses.join(own_room, "rom_id", "left").join(
        date_lookup(dim_tanggal, "tanggal_diagnosis", "tanggal_diagnosis_key"),
        "tanggal_diagnosis",
        "left",
    )
    joined = left_join_spread(located, *visit_keys, "refr_no", VISIT_ROW, hot_visits)
    confirmed = c("deskripsi_status").like("%Confirmed%") | (c("deskripsi_status") == "Recurrent")
    measured = joined.withColumns(
        {
            "ruangan_key": F.coalesce("own_room_key", "ruangan_key"),
            "departemen_key": F.coalesce("own_department_key", "departemen_key"),
            "total_biaya_diagnosis": c("total_biaya"),
            "jumlah_diagnosis": F.lit(1),
            "is_diagnosis_utama": F.coalesce(c("kode_tipe") == 0, F.lit(False)),
            "is_confirmed": F.coalesce(confirmed, F.lit(False)),
        }
    )
    return measured.select(*[_or_unknown(name) for name in FCT_DIAGNOSIS])


def fct_tindakan_medis(
    treatments: DataFrame,
    visit_keys: tuple[DataFrame, DataFrame],
    dim_tanggal: DataFrame,
    hot_visits: DataFrame,
) -> DataFrame:
    dated = treatments.join(
        date_lookup(dim_tanggal, "tanggal_tindakan", "tanggal_tindakan_key"),
        "tanggal_tindakan",
        "left",
    )
    joined = left_join_spread(dated, *visit_keys, "refr_no", VISIT_ROW, hot_visits)
    measured = joined.withColumn("jumlah_tindakan", F.lit(1)).withColumnsRenamed(
        {
            "kode_tipe": "kode_tipe_tindakan",
            "deskripsi_tipe": "deskripsi_tipe_tindakan",
            "kode_status": "kode_status_tindakan",
            "deskripsi_status": "deskripsi_status_tindakan",
            "total_biaya": "total_biaya_tindakan",
        }
    )
    return measured.select(*[_or_unknown(name) for name in FCT_TINDAKAN_MEDIS])


def _or_unknown(name: str) -> Column:
    """Surrogate keys fall back to the unknown member; other columns pass through."""
    if name.endswith("_key"):
        return F.coalesce(c(name), F.lit(-1).cast("bigint")).alias(name)
    return c(name)
