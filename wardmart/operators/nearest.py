"""Matching visits with the appointments of the previous 30 days.

Both operators take time proportional to the rows, never to the pairs: no pair
of a visit and an appointment is formed that is not a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.functions.keys import ROW_ID
from wardmart.functions.scalar import elapsed_seconds, nulls_last

c = F.col

DAYS = 30
RUN = "_run"

PAYLOAD = [
    "appt_refr_no",
    "kode_status_appt",
    "deskripsi_status_appt",
    "kode_tipe_appt",
    "deskripsi_tipe_appt",
    "is_appointment_completed",
]


def events_in_time(visits: DataFrame, appointments: DataFrame) -> DataFrame:
    """Visits and appointment times in one order: patient, time, appointments first.

    One row per visit and one per time at which a patient has appointments, never more.
    Range partitions may cut anywhere, also within a patient or among visits of one
    moment (then by row id), so no patient is too large for a task. ``_run`` numbers the
    partitions. Store the result before using it: range bounds come from a sample, and
    only a written table has one order for all that read it.
    """
    rows = visits.where(c("pat_id").isNotNull() & c("waktu_masuk").isNotNull())
    visit_events = rows.select(
        "pat_id", c("waktu_masuk").alias("at"), F.lit(1).alias("kind"), ROW_ID, "refr_no"
    )
    appointment_events = _one_per_moment(appointments).select(
        "pat_id",
        c("waktu_appointment").alias("at"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias(ROW_ID),
        F.struct("best", "waktu_appointment").alias("appointment"),
    )
    order = ["pat_id", "at", "kind", ROW_ID]
    events = visit_events.unionByName(appointment_events, allowMissingColumns=True)
    ordered = events.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.drop(ROW_ID).withColumn(RUN, F.spark_partition_id())


def carried_over(events: DataFrame) -> DataFrame:
    """(_run, pat_id, came, comes): what patients cut by a partition border have beyond it.

    ``came`` is the last appointment in earlier partitions, ``comes`` the first in later
    ones. A border cuts one patient at most, so there are less than two rows per
    partition, and a partition without appointments hands over what it was given.
    """
    reach = events.groupBy("pat_id").agg(F.min(RUN).alias("low"), F.max(RUN).alias("high"))
    cut = reach.where("low < high").select("pat_id")
    booked = F.when(c("kind") == 0, c("appointment"))
    ends = (
        events.join(cut, "pat_id", "left_semi")
        .groupBy(RUN, "pat_id")
        .agg(F.min_by(booked, _booked_at()).alias("first"), F.max_by(booked, _booked_at()).alias("last"))
    )
    by_run = Window.partitionBy("pat_id").orderBy(RUN)
    earlier = by_run.rowsBetween(Window.unboundedPreceding, -1)
    later = by_run.rowsBetween(1, Window.unboundedFollowing)
    return ends.select(
        RUN,
        "pat_id",
        F.last("last", ignorenulls=True).over(earlier).alias("came"),
        F.first("first", ignorenulls=True).over(later).alias("comes"),
    )


def nearest_appointment(events: DataFrame, carried: DataFrame) -> DataFrame:
    """One row per matched visit number: the appointment nearest in time, and how near.

    Candidates have the same patient and a date within [visit date - 30, visit
    date]; nearness counts in time, so one later on the visit's own day can win.
    Ties go to the lowest appointment number, then to its other columns.

    The nearest one is either the last at or before the visit or the first after
    it. One pass over a patient's events in a partition gives both to every visit;
    where the patient goes on beyond the partition, ``carried`` has them. Both inputs
    are the stored results of ``events_in_time`` and ``carried_over``.
    """
    in_time = Window.partitionBy(RUN, "pat_id").orderBy("at", "kind")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.expr(
        f"lead(appointment, 1) ignore nulls over (partition by {RUN}, pat_id order by at, kind)"
    )
    matched = (
        events.withColumn("before", F.last("appointment", ignorenulls=True).over(so_far))
        .withColumn("after", following)
        .where(c("kind") == 1)
        .join(carried, [RUN, "pat_id"], "left")
        .withColumn("before", F.coalesce("before", "came"))
        .withColumn("after", F.coalesce("after", "comes"))
        .select("refr_no", F.least(_candidate("before"), _candidate("after")).alias("nearest"))
        .where(c("nearest").isNotNull())
        .groupBy("refr_no")
        .agg(F.min("nearest").alias("nearest"))
    )
    return matched.select(
        "refr_no",
        c("nearest.jarak_detik").cast("double").alias("jarak_detik"),
        c("nearest.waktu_appointment").alias("waktu_appointment"),
        *[c(f"nearest.best.{p}").alias(p) for p in PAYLOAD],
    )


def appointments_in_reach(visits: DataFrame, appointments: DataFrame) -> DataFrame:
    """Per patient and visit day: visits, and appointments within the 30 days up to it.

    The size of the interval join without its rows: visits and appointments are counted
    together per patient and day, so a patient has at most one row per calendar day when
    the 30-day range frame slides over them.
    """
    seen = visits.select("pat_id", c("tanggal_masuk").alias("hari"), F.lit(True).alias("kunjungan"))
    booked = appointments.select(
        "pat_id", c("tanggal_appointment").alias("hari"), F.lit(False).alias("kunjungan")
    )
    daily = (
        seen.union(booked)
        .where(c("pat_id").isNotNull() & c("hari").isNotNull())
        .groupBy("pat_id", "hari")
        .agg(
            F.count_if("kunjungan").alias("jumlah_kunjungan"),
            F.count_if(~c("kunjungan")).alias("n_appt"),
        )
    )
    reach = Window.partitionBy("pat_id").orderBy(F.unix_date("hari")).rangeBetween(-DAYS, 0)
    booked_day = F.when(c("n_appt") > 0, c("hari"))
    return (
        daily.select(
            "pat_id",
            c("hari").alias("tanggal_masuk"),
            "jumlah_kunjungan",
            F.sum("n_appt").over(reach).alias("jumlah_kandidat"),
            F.min(booked_day).over(reach).alias("kandidat_pertama"),
            F.max(booked_day).over(reach).alias("kandidat_terakhir"),
        )
        .where((c("jumlah_kunjungan") > 0) & (c("jumlah_kandidat") > 0))
        .withColumn("jumlah_pasangan", c("jumlah_kunjungan") * c("jumlah_kandidat"))
    )


def _booked_at() -> Column:
    return F.when(c("kind") == 0, c("at"))


def _one_per_moment(appointments: DataFrame) -> DataFrame:
    """Of a patient's appointments at the same moment only the tie winner can be nearest.

    Combined before the shuffle.
    """
    named = appointments.select(
        "pat_id",
        "waktu_appointment",
        "appt_refr_no",
        c("kode_status").alias("kode_status_appt"),
        c("deskripsi_status").alias("deskripsi_status_appt"),
        c("kode_tipe").alias("kode_tipe_appt"),
        c("deskripsi_tipe").alias("deskripsi_tipe_appt"),
        c("is_completed").alias("is_appointment_completed"),
    )
    fields = [
        field.alias(p if i else f"no_{p}")
        for p in PAYLOAD
        for i, field in enumerate(nulls_last(c(p)))
    ]
    return (
        named.where(c("pat_id").isNotNull() & c("waktu_appointment").isNotNull())
        .groupBy("pat_id", "waktu_appointment")
        .agg(F.min(F.struct(*fields)).alias("best"))
    )


def _candidate(side: str) -> Column:
    """(distance, tie-break) of a neighbour in reach of the visit, NULL when it is not."""
    moment = c(f"{side}.waktu_appointment")
    days = F.datediff(c("at"), moment)
    distance = F.abs(elapsed_seconds(c("at"), moment)).alias("jarak_detik")
    return F.when(
        days.between(0, DAYS),
        F.struct(distance, c(f"{side}.best").alias("best"), moment.alias("waktu_appointment")),
    )
