"""Appointment matching against comparing every pair, on small hand-made and random data."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from wardmart.functions.keys import with_row_id
from wardmart.operators.nearest import (
    appointments_in_reach,
    carried_over,
    events_in_time,
    nearest_appointment,
)
from wardmart.session import table_root
from wardmart.sources.store import TableStore

VISIT = "refr_no string, pat_id string, waktu_masuk timestamp_ntz, tanggal_masuk date"
APPOINTMENT = (
    "appt_refr_no string, pat_id string, waktu_appointment timestamp_ntz, tanggal_appointment date, "
    "kode_status long, deskripsi_status string, kode_tipe long, deskripsi_tipe string, is_completed boolean"
)


def visit(number, patient, at):
    return (number, patient, at, at and at.date())


def booking(number, patient, at, status="Completed"):
    return (number, patient, at, at and at.date(), 1, status, 0, "Check-up", status == "Completed")


def in_reach(v, a):
    if None in (v[1], a[1], v[2], a[2]) or v[1] != a[1]:
        return False
    return 0 <= (v[3] - a[3]).days <= 30


def brute_force(visits, bookings):
    best = {}
    for v in visits:
        for a in bookings:
            if in_reach(v, a):
                rank = (abs((v[2] - a[2]).total_seconds()), a[0] is None, a[0] or "", a[5])
                if v[0] not in best or rank < best[v[0]]:
                    best[v[0]] = rank
    return {number: (rank[0], rank[2] or None, rank[3]) for number, rank in best.items()}


@pytest.fixture
def cut_into(spark):
    """Set the number of range partitions, none of them put together afterwards."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}

    def cut(partitions):
        for name, value in zip(names, (str(partitions), "false"), strict=True):
            spark.conf.set(name, value)

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def stored_events(spark, visits, bookings):
    store = TableStore(spark, table_root(spark))
    rows = with_row_id(spark.createDataFrame(visits, VISIT))
    events = store.write("events", events_in_time(rows, spark.createDataFrame(bookings, APPOINTMENT)))
    return events, store.write("carried", carried_over(events))


def run(spark, visits, bookings):
    got = nearest_appointment(*stored_events(spark, visits, bookings)).collect()
    assert len({r["refr_no"] for r in got}) == len(got)
    return {
        r["refr_no"]: (r["jarak_detik"], r["appt_refr_no"], r["deskripsi_status_appt"]) for r in got
    }


NOON = datetime(2024, 3, 31, 12)


@pytest.mark.parametrize(
    ("offsets", "winner"),
    [
        ({"early": -timedelta(days=30, hours=12), "late": timedelta(hours=11)}, "late"),
        ({"edge": -timedelta(days=30, hours=12)}, "edge"),
        ({"too_old": -timedelta(days=30, hours=13)}, None),
        ({"next_day": timedelta(hours=12)}, None),
        ({"b": -timedelta(hours=1), "a": timedelta(hours=1)}, "a"),
        ({"b": timedelta(0), "a": timedelta(0)}, "a"),
        ({"old": -timedelta(days=31), "older": -timedelta(days=60)}, None),
    ],
)
def test_window_edges_and_ties(spark, offsets, winner):
    bookings = [booking(name, "p", NOON + delta) for name, delta in offsets.items()]
    got = run(spark, [visit("w", "p", NOON)], bookings)
    assert (got["w"][1] if got else None) == winner


def test_visits_sharing_a_number_share_the_nearest(spark):
    visits = [visit("w", "p", NOON), visit("w", "q", NOON)]
    bookings = [booking("1", "p", NOON - timedelta(hours=5)), booking("2", "q", NOON - timedelta(hours=2))]
    assert run(spark, visits, bookings)["w"][1] == "2"


def test_missing_values_do_not_match(spark):
    visits = [visit("w", None, NOON), visit("x", "p", None)]
    bookings = [booking("1", None, NOON), booking("2", "p", NOON), booking("3", "p", None)]
    assert run(spark, visits, bookings) == {}


@pytest.mark.parametrize("partitions", [1, 8, 40])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_data_with_one_hot_patient(spark, cut_into, seed, partitions):
    """A third of all visits and appointments belong to one patient; partitions cut through them."""
    draw = random.Random(seed)
    start = datetime(2024, 1, 1)

    def patient():
        return "hot" if draw.random() < 0.34 else f"p{draw.randrange(25)}"

    def moment():
        return start + timedelta(hours=draw.randrange(24 * 150))

    visits = [visit(f"w{draw.randrange(350)}", patient(), moment()) for _ in range(400)]
    bookings = [
        booking(str(draw.randrange(90)), patient(), moment(), draw.choice(["Completed", "Cancelled"]))
        for _ in range(500)
    ]
    visits += [visits[0]] * 30
    bookings += [bookings[0]] * 30
    cut_into(partitions)
    assert run(spark, visits, bookings) == brute_force(visits, bookings)


@pytest.mark.parametrize(("n_visits", "n_bookings"), [(600, 2), (3, 600), (500, 500)])
def test_one_patient_over_many_partitions(spark, cut_into, n_visits, n_bookings):
    """Hot in visits, in appointments, in both: carried over partitions without appointments too."""
    draw = random.Random(n_visits)

    def moment():
        return NOON + timedelta(minutes=draw.randrange(60 * 24 * 45))

    visits = [visit(f"w{i}", "p", moment()) for i in range(n_visits)]
    bookings = [booking(str(i), "p", moment()) for i in range(n_bookings)]
    cut_into(20)
    events, carried = stored_events(spark, visits, bookings)
    times = len({a[2] for a in bookings})
    assert events.count() == n_visits + times
    parts = [r["count"] for r in events.groupBy("_run").count().collect()]
    assert len(parts) > 10
    assert max(parts) < (n_visits + times) / 4
    assert carried.count() == len(parts)
    if n_bookings == 2:
        assert events.groupBy("_run").agg({"kind": "min"}).where("`min(kind)` = 1").count() > 5
    assert run(spark, visits, bookings) == brute_force(visits, bookings)


def test_visits_of_one_moment_are_cut_too(spark, cut_into):
    visits = [visit(f"w{i}", "p", NOON) for i in range(600)]
    bookings = [booking("1", "p", NOON - timedelta(hours=1)), booking("2", "p", NOON + timedelta(hours=2))]
    cut_into(12)
    events, _ = stored_events(spark, visits, bookings)
    assert events.select("_run").distinct().count() > 6
    assert run(spark, visits, bookings) == brute_force(visits, bookings)


def test_no_rows_at_all(spark):
    assert run(spark, [], []) == {}


def test_reach_counts_equal_the_pairs(spark):
    draw = random.Random(9)
    start = datetime(2024, 1, 1)
    visits = [
        visit(str(i), f"p{draw.randrange(6)}", start + timedelta(hours=draw.randrange(3000)))
        for i in range(200)
    ]
    bookings = [
        booking(str(i), f"p{draw.randrange(6)}", start + timedelta(hours=draw.randrange(3000)))
        for i in range(200)
    ]
    wanted = {}
    for v in visits:
        days = [a[3] for a in bookings if in_reach(v, a)]
        if days:
            seen, *_ = wanted.get((v[1], v[3]), (0,))
            wanted[v[1], v[3]] = (seen + 1, len(days), min(days), max(days), (seen + 1) * len(days))
    got = appointments_in_reach(
        spark.createDataFrame(visits, VISIT), spark.createDataFrame(bookings, APPOINTMENT)
    ).collect()
    assert {
        (r["pat_id"], r["tanggal_masuk"]): (
            r["jumlah_kunjungan"],
            r["jumlah_kandidat"],
            r["kandidat_pertama"],
            r["kandidat_terakhir"],
            r["jumlah_pasangan"],
        )
        for r in got
    } == wanted
