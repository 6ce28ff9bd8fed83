"""Each check on a small healthy mart and on one with a single planted fault."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from wardmart.operators import quality

HEALTHY = {
    "dim_tanggal": (
        "tanggal_key long, tanggal date, bulan int, tahun int, kuartal int, nama_hari string, "
        "nama_bulan string, is_weekend boolean, semester int",
        [
            (-1, None, None, None, None, "Unknown", "Unknown", None, None),
            (1, date(2020, 1, 1), 1, 2020, 1, "Rabu", "Januari", False, 1),
            (2, date(2020, 1, 2), 1, 2020, 1, "Kamis", "Januari", False, 1),
        ],
    ),
    "dim_pasien": (
        "pasien_key long, pat_id string, nama_lengkap string, dw_is_current boolean",
        [(-1, "UNKNOWN", "Unknown", True), (1, "P1", "A", True)],
    ),
    "dim_dokter": (
        "dokter_key long, stf_id string, dw_is_current boolean",
        [(-1, "UNKNOWN", True), (1, "S1", True)],
    ),
    "dim_departemen": (
        "departemen_key long, dep_id string, nama_departemen string",
        [(-1, "UNKNOWN", "Unknown"), (1, "D1", "Radiology")],
    ),
    "dim_ruangan": ("ruangan_key long, rom_id string", [(-1, "UNKNOWN"), (1, "R1")]),
    "fct_kunjungan": (
        "kunjungan_key long, pasien_key long, dokter_key long, ruangan_key long, departemen_key long, "
        "tanggal_masuk_key long, tanggal_keluar_key long, refr_no string, durasi_kunjungan_jam double, "
        "is_rawat_inap boolean, is_dari_appointment boolean, is_appointment_converted boolean",
        [
            (1, 1, 1, 1, 1, 1, 2, "W1", 2.5, True, True, True),
            (2, -1, -1, -1, -1, -1, -1, "W2", None, False, False, False),
        ],
    ),
    "fct_diagnosis": (
        "diagnosis_key long, pasien_key long, dokter_key long, ruangan_key long, departemen_key long, "
        "tanggal_diagnosis_key long, refr_no string, total_biaya_diagnosis decimal(15,2), "
        "is_diagnosis_utama boolean, is_confirmed boolean",
        [(1, 1, 1, 1, 1, 1, "W1", 5, True, True), (2, -1, -1, -1, -1, -1, "W9", None, False, False)],
    ),
    "fct_tindakan_medis": (
        "tindakan_key long, pasien_key long, dokter_key long, ruangan_key long, departemen_key long, "
        "tanggal_tindakan_key long, refr_no string, total_biaya_tindakan decimal(15,2), "
        "is_selesai boolean, is_operasi boolean, is_obat boolean",
        [(1, 1, 1, 1, 1, 1, "W1", 5, True, True, True), (2, -1, -1, -1, -1, -1, "W9", 1, True, False, True)],
    ),
}


def marts(spark, **changed):
    """The healthy marts; ``changed`` gives other rows for some of them."""
    tables = {}
    for name, (schema, rows) in HEALTHY.items():
        chosen = changed.get(name, rows)
        fixed = [
            tuple(Decimal(v) if "biaya" in col and v is not None else v for col, v in zip(_names(schema), row))
            for row in chosen
        ]
        tables[name] = spark.createDataFrame(fixed, schema).coalesce(1)
    return tables


def _names(schema):
    return [part.split()[0] for part in schema.replace("(15,2)", "").split(",")]


def edit(mart, row, **values):
    schema, rows = HEALTHY[mart]
    names = _names(schema)
    rows = [list(r) for r in rows]
    for column, value in values.items():
        rows[row][names.index(column)] = value
    return {mart: [tuple(r) for r in rows]}


def failing(checks):
    return {r["label"] for r in checks.where("status <> 'PASS'").collect()}


def test_healthy_marts_pass_all_50(spark):
    row = quality.summary(marts(spark)).first()
    assert row.asDict() == {
        "total": 50,
        "n_pass": 50,
        "n_warn": 0,
        "n_fail": 0,
        "status_akhir": "SEMUA CHECKS LULUS",
    }


@pytest.mark.parametrize(
    ("section", "change", "label"),
    [
        ("completeness", {"dim_ruangan": []}, "dim_ruangan tidak kosong"),
        ("uniqueness", edit("dim_pasien", 1, pasien_key=-1), "dim_pasien.pasien_key unik"),
        ("not_null", edit("dim_dokter", 1, dokter_key=None), "dim_dokter.dokter_key not null"),
        ("referential", edit("fct_kunjungan", 0, ruangan_key=77), "fct_kunjungan.ruangan_key"),
        ("referential", edit("fct_diagnosis", 0, pasien_key=None), "fct_diagnosis.pasien_key"),
        (
            "referential",
            edit("fct_tindakan_medis", 0, tanggal_tindakan_key=9),
            "fct_tindakan_medis.tanggal_tindakan_key",
        ),
        ("validity", edit("dim_tanggal", 1, bulan=13), "dim_tanggal.bulan in [1-12]"),
        ("validity", edit("dim_tanggal", 1, tahun=2028), "dim_tanggal.tahun in [2020-2027]"),
        (
            "validity",
            edit("fct_kunjungan", 0, durasi_kunjungan_jam=-0.5),
            "fct_kunjungan.durasi_kunjungan_jam >= 0",
        ),
        (
            "validity",
            edit("fct_diagnosis", 0, total_biaya_diagnosis=-1),
            "fct_diagnosis.total_biaya_diagnosis >= 0",
        ),
        (
            "validity",
            edit("fct_tindakan_medis", 0, total_biaya_tindakan=-1),
            "fct_tindakan.total_biaya_tindakan >= 0",
        ),
    ],
)
def test_a_fault_fails_its_check_and_no_other(spark, section, change, label):
    whole = {"uniqueness": quality.uniqueness, "referential": quality.referential}
    run = whole.get(section, lambda m: quality.counted(m, section))
    assert failing(run(marts(spark, **change))) == {label}


def test_one_fault_changes_the_verdict(spark):
    row = quality.summary(marts(spark, **edit("fct_kunjungan", 0, ruangan_key=77))).first()
    assert (row["total"], row["n_fail"], row["status_akhir"]) == (50, 1, "PERLU PERHATIAN")


def test_a_missing_unknown_member_only_warns(spark):
    changed = marts(spark, dim_departemen=[(1, "D1", "Radiology"), (2, "D2", "Oncology")])
    unknown = quality.counted(changed, "unknown_member")
    assert {(r["label"], r["status"]) for r in unknown.where("value = 0").collect()} == {
        ("dim_departemen punya unknown member", "WARN")
    }


def test_a_constant_flag_fails_distribution(spark):
    changed = marts(spark, **edit("fct_kunjungan", 0, is_rawat_inap=False))
    assert failing(quality.counted(changed, "distribution")) == {"fct_kunjungan rawat_inap=TRUE"}


def test_orphans_count_rows_not_values(spark):
    rows = HEALTHY["fct_kunjungan"][1]
    bad = [tuple([i, 55, *rows[0][2:]]) for i in range(10, 15)]
    changed = marts(spark, fct_kunjungan=rows + bad)
    found = quality.referential(changed).where("value > 0").collect()
    assert [(r["label"], r["value"]) for r in found] == [("fct_kunjungan.pasien_key", 5)]
    with pytest.raises(ValueError, match="fct_kunjungan.pasien_key=5"):
        quality.require_integrity(changed)


def test_integrity_holds(spark):
    quality.require_integrity(marts(spark))


def column_failures(tests):
    return {(r["mart"], r["column"]): r["failures"] for r in tests.where("status = 'fail'").collect()}


def test_there_are_75_column_tests(spark):
    m = marts(spark)
    kinds = [
        quality.column_unique,
        quality.column_not_null,
        quality.column_accepted_values,
        quality.column_relationships,
    ]
    assert [kind(m).count() for kind in kinds] == [10, 33, 16, 16]
    assert [column_failures(kind(m)) for kind in kinds] == [{}, {}, {}, {}]


@pytest.mark.parametrize(
    ("change", "kind", "place", "failures"),
    [
        (edit("dim_departemen", 1, dep_id="UNKNOWN"), "column_unique", ("dim_departemen", "dep_id"), 1),
        (edit("dim_pasien", 0, nama_lengkap=None), "column_not_null", ("dim_pasien", "nama_lengkap"), 1),
        (edit("dim_tanggal", 1, nama_hari="Hari"), "column_accepted_values", ("dim_tanggal", "nama_hari"), 1),
        (edit("dim_tanggal", 1, kuartal=5), "column_accepted_values", ("dim_tanggal", "kuartal"), 1),
        (edit("fct_kunjungan", 1, dokter_key=8), "column_relationships", ("fct_kunjungan", "dokter_key"), 1),
    ],
)
def test_a_fault_fails_its_column_test(spark, change, kind, place, failures):
    assert column_failures(getattr(quality, kind)(marts(spark, **change))) == {place: failures}


def test_null_passes_where_the_test_says_so(spark):
    m = marts(spark, **edit("fct_kunjungan", 0, is_rawat_inap=None, pasien_key=None))
    assert column_failures(quality.column_accepted_values(m)) == {}
    assert column_failures(quality.column_relationships(m)) == {}
    keys = marts(spark, dim_ruangan=[(None, "R1"), (None, "R2"), (1, "R3")])
    assert ("dim_ruangan", "ruangan_key") not in column_failures(quality.column_unique(keys))
    assert "dim_ruangan.ruangan_key unik" in failing(quality.uniqueness(keys))
