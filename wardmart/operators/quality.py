"""Data-quality checks over the marts, each returned as rows of a DataFrame.

All conditions on one mart are counted in one pass. Surrogate and foreign keys are
compared as bitmaps over the dense keys, so a key held by most rows (the unknown
member) is one bit when it meets its dimension.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.functions.scalar import count_where
from wardmart.operators.dimensions import DAY_NAMES, MONTH_NAMES

c = F.col
Marts = Mapping[str, DataFrame]

# Surrogate keys, foreign keys and accepted values of the marts.
SURROGATE_KEYS = {
    "dim_tanggal": "tanggal_key",
    "dim_pasien": "pasien_key",
    "dim_dokter": "dokter_key",
    "dim_departemen": "departemen_key",
    "dim_ruangan": "ruangan_key",
    "fct_kunjungan": "kunjungan_key",
    "fct_diagnosis": "diagnosis_key",
    "fct_tindakan_medis": "tindakan_key",
}
FACT_DATES = {
    "fct_kunjungan": ["tanggal_masuk_key", "tanggal_keluar_key"],
    "fct_diagnosis": ["tanggal_diagnosis_key"],
    "fct_tindakan_medis": ["tanggal_tindakan_key"],
}
NOT_NULL = {
    "dim_tanggal": ["tanggal_key"],
    "dim_pasien": ["pasien_key", "pat_id", "nama_lengkap"],
    "dim_dokter": ["dokter_key", "stf_id"],
    "dim_departemen": ["departemen_key", "dep_id", "nama_departemen"],
    "dim_ruangan": ["ruangan_key", "rom_id"],
}
UNIQUE = [*SURROGATE_KEYS.items(), ("dim_tanggal", "tanggal"), ("dim_departemen", "dep_id")]
FLAGS = {
    "dim_pasien": ["dw_is_current"],
    "dim_dokter": ["dw_is_current"],
    "fct_kunjungan": ["is_rawat_inap", "is_dari_appointment", "is_appointment_converted"],
    "fct_diagnosis": ["is_diagnosis_utama", "is_confirmed"],
    "fct_tindakan_medis": ["is_selesai", "is_operasi", "is_obat"],
}
CALENDAR_VALUES: dict[str, list[object]] = {
    "bulan": list(range(1, 13)),
    "kuartal": [1, 2, 3, 4],
    "nama_hari": DAY_NAMES,
    "nama_bulan": MONTH_NAMES,
    "is_weekend": [True, False],
    "semester": [1, 2],
}
VERDICTS = {
    "FAIL": "PERLU PERHATIAN",
    "WARN": "LULUS DENGAN PERINGATAN (normal untuk unknown member check)",
    "PASS": "SEMUA CHECKS LULUS",
}


def foreign_keys(fact: str) -> dict[str, str]:
    """Foreign key columns of a fact and the dimension each one points to."""
    shared = {
        "pasien_key": "dim_pasien",
        "dokter_key": "dim_dokter",
        "ruangan_key": "dim_ruangan",
        "departemen_key": "dim_departemen",
    }
    return shared | dict.fromkeys(FACT_DATES[fact], "dim_tanggal")


NOT_NULL |= {f: [SURROGATE_KEYS[f], *foreign_keys(f), "refr_no"] for f in FACT_DATES}


@dataclass(frozen=True)
class Check:
    """A condition counted over one mart, and how the count is judged."""

    section: str
    mart: str
    label: str
    condition: Column
    wanted: str = "zero"
    """'zero', 'some' (else FAIL) or 'some_or_warn' (else WARN)."""


def _checks() -> list[Check]:
    anything = F.lit(True)
    day = c("tanggal").isNotNull()
    month = c("bulan")
    year = c("tahun")
    checks = [
        Check("completeness", mart, f"{mart} tidak kosong", anything, "some")
        for mart in SURROGATE_KEYS
    ]
    checks += [
        Check("not_null", mart, f"{mart}.{key} not null", c(key).isNull())
        for mart, key in SURROGATE_KEYS.items()
    ]
    checks += [
        Check("validity", "dim_tanggal", "dim_tanggal.bulan in [1-12]", day & ~month.between(1, 12)),
        Check(
            "validity", "dim_tanggal", "dim_tanggal.tahun in [2020-2027]", day & ~year.between(2020, 2027)
        ),
        Check(
            "validity",
            "fct_kunjungan",
            "fct_kunjungan.durasi_kunjungan_jam >= 0",
            c("durasi_kunjungan_jam") < 0,
        ),
        Check(
            "validity",
            "fct_diagnosis",
            "fct_diagnosis.total_biaya_diagnosis >= 0",
            c("total_biaya_diagnosis") < 0,
        ),
        Check(
            "validity",
            "fct_tindakan_medis",
            "fct_tindakan.total_biaya_tindakan >= 0",
            c("total_biaya_tindakan") < 0,
        ),
    ]
    checks += [
        Check("unknown_member", mart, f"{mart} punya unknown member", c(key) == -1, "some_or_warn")
        for mart, key in SURROGATE_KEYS.items()
        if mart.startswith("dim_")
    ]
    flags = [
        ("fct_kunjungan", "fct_kunjungan rawat_inap=TRUE", c("is_rawat_inap")),
        ("fct_kunjungan", "fct_kunjungan rawat_inap=FALSE", ~c("is_rawat_inap")),
        ("fct_diagnosis", "fct_diagnosis is_confirmed=TRUE", c("is_confirmed")),
        ("fct_tindakan_medis", "fct_tindakan is_selesai=TRUE", c("is_selesai")),
        ("fct_kunjungan", "fct_kunjungan dari_appointment=TRUE", c("is_dari_appointment")),
    ]
    return checks + [Check("distribution", mart, label, on, "some") for mart, label, on in flags]


def counted(m: Marts, *sections: str) -> DataFrame:
    """(section, label, value, status) of the checks in these sections, one pass per mart."""
    chosen = [check for check in _checks() if check.section in sections]
    marts = dict.fromkeys(check.mart for check in chosen)
    return _stacked([_count_checks(m[mart], [k for k in chosen if k.mart == mart]) for mart in marts])


def _count_checks(mart: DataFrame, checks: list[Check]) -> DataFrame:
    results = F.array(
        *[
            F.struct(
                F.lit(k.section).alias("section"),
                F.lit(k.label).alias("label"),
                count_where(k.condition).alias("value"),
                F.lit(k.wanted).alias("wanted"),
            )
            for k in checks
        ]
    )
    rows = mart.agg(results.alias("results")).select(F.inline("results"))
    return rows.select("section", "label", "value", _status(c("value"), c("wanted")).alias("status"))


def _status(value: Column, wanted: Column) -> Column:
    met = F.when(wanted == "zero", value == 0).otherwise(value > 0)
    return F.when(met, "PASS").when(wanted == "some_or_warn", "WARN").otherwise("FAIL")


def used_keys(keys: DataFrame, *groups: str) -> DataFrame:
    """(*groups, word, bits, n): which values of ``key`` occur, as 64 keys a row, and their rows.

    Bits and counts combine before the shuffle, so what moves is one row per task and
    64 neighbouring keys, never a row per key. Rows without a key have word NULL.
    """
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    return keys.groupBy(*groups, F.shiftright("key", 6).alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")
    )


def uniqueness(m: Marts) -> DataFrame:
    """Rows beyond the distinct surrogate keys; NULL keys count as duplicates."""
    return _stacked(
        [
            used_keys(m[mart].select(c(key).alias("key")))
            .agg(F.coalesce(F.sum(c("n") - F.coalesce(F.bit_count("bits"), F.lit(0))), F.lit(0)).alias("value"))
            .select(
                F.lit("uniqueness").alias("section"),
                F.lit(f"{mart}.{key} unik").alias("label"),
                "value",
                _status(c("value"), F.lit("zero")).alias("status"),
            )
            for mart, key in SURROGATE_KEYS.items()
        ]
    )


def orphans(m: Marts, null_is_orphan: bool) -> DataFrame:
    """(mart, column, dimension, value): fact rows whose key is missing in its dimension."""
    return _stacked([_fact_orphans(m, fact, null_is_orphan) for fact in FACT_DATES])


def _fact_orphans(m: Marts, fact: str, null_is_orphan: bool) -> DataFrame:
    """Each key column is read on its own, and its bitmap compared with the dimension's.

    Only for words with a bit that the dimension lacks, normally none, are the fact's
    rows looked at again. Whether there are any is known before those rows are shuffled.
    """
    keys = foreign_keys(fact)
    dims = list(dict.fromkeys(keys.values()))
    rows = _stacked(
        [
            m[fact].select(F.lit(i).alias("fk"), F.lit(dims.index(dim)).alias("dim"), c(fk).alias("key"))
            for i, (fk, dim) in enumerate(keys.items())
        ]
    )
    known = _stacked(
        [m[dim].select(F.lit(j).alias("dim"), c(SURROGATE_KEYS[dim]).alias("key")) for j, dim in enumerate(dims)]
    ).where(c("key").isNotNull())
    known = used_keys(known, "dim").select("dim", "word", c("bits").alias("known"))
    used = used_keys(rows.where(c("key").isNotNull()), "fk", "dim")
    unknown = c("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
    lacking = used.join(known, ["dim", "word"], "left").select("fk", "word", unknown.alias("lacking"))
    # The NULL checks that the join would add: with them, both uses share one shuffle.
    lacking = lacking.where("lacking <> 0 and fk is not null and word is not null")
    needed = lacking.agg(F.count(F.lit(1))).scalar() > 0
    again = rows.where(needed).withColumn("word", F.shiftright("key", 6)).join(lacking, ["fk", "word"])
    missing = again.where("(lacking & shiftleft(1L, cast(key & 63 as int))) <> 0").select("fk")
    if null_is_orphan:
        missing = missing.union(rows.where(c("key").isNull()).select("fk"))
    totals = missing.groupBy("fk").agg(F.count(F.lit(1)).alias("n"))
    numbered = [(fact, fk, dim, i) for i, (fk, dim) in enumerate(keys.items())]
    listed = _listing(m[fact].sparkSession, numbered, "dimension", "fk")
    return listed.join(totals, "fk", "left").select(
        "mart", "column", "dimension", F.coalesce("n", F.lit(0)).alias("value")
    )


def referential(m: Marts) -> DataFrame:
    rows = orphans(m, null_is_orphan=True)
    return rows.select(
        F.lit("referential").alias("section"),
        F.concat_ws(".", "mart", "column").alias("label"),
        "value",
        _status(c("value"), F.lit("zero")).alias("status"),
    )


def recorded(m: Marts) -> DataFrame:
    """The 50 checks that enter the summary. Distribution is shown but not recorded."""
    sections = ("completeness", "not_null", "validity", "unknown_member")
    return _stacked([counted(m, *sections), uniqueness(m), referential(m)])


def summary(m: Marts) -> DataFrame:
    passed, warned, failed = (count_where(c("status") == s) for s in ("PASS", "WARN", "FAIL"))
    counts = recorded(m).agg(
        F.count(F.lit(1)).alias("total"),
        passed.alias("n_pass"),
        warned.alias("n_warn"),
        failed.alias("n_fail"),
    )
    verdict = (
        F.when(c("n_fail") > 0, VERDICTS["FAIL"])
        .when(c("n_warn") > 0, VERDICTS["WARN"])
        .otherwise(VERDICTS["PASS"])
    )
    return counts.withColumn("status_akhir", verdict)


def require_integrity(m: Marts) -> None:
    """Raise when any fact row points to a missing dimension row."""
    broken = referential(m).where(c("value") > 0).collect()
    if broken:
        raise ValueError("orphans: " + ", ".join(f"{r['label']}={r['value']}" for r in broken))


def fact_stats(m: Marts) -> DataFrame:
    return _stacked(
        [
            m[fact]
            .agg(F.count(F.lit(1)).alias("jumlah_baris"), count_where(c("pasien_key") == -1).alias("n"))
            .select(F.lit(fact).alias("tabel"), "jumlah_baris", c("n").alias("unknown_pasien"))
            for fact in FACT_DATES
        ]
    )


# column tests: (mart, column, failures, status)


def column_unique(m: Marts) -> DataFrame:
    """Values that occur more than once; NULL is not a value here."""
    parts = []
    for mart, column in UNIQUE:
        values = m[mart].where(c(column).isNotNull()).select(column)
        if SURROGATE_KEYS.get(mart) == column:
            # Only keys that share a word with a repeated one are counted one by one.
            repeated = used_keys(values.select(c(column).alias("key"))).where(c("n") > F.bit_count("bits")).select("word")
            values = values.withColumn("word", F.shiftright(column, 6)).join(repeated, "word", "left_semi")
        failures = values.groupBy(column).count().where(c("count") > 1).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(failures.select(F.lit(mart).alias("mart"), F.lit(column).alias("column"), "failures", _verdict()))
    return _stacked(parts)


def column_not_null(m: Marts) -> DataFrame:
    parts = []
    for mart, columns in NOT_NULL.items():
        counts = F.array(
            *[
                F.struct(
                    F.lit(mart).alias("mart"),
                    F.lit(column).alias("column"),
                    count_where(c(column).isNull()).alias("failures"),
                )
                for column in columns
            ]
        )
        rows = m[mart].agg(counts.alias("counts")).select(F.inline("counts"))
        parts.append(rows.withColumn("status", _verdict()))
    return _stacked(parts)


def column_accepted_values(m: Marts) -> DataFrame:
    """Distinct values outside the list; NULL passes. Calendar columns skip the unknown day."""
    rules = {"dim_tanggal": CALENDAR_VALUES} | {
        mart: dict.fromkeys(flags, [True, False]) for mart, flags in FLAGS.items()
    }
    return _stacked([_unaccepted(m[mart], mart, accepted) for mart, accepted in rules.items()])


def _unaccepted(table: DataFrame, mart: str, accepted: dict[str, list[object]]) -> DataFrame:
    bad = F.array(
        *[
            F.struct(
                F.lit(column).alias("column"),
                F.when(~c(column).isin(values), c(column).cast("string")).alias("bad"),
            )
            for column, values in accepted.items()
        ]
    )
    rows = table.where(c("tanggal").isNotNull()) if mart == "dim_tanggal" else table
    found = rows.select(F.inline(bad)).where(c("bad").isNotNull())
    failures = found.groupBy("column").agg(F.countDistinct("bad").alias("n"))
    listed = _listing(table.sparkSession, [(mart, column) for column in accepted])
    return _failures(listed.join(failures, "column", "left"), F.coalesce("n", F.lit(0)))


def column_relationships(m: Marts) -> DataFrame:
    """Child rows without a parent; a NULL child key passes."""
    return _failures(orphans(m, null_is_orphan=False), c("value"))


def _failures(rows: DataFrame, failures: Column) -> DataFrame:
    return rows.select("mart", "column", failures.alias("failures")).withColumn("status", _verdict())


def _verdict() -> Column:
    return F.when(c("failures") == 0, "pass").otherwise("fail").alias("status")


def _listing(spark: SparkSession, rows: list[tuple[str | int, ...]], *more: str) -> DataFrame:
    """The names a check reports on, so that a check without findings still has its row."""
    names = ("mart", "column", *more)
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
