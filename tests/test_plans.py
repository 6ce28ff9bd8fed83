"""Physical plans: no pair joins, no whole table in one task, filters and columns pushed down."""

from __future__ import annotations

import re

import pytest
from compare import files_read

from wardmart.plans.registry import QUERIES
from wardmart.plans.star import ARRIVAL_MONTH, VISITS_BY_MONTH


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_pair_joins_and_no_python(star, name):
    """No query forms all pairs of two inputs or leaves the JVM."""
    text = plan(QUERIES[name](star))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert node not in text


@pytest.mark.parametrize(
    "name", ["bq1_trend", "bq2_rank_cross", "bq3_los_all", "bq4_department_load", "bq5_conversion"]
)
def test_facts_are_reduced_before_joins(star, name):
    """The fact scan feeds a partial aggregate directly, not a join."""
    lines = plan(QUERIES[name](star)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "fct_kunjungan" in line)
    above = [re.sub(r"^[^A-Za-z*]*", "", line) for line in lines[:scan]][::-1]
    first = next(line for line in above if "Aggregate" in line or "Join" in line)
    assert "Aggregate" in first
    assert "partial" in first


def test_only_needed_columns_are_read(star):
    text = plan(QUERIES["bq2_bench"](star))
    fact = next(line for line in text.splitlines() if "fct_kunjungan" in line)
    assert "ReadSchema: struct<departemen_key:bigint>" in fact


def test_filters_reach_the_scan(star):
    text = plan(QUERIES["bq3_los_inpatient"](star))
    fact = next(line for line in text.splitlines() if "fct_kunjungan" in line)
    assert "EqualTo(is_rawat_inap,true)" in fact
    assert "IsNotNull(durasi_kunjungan_jam)" in fact


@pytest.mark.parametrize("name", ["bq1_status", "bq1_trend", "bq1_bench"])
def test_months_outside_the_window_are_not_read(star, name):
    """Visits lie in folders by month of arrival; unknown arrivals have one of their own."""
    text = plan(QUERIES[name](star))
    fact = next(line for line in text.splitlines() if "bulan_masuk" in line and "FileScan" in line)
    assert re.search(r"PartitionFilters: \[isnotnull\(bulan_masuk#\d+\), \(bulan_masuk#\d+ >= \d{6}\)\]", fact)
    assert "PushedFilters: [IsNotNull(tanggal_masuk_key)" in fact
    stored = star.table(VISITS_BY_MONTH)
    wanted = int(re.search(r"bulan_masuk#\d+ >= (\d{6})", fact)[1])
    assert 0 < files_read(stored.where(f"{ARRIVAL_MONTH} >= {wanted}")) < files_read(stored)


def test_folders_hold_the_month_of_their_rows(star):
    stored = star.table(VISITS_BY_MONTH)
    days = star.table("dim_tanggal").selectExpr("tanggal_key as tanggal_masuk_key", "tahun * 100 + bulan as month")
    wrong = stored.join(days, "tanggal_masuk_key").where(f"{ARRIVAL_MONTH} <> coalesce(month, -1)")
    assert wrong.isEmpty()
    unknown = stored.where("tanggal_masuk_key = -1").select(ARRIVAL_MONTH).distinct().collect()
    assert {row[0] for row in unknown} <= {-1}


def test_details_meet_visit_keys_without_moving_them(spark, star):
    """Visit keys are bucketed by number: only the details are shuffled to them."""
    star.build()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(star.diagnoses()).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, line in enumerate(lines) if "kunci_kunjungan_" in line and "Bucketed: true" in line)
    depth = len(re.match(r"[\s:+-]*", lines[scan])[0])
    above = []
    for line in reversed(lines[:scan]):
        at = len(re.match(r"[\s:+-]*", line)[0])
        if at < depth:
            above.append(line)
            depth = at
        if "Join" in line and at <= depth:
            break
    assert "SortMergeJoin [refr_no" in above[-1]
    assert not [line for line in above if "Exchange" in line]


def test_few_rooms_are_broadcast_by_their_count(spark, star, monkeypatch):
    """Whatever Spark's threshold in bytes; many rooms are shuffled."""
    star.build()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert re.search(r"BroadcastHashJoin \[rom_id#", plan(star.diagnoses()))
        assert re.search(r"BroadcastHashJoin \[rom_id#", plan(star.keyed_visits()))
        assert re.search(r"BroadcastHashJoin \[stf_id_dokter#", plan(star.keyed_visits()))
        monkeypatch.setattr("wardmart.plans.star.LOOKUP_ROWS", 0)
        assert re.search(r"SortMergeJoin \[rom_id#", plan(star.diagnoses()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sound_keys_are_not_looked_at_again(star):
    """Whether any key is missing is known before the rows of a fact are read again and shuffled."""
    found = QUERIES["dq_referential"](star)
    again = [line for line in plan(found).splitlines() if re.search(r"Filter .*Subquery subquery#\d+.* > 0", line)]
    assert len(again) >= 16  # the foreign keys of the three facts
    assert found.where("value > 0").isEmpty()


def test_key_checks_multiply_no_rows(star):
    """Foreign keys are compared as bitmaps: no row becomes several, no key is shuffled by itself."""
    text = plan(QUERIES["dq_referential"](star))
    generated = [line for line in text.splitlines() if "Generate" in line]
    assert all("inline([[fct_" in line for line in generated)  # the list of what is checked, nothing of a fact
    assert "partial_bit_or" in text
    assert "countdistinct" not in plan(QUERIES["dq_uniqueness"](star)).lower()


def test_previews_bound_the_key(star):
    text = plan(QUERIES["preview_fct_diagnosis"](star))
    assert "LessThanOrEqual(diagnosis_key,10)" in text


def test_top_k_limits_groups_before_the_shuffle(star):
    assert plan(QUERIES["bq4_doctor_top5"](star)).count("WindowGroupLimit") == 2


def test_first_doctor_combines_before_the_shuffle(star):
    text = plan(QUERIES["join_left_ranked"](star))
    assert "partial_min" in text
    assert "Window" not in text


def test_nearest_match_sorts_once(star):
    text = plan(QUERIES["join_nearest_match"](star))
    assert len(re.findall(r"Window \[", text)) == 1

