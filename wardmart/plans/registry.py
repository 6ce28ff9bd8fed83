"""Every query by name, as a function of the warehouse it runs on."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.functions.keys import ROW_ID
from wardmart.functions.skew import hot_keys
from wardmart.operators import quality
from wardmart.operators.intermediate import int_kunjungan_enriched
from wardmart.plans import business, dashboard, report, steps
from wardmart.plans.layers import listed_rows
from wardmart.plans.star import LOAD_COLUMNS, Star
from wardmart.sources.ingest import row_counts


STAGING = (
    "stg_pasien",
    "stg_kunjungan",
    "stg_appointment",
    "stg_diagnosis",
    "stg_tindakan_medis",
    "stg_staff_dokter",
    "stg_departemen",
    "stg_ruangan",
    "stg_tim_medis",
    "stg_asuransi",
)

INTERMEDIATE = (
    "int_pasien_dengan_asuransi",
    "int_dokter_per_kunjungan",
    "int_kunjungan_enriched",
)


def _staging(name: str, star: Star) -> DataFrame:
    return star.staging(name).drop(*LOAD_COLUMNS)


def _mart(name: str, star: Star) -> DataFrame:
    """A stored mart without its load times, which differ from run to run."""
    return star.table(name).drop(*LOAD_COLUMNS)


def _on_marts(query: Callable[..., DataFrame], *args: object) -> Callable[[Star], DataFrame]:
    return lambda star: query(star, *args)


def _enriched(star: Star) -> DataFrame:
    visits = star.visits_with_doctor()
    hot = hot_keys(star.staging("stg_kunjungan"), "refr_no", star.rows_per_task)
    return int_kunjungan_enriched(visits, star.nearest_appointments(), hot).drop(ROW_ID)


QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    # scans and sources
    "ingest_csv_dropmalformed": steps.ingest_csv,
    "raw_diag_union": steps.raw_diag_union,
    "source_presence": steps.source_presence,
    "raw_row_counts": lambda star: row_counts(star.raw),
    "calendar_series": steps.calendar_series,
    "catalog_listing": listed_rows,
    "mart_row_counts": _on_marts(report.mart_row_counts),
    "adhoc_sql_marts": lambda star: star.sql(steps.ADHOC_SQL),
    "preview_dim_tanggal": _on_marts(report.preview_visit_days),
    "preview_dim_pasien": _on_marts(report.preview, "dim_pasien"),
    "preview_dim_dokter": _on_marts(report.preview_all, "dim_dokter"),
    "preview_dim_departemen": _on_marts(report.preview_all, "dim_departemen"),
    "preview_dim_ruangan": _on_marts(report.preview, "dim_ruangan"),
    "preview_fct_kunjungan": _on_marts(report.preview, "fct_kunjungan"),
    "preview_fct_diagnosis": _on_marts(report.preview, "fct_diagnosis"),
    "preview_fct_tindakan": _on_marts(report.preview, "fct_tindakan_medis"),
    # staging
    **{name: partial(_staging, name) for name in STAGING},
    # intermediate
    "int_pasien_dengan_asuransi": lambda star: star.insured_patients().drop(ROW_ID),
    "int_dokter_per_kunjungan": lambda star: star.visits_with_doctor().drop(ROW_ID),
    "int_kunjungan_enriched": _enriched,
    # dimensions and facts
    "dim_tanggal": _on_marts(report.calendar_use),
    **{
        name: partial(_mart, name)
        for name in (
            "dim_pasien",
            "dim_dokter",
            "dim_departemen",
            "dim_ruangan",
            "fct_kunjungan",
            "fct_diagnosis",
            "fct_tindakan_medis",
        )
    },
    # predicates
    "filter_not_null": steps.filter_not_null,
    "like_predicate": steps.like_predicate,
    "filter_last_12_months": lambda star: steps.filter_last_12_months(star, star.as_of),
    "scalar_subquery_month_window": steps.scalar_subquery_month_window,
    # joins
    "join_left_ranked": steps.join_left_ranked,
    "join_interval_30d": steps.join_interval_30d,
    "join_nearest_match": steps.join_nearest_match,
    "join_star_lookup": steps.join_star_lookup,
    "join_role_playing_date": steps.join_role_playing_date,
    "join_fallback_lookup": steps.join_fallback_lookup,
    "anti_join_orphans": steps.anti_join_orphans,
    # aggregates and windows
    "agg_conditional_sum": steps.agg_conditional_sum,
    "agg_count_distinct": steps.agg_count_distinct,
    "window_row_number_pick": steps.window_row_number_pick,
    "surrogate_key_dense": steps.surrogate_key_dense,
    "window_rank_global": steps.window_rank_global,
    "window_rank_partitioned": steps.window_rank_partitioned,
    "window_sum_over_all": steps.window_sum_over_all,
    # top-k and set operations
    "topk_dept_diagnosis": _on_marts(report.topk_dept_diagnosis),
    "topk_per_group": steps.topk_per_group,
    "union_unknown_member": steps.union_unknown_member,
    # scalar functions
    "scalar_strings": steps.scalar_strings,
    "scalar_dates": lambda star: steps.scalar_dates(star, star.as_of),
    "scalar_casts": steps.scalar_casts,
    "scalar_math": steps.scalar_math,
    # business questions
    "bq1_status": lambda star: business.bq1_status(star, star.as_of),
    "bq1_trend": lambda star: business.bq1_trend(star, star.as_of),
    "bq1_data_window": _on_marts(business.bq1_data_window),
    "bq1_bench": lambda star: business.bq1_bench(star, star.as_of),
    "bq2_rank_cross": _on_marts(business.bq2_rank_cross),
    "bq2_rank_window": _on_marts(business.bq2_rank_window),
    "bq2_rank_desc": _on_marts(business.bq2_rank_desc),
    "bq2_bench": _on_marts(business.bq2_bench),
    "bq3_los_inpatient": _on_marts(business.bq3_los_inpatient),
    "bq3_los_days": _on_marts(business.bq3_los_days),
    "bq3_los_all": _on_marts(business.bq3_los_all),
    "bq3_bench": _on_marts(business.bq3_bench),
    "bq4_doctor_status": _on_marts(business.bq4_doctor_status),
    "bq4_doctor_top5": _on_marts(business.bq4_doctor_top5),
    "bq4_department_load": _on_marts(business.bq4_department_load),
    "bq4_bench": _on_marts(business.bq4_bench),
    "bq5_conversion": _on_marts(business.bq5_conversion),
    "bq5_conversion_guard": _on_marts(business.bq5_conversion_guard),
    "bq5_conversion_full": _on_marts(business.bq5_conversion_full),
    "bq5_overall": _on_marts(business.bq5_overall),
    # dashboard datasets
    "chart_bq1_line": _on_marts(dashboard.chart_bq1_line),
    "chart_bq1_stacked": _on_marts(dashboard.chart_bq1_stacked),
    "chart_bq2_top10": _on_marts(dashboard.chart_bq2_top10),
    "chart_bq3_table": _on_marts(dashboard.chart_bq3_table),
    "chart_bq4_table": _on_marts(dashboard.chart_bq4_table),
    "chart_bq4_heatmap": _on_marts(dashboard.chart_bq4_heatmap),
    "chart_bq4_heatmap_wide": _on_marts(dashboard.chart_bq4_heatmap_wide),
    "chart_bq5_line": _on_marts(dashboard.chart_bq5_line),
    # quality
    "dq_completeness": _on_marts(quality.counted, "completeness"),
    "dq_uniqueness": _on_marts(quality.uniqueness),
    "dq_not_null": _on_marts(quality.counted, "not_null"),
    "dq_referential": _on_marts(quality.referential),
    "dq_validity": _on_marts(quality.counted, "validity"),
    "dq_unknown_member": _on_marts(quality.counted, "unknown_member"),
    "dq_distribution": _on_marts(quality.counted, "distribution"),
    "dq_summary": _on_marts(quality.summary),
    "ri_fact_stats": _on_marts(quality.fact_stats),
    "dbt_unique": _on_marts(quality.column_unique),
    "dbt_not_null": _on_marts(quality.column_not_null),
    "dbt_accepted_values": _on_marts(quality.column_accepted_values),
    "dbt_relationships": _on_marts(quality.column_relationships),
    # report
    "report_date_range": _on_marts(report.report_date_range),
    "report_visit_split": _on_marts(report.report_visit_split),
    "report_status_distribution": _on_marts(report.report_status_distribution),
    "report_entity_counts": _on_marts(report.report_entity_counts),
    "report_diagnosis_summary": _on_marts(report.report_diagnosis_summary),
    "report_treatment_summary": _on_marts(report.report_treatment_summary),
}
