"""One DuckDB statement per registered query, over the tables of ``oracle.models``."""

from __future__ import annotations

from wardmart.operators.dimensions import MONTH_NAMES
from wardmart.operators.quality import (
    CALENDAR_VALUES,
    FACT_DATES,
    FLAGS,
    NOT_NULL,
    SURROGATE_KEYS,
    UNIQUE,
    VERDICTS,
    foreign_keys,
)
from wardmart.plans.report import PREVIEW_COLUMNS
from wardmart.plans.steps import ADHOC_SQL
from wardmart.sources.projections import AS_OF, RAW_SQL

A_YEAR_AGO = f"date '{AS_OF}' - interval 12 month"
ARRIVALS = "fct_kunjungan k join dim_tanggal t on t.tanggal_key = k.tanggal_masuk_key and t.tanggal is not null"
DEPARTMENTS = "fct_kunjungan k join dim_departemen d on d.departemen_key = k.departemen_key and d.dep_id <> 'UNKNOWN'"
DOCTORS = "join dim_dokter d on d.dokter_key = k.dokter_key and d.dokter_key > 0"
BY_MONTH = "group by t.tahun, t.bulan, t.nama_bulan"
MONTH = "t.tahun, t.bulan, t.nama_bulan"


def _n(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# scans

_VISIT_COLUMNS = (
    "REFR_NO, PAT_ID, MEDT_ID, VIS_EN, VIS_EX, VSTAT_CD, VSTAT_DES, VTYPE_CD, VTYPE_DES, ROM_ID"
)
_ROOM = "try_cast(substr(ROM_ID, 2, 5) as integer)"

SCANS = {
    "ingest_csv_dropmalformed": f"""
select {_VISIT_COLUMNS} from stg_ehp__vist
where ({_ROOM} % 50 = 7) is not true and ({_ROOM} % 70 = 9) is not true""",
    "raw_diag_union": "select * from stg_ehp__diag",
    "raw_row_counts": "select table_name, count(*) as row_count from ("
    + _union([f"select '{name}' as table_name from {name}" for name in [*RAW_SQL, "stg_ehp__diag"]])
    + ") group by table_name union all select 'TOTAL', "
    + " + ".join(f"(select count(*) from {name})" for name in [*RAW_SQL, "stg_ehp__diag"]),
    "source_presence": _union(
        [
            f"select '{name}' as table_name, cast({1 + (name == 'stg_ehp__diag')} as bigint) as n_files, "
            f"count(*) as row_count from {name}"
            for name in [*RAW_SQL, "stg_ehp__diag"]
        ]
    ),
    "catalog_listing": _union(
        [
            f"select 'analytics_marts' as layer, '{mart}' as table_name, count(*) as row_count from {mart}"
            for mart in SURROGATE_KEYS
        ]
    ),
    "calendar_series": """
select h.tanggal, count(v.refr_no) as jumlah_kunjungan
from hari_kalender h left join stg_kunjungan v on v.tanggal_masuk = h.tanggal group by h.tanggal""",
    "mart_row_counts": _union(
        [
            f"select '{mart[:3].upper()}' as layer, '{mart}' as table_name, count(*) as row_count from {mart}"
            for mart in SURROGATE_KEYS
        ]
    )
    + " union all select 'TOTAL', 'TOTAL', "
    + " + ".join(f"(select count(*) from {mart})" for mart in SURROGATE_KEYS),
    "adhoc_sql_marts": ADHOC_SQL,
    "preview_dim_tanggal": f"""
select {", ".join(PREVIEW_COLUMNS["dim_tanggal"])},
       (select count(*) from fct_kunjungan f where f.tanggal_masuk_key = t.tanggal_key) as jumlah_kunjungan
from dim_tanggal t where tanggal_key <> -1 order by tanggal_key limit 10""",
    "preview_dim_departemen": "select * from dim_departemen where departemen_key <> -1",
}
for _key, _mart, _limit in [
    ("preview_dim_pasien", "dim_pasien", "limit 10"),
    ("preview_dim_dokter", "dim_dokter", ""),
    ("preview_dim_ruangan", "dim_ruangan", "limit 10"),
    ("preview_fct_kunjungan", "fct_kunjungan", "limit 10"),
    ("preview_fct_diagnosis", "fct_diagnosis", "limit 10"),
    ("preview_fct_tindakan", "fct_tindakan_medis", "limit 10"),
]:
    SCANS[_key] = (
        f"select {', '.join(PREVIEW_COLUMNS[_mart])} from {_mart} "
        f"where {SURROGATE_KEYS[_mart]} <> -1 order by {SURROGATE_KEYS[_mart]} {_limit}"
    )

# models

TABLE_KEYS = {
    name: f"select * from {name}"
    for name in (
        "stg_pasien", "stg_kunjungan", "stg_appointment", "stg_diagnosis", "stg_tindakan_medis",
        "stg_staff_dokter", "stg_departemen", "stg_ruangan", "stg_tim_medis", "stg_asuransi",
        "int_pasien_dengan_asuransi", "int_dokter_per_kunjungan", "int_kunjungan_enriched",
        "dim_pasien", "dim_dokter", "dim_departemen", "dim_ruangan",
        "fct_kunjungan", "fct_diagnosis", "fct_tindakan_medis",
    )
} | {
    "dim_tanggal": """
select t.*, (select count(*) from fct_kunjungan k where k.tanggal_masuk_key = t.tanggal_key) as jumlah_kunjungan
from dim_tanggal t"""
}

# single operators

STEPS = {
    "filter_not_null": "select refr_no, medt_id, rom_id from stg_kunjungan where rom_id is not null",
    "like_predicate": """
select refr_no, urutan_diagnosis, kode_diagnosis, deskripsi_status from stg_diagnosis
where deskripsi_status like '%Confirmed%'""",
    "filter_last_12_months": f"""
select refr_no, pat_id, tanggal_masuk from stg_kunjungan where tanggal_masuk >= {A_YEAR_AGO}""",
    "scalar_subquery_month_window": """
select (year(tanggal_masuk) * 100 + month(tanggal_masuk))::int as periode, count(*) as total_kunjungan
from stg_kunjungan
where year(tanggal_masuk) * 100 + month(tanggal_masuk)
      >= (select max(year(tanggal_masuk)) * 100 + max(month(tanggal_masuk)) - 11 from stg_kunjungan)
group by 1""",
    "join_left_ranked": """
select v.refr_no, v.medt_id, d.stf_id from stg_kunjungan v
left join (select medt_id, stf_id, row_number() over (partition by medt_id order by stf_id) as rn
           from stg_tim_medis where is_dokter) d on d.medt_id = v.medt_id and d.rn = 1""",
    "join_interval_30d": """
select pat_id, tanggal_masuk, count(distinct refr_no || ' ' || medt_id) as jumlah_kunjungan,
       count(*) // count(distinct refr_no || ' ' || medt_id) as jumlah_kandidat,
       min(tanggal_appointment) as kandidat_pertama, max(tanggal_appointment) as kandidat_terakhir,
       count(*) as jumlah_pasangan
from (select v.pat_id, v.tanggal_masuk, v.refr_no, v.medt_id, a.tanggal_appointment
      from stg_kunjungan v join stg_appointment a on a.pat_id = v.pat_id
      and a.tanggal_appointment between v.tanggal_masuk - interval 30 day and v.tanggal_masuk)
group by pat_id, tanggal_masuk""",
    "join_nearest_match": """
select refr_no, jarak_detik, waktu_appointment, appt_refr_no, kode_status_appt, deskripsi_status_appt,
       kode_tipe_appt, deskripsi_tipe_appt, is_appointment_completed from janji_terdekat""",
    "join_star_lookup": """
select refr_no, medt_id, pasien_key, dokter_key, ruangan_key, departemen_key, tanggal_masuk_key
from fct_kunjungan""",
    "join_role_playing_date": """
select strftime(m.tanggal, '%Y-%m') as periode_masuk, strftime(x.tanggal, '%Y-%m') as periode_keluar,
       count(*) as total_kunjungan
from fct_kunjungan k join hari_kalender m on m.tanggal_key = k.tanggal_masuk_key
join hari_kalender x on x.tanggal_key = k.tanggal_keluar_key group by 1, 2""",
    "join_fallback_lookup": """
select g.refr_no, g.urutan_diagnosis, g.kode_diagnosis, g.waktu_diagnosis,
       coalesce(own.ruangan_key, seen.ruangan_key, -1) as ruangan_key,
       coalesce(own.departemen_key, seen.departemen_key, -1) as departemen_key
from stg_diagnosis g left join stg_kunjungan v on v.refr_no = g.refr_no
left join kamar own on own.rom_id = g.rom_id left join kamar seen on seen.rom_id = v.rom_id""",
    "anti_join_orphans": _union(
        [
            f"""select '{label}' as hubungan, count(*) as jumlah_yatim from {child} f
left join (select distinct {key} from {parent}) p on p.{key} = f.{reference} where p.{key} is null"""
            for label, child, reference, parent, key in [
                ("kunjungan-pasien", "stg_kunjungan", "pat_id", "stg_pasien", "pat_id"),
                ("kunjungan-ruangan", "stg_kunjungan", "rom_id", "stg_ruangan", "rom_id"),
                ("diagnosis-kunjungan", "stg_diagnosis", "refr_no", "stg_kunjungan", "refr_no"),
                ("dokter-departemen", "stg_staff_dokter", "dep_id", "stg_departemen", "dep_id"),
            ]
        ]
    ),
    "agg_conditional_sum": f"""
select deskripsi_tipe, count(*) as total, {_n("is_selesai")} as selesai,
       {_n("not is_selesai")} as belum_selesai, sum(total_biaya)::decimal(25,2) as total_biaya
from stg_tindakan_medis group by 1""",
    "agg_count_distinct": """
select deskripsi_status, count(*) as total, count(distinct refr_no) as kunjungan_dengan_diagnosis
from stg_diagnosis group by 1""",
    "window_row_number_pick": """
select pat_id, jenis_penjamin, nama_asuransi, is_aktif as asuransi_aktif from polis_terpilih""",
    "surrogate_key_dense": """
select row_number() over (order by medt_id, nomor_tim, stf_id, kode_peran, deskripsi_peran) as anggota_key,
       medt_id, nomor_tim, stf_id, kode_peran, deskripsi_peran from stg_tim_medis""",
    "window_rank_global": """
select kode_diagnosis, count(*) as total, rank() over (order by count(*) desc)::int as rank_tertinggi,
       rank() over (order by count(*))::int as rank_terendah from stg_diagnosis group by 1""",
    "window_rank_partitioned": """
select year(tanggal_masuk)::int as tahun, deskripsi_tipe, deskripsi_status, count(*) as total,
       rank() over (partition by year(tanggal_masuk) order by count(*) desc)::int as peringkat
from stg_kunjungan group by year(tanggal_masuk), deskripsi_tipe, deskripsi_status""",
    "window_sum_over_all": """
select deskripsi_status, count(*) as total, round(count(*) * 100.0 / sum(count(*)) over (), 1) as persentase
from stg_kunjungan group by 1""",
    "topk_per_group": """
select deskripsi_peran, stf_id, count(*) as total,
       rank() over (partition by deskripsi_peran order by count(*) desc)::int as peringkat
from stg_tim_medis group by 1, 2 qualify peringkat <= 5""",
    "union_unknown_member": """
select 'UNKNOWN' as stf_id, 'Unknown' as nama_lengkap, null::decimal(15,2) as gaji_tahunan
union all select stf_id, nama_lengkap, gaji_tahunan from stg_staff_dokter""",
    "scalar_strings": """
select PAT_ID as pat_id, trim(F_NAME) as dipangkas, coalesce(M_NAME, '-') as tengah,
       F_NAME || ' ' || L_NAME as gabungan, split_part(F_NAME, '#', 2) as setelah_pagar,
       split_part(F_NAME, '#', 3) as di_luar, lpad(GEN_CD::varchar, 2, '0') as kode_dua_digit
from stg_ehp__patn""",
    "scalar_dates": f"""
select tanggal_masuk, count(*) as total, extract(day from tanggal_masuk)::int as hari,
       extract(month from tanggal_masuk)::int as bulan, extract(year from tanggal_masuk)::int as tahun,
       extract(quarter from tanggal_masuk)::int as kuartal, extract(week from tanggal_masuk)::int as minggu,
       extract(dayofweek from tanggal_masuk)::int as hari_ke, extract(dayofyear from tanggal_masuk)::int as hari_dalam_tahun,
       if(extract(month from tanggal_masuk) < 7, 1, 2)::int as semester,
       (tanggal_masuk - interval 30 day)::date as tiga_puluh_hari_sebelum,
       tanggal_masuk >= {A_YEAR_AGO} as dalam_12_bulan, strftime(tanggal_masuk, '%Y-%m') as periode
from stg_kunjungan group by tanggal_masuk""",
    "scalar_casts": """
select STF_ID as stf_id, try_cast(HIRE_DATE as date) as tanggal_masuk, try_cast(ROLE_DATE as date) as tanggal_peran,
       try_cast(substr(STF_ID, 2, 5) as integer) as nomor, try_cast(HIRE_DATE as integer) as bukan_angka,
       try_cast(SAL_YR as decimal(15,2)) as gaji, SAL_YR::decimal(18,3) as gaji_lebar,
       try_cast(DT_BRT as timestamp) as lahir, ROLE_CD::varchar as kode
from stg_ehp__stff""",
    "scalar_math": """
select refr_no, medt_id, epoch(waktu_keluar) - epoch(waktu_masuk) as detik,
       abs(epoch(waktu_masuk) - epoch(waktu_keluar)) as jarak,
       round((epoch(waktu_keluar) - epoch(waktu_masuk))::decimal(18,3) / 3600.0, 2) as jam,
       round(kode_status * 100.0 / nullif(kode_tipe, 0), 1) as rasio,
       (year(waktu_masuk) * 100 + month(waktu_masuk))::int as periode, jam_masuk
from stg_kunjungan""",
}

# business questions

_IN_OUT = f"{_n('k.is_rawat_inap')} as {{0}}, {_n('not k.is_rawat_inap')} as {{1}}"
_STAY = "round({0}(k.durasi_kunjungan_jam), {1})"
_DATA_WINDOW = f"""
select {MONTH}, format('{{}}-{{:02d}}', t.tahun, t.bulan) as periode, count(*) as total_kunjungan,
       {_IN_OUT.format("rawat_inap", "rawat_jalan")}
from {ARRIVALS} where t.tahun * 100 + t.bulan
      >= (select max(t.tahun) * 100 + max(t.bulan) - 11 from {ARRIVALS})
{BY_MONTH}"""
_LOS_ALL = f"""
select d.nama_departemen, count(*) as total_kunjungan, {_STAY.format("avg", 2)} as avg_los_jam,
       {_STAY.format("min", 2)} as min_los_jam, {_STAY.format("max", 2)} as max_los_jam,
       {_IN_OUT.format("total_rawat_inap", "total_rawat_jalan")}
from {DEPARTMENTS} where k.durasi_kunjungan_jam is not null group by d.nama_departemen"""
_DEPARTMENT_LOAD = f"""
select {MONTH}, d.nama_departemen, count(*) as total_kunjungan,
       {_IN_OUT.format("rawat_inap", "rawat_jalan")},
       rank() over (partition by t.tahun, t.bulan order by count(*) desc)::int as rank_departemen
from {ARRIVALS} join dim_departemen d on d.departemen_key = k.departemen_key and d.dep_id <> 'UNKNOWN'
{BY_MONTH}, d.nama_departemen"""
_CONVERSION_FULL = f"""
select {MONTH}, format('{{}}-{{:02d}}', t.tahun, t.bulan) as periode, count(*) as total_dari_appointment,
       {_n("k.is_appointment_converted")} as total_converted,
       {_n("not k.is_appointment_converted")} as total_tidak_converted,
       round({_n("k.is_appointment_converted")} * 100.0 / count(*), 2) as conversion_rate_persen
from {ARRIVALS} where k.is_dari_appointment {BY_MONTH}"""
_RANK_CROSS = f"""
select nama_departemen, n as total_kunjungan,
       round(n * 100.0 / (select sum(n) from per_dept), 2) as persentase_dari_total,
       rank() over (order by n desc)::int as rank_tertinggi{{0}}
from per_dept"""
_PER_DEPT = f"(select d.nama_departemen, count(*) as n from {DEPARTMENTS} group by 1)"


def _ranked(extra: str) -> str:
    return _RANK_CROSS.format(extra).replace("per_dept", _PER_DEPT)


def _top_doctors(columns: str, names: str, where: str, limit: str) -> str:
    return f"""
select {columns} from (
  select {MONTH}, {names}, count(*) as n,
         rank() over (partition by t.tahun, t.bulan order by count(*) desc)::int as r
  from {ARRIVALS} {DOCTORS} {where} {BY_MONTH}, {names})
where r <= 5 order by tahun, bulan, n desc, nama_lengkap nulls last {limit}"""


BUSINESS = {
    "bq1_status": f"""
select {MONTH}, count(*) as total_kunjungan, {_IN_OUT.format("total_rawat_inap", "total_rawat_jalan")}
from {ARRIVALS} where k.kode_status_kunjungan = 1 and t.tanggal >= {A_YEAR_AGO} {BY_MONTH}""",
    "bq1_trend": f"""
select {MONTH}, count(*) as total_kunjungan, {_IN_OUT.format("total_rawat_inap", "total_rawat_jalan")},
       round({_n("k.is_rawat_inap")} * 100.0 / count(*), 1) as pct_rawat_inap
from {ARRIVALS} where t.tanggal >= {A_YEAR_AGO} {BY_MONTH}""",
    "bq1_data_window": _DATA_WINDOW,
    "bq1_bench": f"""
select {MONTH}, count(*) as total, {_IN_OUT.format("rawat_inap", "rawat_jalan")}
from {ARRIVALS} where t.tanggal >= {A_YEAR_AGO} {BY_MONTH}""",
    "bq2_rank_cross": _ranked(", rank() over (order by n)::int as rank_terendah"),
    "bq2_rank_window": f"""
select d.nama_departemen, count(*) as total_kunjungan,
       round(count(*) * 100.0 / sum(count(*)) over (), 1) as persentase,
       rank() over (order by count(*) desc)::int as rank_tertinggi,
       rank() over (order by count(*))::int as rank_terendah
from {DEPARTMENTS} group by d.nama_departemen""",
    "bq2_rank_desc": _ranked(""),
    "bq2_bench": f"select d.nama_departemen, count(*) as total from {DEPARTMENTS} group by 1",
    "bq3_los_inpatient": f"""
select d.nama_departemen, {_STAY.format("avg", 2)} as avg_los_jam, {_STAY.format("min", 2)} as min_los_jam,
       {_STAY.format("max", 2)} as max_los_jam, count(*) as total_kunjungan_rawat_inap
from {DEPARTMENTS} where k.is_rawat_inap and k.durasi_kunjungan_jam is not null group by 1""",
    "bq3_los_days": f"""
select d.nama_departemen, count(*) as total_rawat_inap, {_STAY.format("avg", 2)} as avg_los_jam,
       round(avg(k.durasi_kunjungan_jam) / 24.0, 2) as avg_los_hari, {_STAY.format("min", 1)} as min_jam,
       {_STAY.format("max", 1)} as max_jam
from {DEPARTMENTS} where k.is_rawat_inap and k.durasi_kunjungan_jam > 0 group by 1""",
    "bq3_los_all": _LOS_ALL,
    "bq3_bench": f"""
select d.nama_departemen, {_STAY.format("avg", 2)} as avg_los_jam, count(*) as total
from {DEPARTMENTS} where k.is_rawat_inap and k.durasi_kunjungan_jam > 0 group by 1""",
    "bq4_doctor_status": _top_doctors(
        "tahun, bulan, nama_bulan, nama_lengkap as nama_dokter, "
        "nama_departemen as nama_departemen_dokter, n as total_kunjungan_ditangani",
        "d.nama_lengkap, d.nama_departemen",
        "where k.kode_status_kunjungan = 1",
        "",
    ),
    "bq4_doctor_top5": _top_doctors(
        "tahun, bulan, nama_bulan, nama_lengkap as nama_dokter, nama_departemen, "
        "n as total_kunjungan, r as rank_bulan",
        "d.nama_lengkap, d.nama_departemen",
        "",
        ", nama_departemen limit 100",
    ),
    "bq4_department_load": _DEPARTMENT_LOAD,
    "bq4_bench": _top_doctors(
        "tahun, bulan, nama_lengkap, n as total, r as rn", "d.nama_lengkap", "", "limit 100"
    ),
    "bq5_conversion": f"""
select {MONTH}, count(*) as total_kunjungan_dari_appt, {_n("k.is_appointment_converted")} as total_converted,
       round({_n("k.is_appointment_converted")} * 100.0 / count(*), 2) as conversion_rate_persen
from {ARRIVALS} where k.is_dari_appointment {BY_MONTH}""",
    "bq5_conversion_guard": f"""
select {MONTH}, count(*) as total_dari_appointment, {_n("k.is_appointment_converted")} as total_converted,
       round({_n("k.is_appointment_converted")} * 100.0 / nullif(count(*), 0), 1) as conversion_rate_persen
from {ARRIVALS} where k.is_dari_appointment {BY_MONTH}""",
    "bq5_conversion_full": _CONVERSION_FULL,
    "bq5_overall": f"""
select round({_n("is_appointment_converted")} * 100.0 / count(*), 2) as avg_conversion_rate
from fct_kunjungan where is_dari_appointment""",
}

# dashboard datasets

DASHBOARD = {
    "chart_bq1_line": f"""
select periode, sum(total_kunjungan)::bigint as total_kunjungan from ({_DATA_WINDOW}) group by 1""",
    "chart_bq1_stacked": f"""
select periode, sum(rawat_inap)::bigint as rawat_inap, sum(rawat_jalan)::bigint as rawat_jalan
from ({_DATA_WINDOW}) group by 1""",
    "chart_bq2_top10": f"""
select nama_departemen, sum(n)::bigint as total_kunjungan from {_PER_DEPT} group by 1
order by 2 desc, 1 limit 10""",
    "chart_bq3_table": f"""
select nama_departemen, sum(total_kunjungan)::bigint as total_kunjungan, sum(avg_los_jam) as avg_los_jam,
       sum(min_los_jam) as min_los_jam, sum(max_los_jam) as max_los_jam
from ({_LOS_ALL}) group by 1""",
    "chart_bq4_table": f"""
select tahun, bulan, nama_bulan, nama_departemen, sum(total_kunjungan)::bigint as total_kunjungan,
       sum(rawat_inap)::bigint as rawat_inap, sum(rawat_jalan)::bigint as rawat_jalan
from ({_DEPARTMENT_LOAD}) group by 1, 2, 3, 4""",
    "chart_bq4_heatmap": f"""
select nama_departemen, nama_bulan, sum(total_kunjungan)::bigint as total_kunjungan
from ({_DEPARTMENT_LOAD}) group by 1, 2""",
    "chart_bq4_heatmap_wide": "select nama_departemen, "
    + ", ".join(
        f"(sum(total_kunjungan) filter (where bulan = {i}))::bigint as {name}"
        for i, name in enumerate(MONTH_NAMES, 1)
    )
    + f" from ({_DEPARTMENT_LOAD}) group by 1",
    "chart_bq5_line": f"""
select periode, sum(conversion_rate_persen) as conversion_rate_persen,
       sum(total_converted)::bigint as total_converted, sum(total_tidak_converted)::bigint as total_tidak_converted
from ({_CONVERSION_FULL}) group by 1""",
}

# quality


def _judged(section: str, rows: list[tuple[str, str]], wanted: str = "value = 0", bad: str = "FAIL") -> str:
    """Rows of (label, query giving one value) with their status."""
    body = _union([f"select {_text(label)} as label, ({sql}) as value" for label, sql in rows])
    return (
        f"select '{section}' as section, label, value::bigint as value, "
        f"if({wanted}, 'PASS', '{bad}') as status from ({body})"
    )


def _count(table: str, where: str) -> str:
    return f"select count(*) from {table} where {where}"


def _orphans(fact: str, fk: str, dim: str, where: str) -> str:
    return _count(
        fact, f"{where} not exists (select 1 from {dim} p where p.{SURROGATE_KEYS[dim]} = {fact}.{fk})"
    )


_FKS = [(fact, fk, dim) for fact in FACT_DATES for fk, dim in foreign_keys(fact).items()]
_DQ = {
    "dq_completeness": _judged(
        "completeness",
        [(f"{mart} tidak kosong", f"select count(*) from {mart}") for mart in SURROGATE_KEYS],
        "value > 0",
    ),
    "dq_uniqueness": _judged(
        "uniqueness",
        [
            (f"{mart}.{key} unik", f"select count(*) - count(distinct {key}) from {mart}")
            for mart, key in SURROGATE_KEYS.items()
        ],
    ),
    "dq_not_null": _judged(
        "not_null",
        [(f"{mart}.{key} not null", _count(mart, f"{key} is null")) for mart, key in SURROGATE_KEYS.items()],
    ),
    "dq_referential": _judged(
        "referential", [(f"{fact}.{fk}", _orphans(fact, fk, dim, "")) for fact, fk, dim in _FKS]
    ),
    "dq_validity": _judged(
        "validity",
        [
            (
                "dim_tanggal.bulan in [1-12]",
                _count("dim_tanggal", "tanggal is not null and not bulan between 1 and 12"),
            ),
            (
                "dim_tanggal.tahun in [2020-2027]",
                _count("dim_tanggal", "tanggal is not null and not tahun between 2020 and 2027"),
            ),
            (
                "fct_kunjungan.durasi_kunjungan_jam >= 0",
                _count("fct_kunjungan", "durasi_kunjungan_jam < 0"),
            ),
            (
                "fct_diagnosis.total_biaya_diagnosis >= 0",
                _count("fct_diagnosis", "total_biaya_diagnosis < 0"),
            ),
            (
                "fct_tindakan.total_biaya_tindakan >= 0",
                _count("fct_tindakan_medis", "total_biaya_tindakan < 0"),
            ),
        ],
    ),
    "dq_unknown_member": _judged(
        "unknown_member",
        [
            (f"{mart} punya unknown member", _count(mart, f"{key} = -1"))
            for mart, key in SURROGATE_KEYS.items()
            if mart[:3] == "dim"
        ],
        "value > 0",
        "WARN",
    ),
}
_RECORDED = _union([f"select status from ({sql})" for sql in _DQ.values()])

QUALITY = _DQ | {
    "dq_distribution": _judged(
        "distribution",
        [
            ("fct_kunjungan rawat_inap=TRUE", _count("fct_kunjungan", "is_rawat_inap")),
            ("fct_kunjungan rawat_inap=FALSE", _count("fct_kunjungan", "not is_rawat_inap")),
            ("fct_diagnosis is_confirmed=TRUE", _count("fct_diagnosis", "is_confirmed")),
            ("fct_tindakan is_selesai=TRUE", _count("fct_tindakan_medis", "is_selesai")),
            ("fct_kunjungan dari_appointment=TRUE", _count("fct_kunjungan", "is_dari_appointment")),
        ],
        "value > 0",
    ),
    "dq_summary": f"""
select *, if(n_fail > 0, {_text(VERDICTS["FAIL"])}, if(n_warn > 0, {_text(VERDICTS["WARN"])},
       {_text(VERDICTS["PASS"])})) as status_akhir
from (select count(*) as total, {_n("status = 'PASS'")} as n_pass, {_n("status = 'WARN'")} as n_warn,
             {_n("status = 'FAIL'")} as n_fail from ({_RECORDED}))""",
    "ri_fact_stats": _union(
        [
            f"select '{fact}' as tabel, count(*) as jumlah_baris, {_n('pasien_key = -1')} as unknown_pasien from {fact}"
            for fact in FACT_DATES
        ]
    ),
}


def _column_tests(tests: list[tuple[str, str, str]]) -> str:
    rows = _union(
        [f"select '{mart}' as mart, '{col}' as \"column\", ({sql}) as failures" for mart, col, sql in tests]
    )
    return f"select *, if(failures = 0, 'pass', 'fail') as status from ({rows})"


def _literals(values: list[object]) -> str:
    return ", ".join(_text(v) if isinstance(v, str) else str(v).lower() for v in values)


_ACCEPTED = [("dim_tanggal", col, values) for col, values in CALENDAR_VALUES.items()] + [
    (mart, col, [True, False]) for mart, cols in FLAGS.items() for col in cols
]
QUALITY |= {
    "dbt_unique": _column_tests(
        [
            (
                mart,
                col,
                f"select count(*) from (select {col} from {mart} where {col} is not null "
                f"group by {col} having count(*) > 1)",
            )
            for mart, col in UNIQUE
        ]
    ),
    "dbt_not_null": _column_tests(
        [(mart, col, _count(mart, f"{col} is null")) for mart, cols in NOT_NULL.items() for col in cols]
    ),
    "dbt_accepted_values": _column_tests(
        [
            (
                mart,
                col,
                f"select count(distinct {col}) from {mart} where {col} not in ({_literals(values)})"
                + (" and tanggal is not null" if mart == "dim_tanggal" else ""),
            )
            for mart, col, values in _ACCEPTED
        ]
    ),
    "dbt_relationships": _column_tests(
        [(fact, fk, _orphans(fact, fk, dim, f"{fk} is not null and")) for fact, fk, dim in _FKS]
    ),
}

# report

REPORT = {
    "report_date_range": """
select min(waktu_masuk)::date as min_date, max(waktu_masuk)::date as max_date from fct_kunjungan""",
    "report_visit_split": f"""
select *, round(rawat_inap * 100.0 / total, 1) as pct_rawat_inap,
       round(rawat_jalan * 100.0 / total, 1) as pct_rawat_jalan
from (select {_n("is_rawat_inap")} as rawat_inap, {_n("not is_rawat_inap")} as rawat_jalan,
             count(*) as total from fct_kunjungan)""",
    "report_status_distribution": """
select deskripsi_status_kunjungan, count(*) as total from fct_kunjungan
where deskripsi_status_kunjungan is not null group by 1""",
    "report_entity_counts": """
select 'Pasien unik' as entitas, count(*) - 1 as jumlah from dim_pasien where pasien_key > 0
union all select 'Dokter unik', count(*) - 1 from dim_dokter where dokter_key > 0
union all select 'Departemen unik', count(*) - 1 from dim_departemen where departemen_key > 0
union all select 'Ruangan unik', count(*) - 1 from dim_ruangan where ruangan_key > 0
union all select 'Rentang tanggal (hari)', count(*) from dim_tanggal where tanggal_key > 0""",
    "report_diagnosis_summary": f"""
select count(*) as total_diagnosis, {_n("is_confirmed")} as confirmed, {_n("is_diagnosis_utama")} as utama,
       count(distinct refr_no) as kunjungan_dengan_diagnosis from fct_diagnosis""",
    "topk_dept_diagnosis": """
select d.nama_departemen, count(*) as total from fct_diagnosis g
join dim_departemen d on d.departemen_key = g.departemen_key and d.departemen_key > 0
group by 1 order by 2 desc, 1 limit 5""",
    "report_treatment_summary": f"""
select count(*) as total_tindakan, {_n("is_selesai")} as selesai, {_n("is_operasi")} as operasi,
       {_n("is_obat")} as pemberian_obat, count(distinct refr_no) as kunjungan_dengan_tindakan
from fct_tindakan_medis""",
}

ANSWERS: dict[str, str] = SCANS | TABLE_KEYS | STEPS | BUSINESS | DASHBOARD | QUALITY | REPORT
