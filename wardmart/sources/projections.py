"""The ten raw hospital tables as projections of a generic order database.

The hospital files are not public test data here, so correctness is checked on
these projections. Each text is one SELECT that Spark and the oracle both run;
``{orders}`` and the like stand for the input tables. Unknown patients, missing
and unknown rooms, duplicate room ids and visit numbers, open and zero-length
visits, bad dates and NULL names are planted on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "supplier", "customer", "orders", "lineitem")

AS_OF = "2026-08-01"
"""Last arrival date of the projected visits, used as 'today' by relative-date queries."""

RAW_SQL: dict[str, str] = {
    "stg_ehp__dpmt": """
select concat('D', lpad(cast(n_nationkey as varchar(10)), 2, '0')) as DEP_ID,
       n_name as DEP_NAME,
       concat('Dept ', n_name) as DEP_DES,
       case when n_nationkey % 5 = 4 then 'Annex'
            when n_nationkey % 5 = 3 then 'Floor 9'
            else concat('Block ', substr('ABCDE', n_regionkey + 1, 1), ', Floor ', cast(n_nationkey % 4 + 1 as varchar(10))) end as DEP_LOC
from {nation}""",
    "stg_ehp__roms": """
select concat('R', lpad(cast(s_suppkey as varchar(10)), 5, '0')) as ROM_ID,
       case when s_suppkey = 5 then 'D99' else concat('D', lpad(cast(s_nationkey as varchar(10)), 2, '0')) end as DEP_ID,
       cast(s_suppkey % 3 as bigint) as PRPS_CD,
       case s_suppkey % 3 when 0 then 'Inpatient' when 1 then 'Outpatient' else 'Surgery' end as PRPS_DES,
       cast(s_suppkey % 2 as bigint) as RTYPE_CD,
       case s_suppkey % 2 when 0 then 'Ward' else 'Clinic' end as RTYPE_DES,
       cast(s_suppkey % 20 + 1 as bigint) as CPCT_NO
from {supplier}
union all
select concat('R', lpad(cast(s_suppkey as varchar(10)), 5, '0')), 'D00', cast(9 as bigint), 'Duplicate', cast(9 as bigint), 'Duplicate', cast(1 as bigint)
from {supplier} where s_suppkey < 2""",
    "stg_ehp__patn": """
select concat('P', lpad(cast(c_custkey as varchar(10)), 7, '0')) as PAT_ID,
       concat(' ', c_name) as F_NAME,
       case when c_custkey % 3 = 0 then 'Mid' when c_custkey % 3 = 1 then '' end as M_NAME,
       case when c_custkey % 50 = 0 then null else c_mktsegment end as L_NAME,
       cast(c_custkey % 2 as bigint) as GEN_CD,
       case c_custkey % 2 when 0 then 'Male' else 'Female' end as GEN_DES,
       cast(concat('19', cast(c_custkey % 50 + 50 as varchar(10)), '-0', cast(c_custkey % 9 + 1 as varchar(10)), '-1', cast(c_custkey % 10 as varchar(10))) as date) as DT_BRT,
       concat('08', cast(c_custkey as varchar(10))) as CON_NO,
       concat('p', cast(c_custkey as varchar(10)), '@example.org') as EM_ADD,
       case c_custkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'AB' else 'O' end as B_TYPE,
       case when c_acctbal < 0 then 'Single' else 'Married' end as MAR_ST,
       '2025-01-01 00:00:00' as INGST_TMSTMP
from {customer}""",
    "stg_ehp__vist": """
select concat('W', cast(case when o_orderkey % 500 = 499 then o_orderkey - 1 else o_orderkey end as varchar(10))) as REFR_NO,
       case when o_orderkey % 211 = 5 then 'P9999999' else concat('P', lpad(cast(o_custkey as varchar(10)), 7, '0')) end as PAT_ID,
       concat('M', cast(o_orderkey as varchar(10))) as MEDT_ID,
       o_orderdate + interval '9131' day + (o_orderkey * 7 % 1440) * interval '1' minute as VIS_EN,
       case when o_orderkey % 10 = 0 then null
            when o_orderkey % 101 = 1 then o_orderdate + interval '9131' day + (o_orderkey * 7 % 1440) * interval '1' minute
            else o_orderdate + interval '9131' day + (o_orderkey * 7 % 1440 + o_orderkey * 37 % 20000) * interval '1' minute end as VIS_EX,
       cast(case o_orderstatus when 'F' then 0 when 'P' then 1 else 2 end as bigint) as VSTAT_CD,
       case o_orderstatus when 'F' then 'Discharged' when 'P' then 'Admitted' else 'Need Follow-Up' end as VSTAT_DES,
       cast(o_orderkey % 2 as bigint) as VTYPE_CD,
       case o_orderkey % 2 when 0 then 'Diagnosis' else 'Treatment' end as VTYPE_DES,
       case when o_orderkey % 97 = 0 then null
            when o_orderkey % 13 = 0 then 'R99999'
            else concat('R', lpad(cast(o_orderkey % (select count(*) from {supplier}) as varchar(10)), 5, '0')) end as ROM_ID
from {orders}""",
    "stg_ehp__appt": """
select 6000000 + o_orderkey as REFR_NO,
       concat('P', lpad(cast(o_custkey as varchar(10)), 7, '0')) as PAT_ID,
       o_orderdate + (9131 - o_orderkey % 90) * interval '1' day + (o_orderkey * 11 % 1440) * interval '1' minute as APT_TIME,
       concat('S', lpad(cast(o_orderkey % 10 as varchar(10)), 5, '0')) as CTD_ID,
       concat('S', lpad(cast(o_orderkey % 7 as varchar(10)), 5, '0')) as DOC_ID,
       cast(case when o_orderkey % 7 = 0 then 2 else 1 end as bigint) as ASTAT_CD,
       case when o_orderkey % 7 = 0 then 'Cancelled' else 'Completed' end as ASTAT_DES,
       cast(o_orderkey % 3 as bigint) as ATYPE_CD,
       case o_orderkey % 3 when 0 then 'Check-up' when 1 then 'Consultation' else 'Follow-Up' end as ATYPE_DES
from {orders}""",
    "stg_ehp__medt": """
select concat('M', cast(l_orderkey as varchar(10))) as MEDT_ID,
       cast(l_linenumber as bigint) as TEAM_NO,
       concat('S', lpad(cast(l_suppkey as varchar(10)), 5, '0')) as STF_ID,
       cast(case when l_suppkey % 3 = 0 then 0 else 1 end as bigint) as ROLE_CD,
       case when l_suppkey % 3 = 0 then 'Doctor' else 'Nurse' end as ROLE_DES
from {lineitem}""",
    "stg_ehp__stff": """
select concat('S', lpad(cast(s_suppkey as varchar(10)), 5, '0')) as STF_ID,
       concat('Staff', cast(s_suppkey as varchar(10)), ' ') as F_NAME,
       case when s_suppkey % 10 = 0 then 'M' end as M_NAME,
       case when s_suppkey % 33 = 0 then null else s_name end as L_NAME,
       cast(s_suppkey % 2 as bigint) as GEN_CD,
       case s_suppkey % 2 when 0 then 'Male' else 'Female' end as GEN_DES,
       cast(concat('197', cast(s_suppkey % 10 as varchar(10)), '-06-15') as date) as DT_BRT,
       case when s_suppkey % 25 = 24 then 'D99' else concat('D', lpad(cast(s_nationkey as varchar(10)), 2, '0')) end as DEP_ID,
       cast(case when s_suppkey % 3 = 0 then 0 else 1 end as bigint) as ROLE_CD,
       case when s_suppkey % 3 = 0 then 'Doctor' else 'Nurse' end as ROLE_DES,
       cast(s_suppkey % 2 as bigint) as STAT_CD,
       case s_suppkey % 2 when 0 then 'Active' else 'Inactive' end as STAT_DES,
       case when s_suppkey % 11 = 0 then 'n/a' when s_suppkey % 11 = 3 then '2015'
            else concat('201', cast(s_suppkey % 10 as varchar(10)), '-0', cast(s_suppkey % 9 + 1 as varchar(10)), '-15') end as HIRE_DATE,
       concat('2020-0', cast(s_suppkey % 9 + 1 as varchar(10)), '-01') as ROLE_DATE,
       cast(s_acctbal as decimal(15,2)) as SAL_YR,
       concat('09', cast(s_suppkey as varchar(10))) as CON_NO,
       concat('s', cast(s_suppkey as varchar(10)), '@example.org') as EM_ADD,
       '2025-01-01 00:00:00' as INGST_TMSTMP
from {supplier}""",
    "stg_ehp__insr": """
select concat('L', cast(c_custkey as varchar(10)), '-1') as POL_NO,
       concat('P', lpad(cast(c_custkey as varchar(10)), 7, '0')) as PAT_ID,
       concat('Insurer ', cast(c_nationkey as varchar(10))) as COM_NAME,
       cast(c_custkey % 5 as varchar(10)) as ITYPE_CD,
       c_mktsegment as ITYPE_DES,
       concat('202', cast(c_custkey % 6 as varchar(10)), '-01-01') as POL_ST,
       concat('202', cast(c_custkey % 6 + 1 as varchar(10)), '-12-31') as POL_ED,
       cast(c_custkey % 2 as bigint) as ISTAT_CD,
       case c_custkey % 2 when 0 then 'Active' else 'Expired' end as ISTAT_DES,
       concat('07', cast(c_custkey as varchar(10))) as CON_NO
from {customer} where c_custkey % 4 <> 0
union all
select concat('L', cast(c_custkey as varchar(10)), '-2'),
       concat('P', lpad(cast(c_custkey as varchar(10)), 7, '0')),
       concat('Insurer ', cast(c_nationkey + 100 as varchar(10))),
       cast(c_custkey % 5 as varchar(10)),
       c_mktsegment,
       '2022-01-01',
       case c_custkey % 9 when 0 then 'open' when 3 then '2024' else '2025-06-30' end,
       cast(case c_custkey % 5 when 0 then 0 else 1 end as bigint),
       case c_custkey % 5 when 0 then 'Active' else 'Expired' end,
       concat('07', cast(c_custkey as varchar(10)))
from {customer} where c_custkey % 3 = 0""",
    "stg_ehp__trtm": """
select concat('W', cast(l_orderkey as varchar(10))) as REFR_NO,
       l_suppkey % 10 + 1 as TRTM_TOT,
       l_shipdate + interval '9131' day as TRTM_EN,
       l_partkey % 3 as TTYPE_CD,
       case l_partkey % 3 when 0 then 'Surgery' when 1 then 'Medication' else 'Therapy' end as TTYPE_DES,
       l_partkey % 50 as TRTM_CD,
       cast(case l_linestatus when 'F' then 0 else 1 end as bigint) as TSTAT_CD,
       concat('Procedure ', cast(l_partkey % 50 as varchar(10))) as TRTM_DES,
       case l_linestatus when 'F' then 'Completed' else 'Planned' end as TSTAT_DES,
       cast(l_linenumber as bigint) as TRTM_SEQ
from {lineitem} where l_linenumber % 2 = 0""",
}

_DIAGNOSIS_FILE = """
select concat('W', cast(l_orderkey as varchar(10))) as REFR_NO,
       cast(l_quantity as bigint) as DIG_TOT,
       case when l_suppkey % 17 = 16 then null else l_shipdate + interval '9131' day end as DIG_EN,
       case when l_partkey % 251 = 250 then null else cast(l_linenumber as bigint) end as DIG_SEQ,
       l_partkey % 100 as DIG_CD,
       concat('Diagnosis ', cast(l_partkey % 100 as varchar(10))) as DIG_DES,
       cast(case l_returnflag when 'A' then 0 when 'R' then 1 else 2 end as bigint) as DSTAT_CD,
       case when l_returnflag = 'A' then 'Confirmed' when l_returnflag = 'R' then 'Recurrent'
            when l_partkey % 2 = 0 then 'Lab Confirmed' else 'Requires Surgery' end as DSTAT_DES,
       l_partkey % 3 as DTYPE_CD,
       case l_partkey % 3 when 0 then 'Primary' else 'Secondary' end as DTYPE_DES,
       case when l_partkey % 2 = 0 then concat('R', lpad(cast(l_suppkey as varchar(10)), 5, '0')) end as ROM_ID
from {lineitem} where l_linenumber % 2 = 1"""

# The diagnosis table arrives as two files: even and odd order keys.
DIAGNOSIS_PARTS: list[str] = [f"{_DIAGNOSIS_FILE} and l_orderkey % 2 = {part}" for part in (0, 1)]


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ten raw tables over the Parquet files in ``sf_dir``, all lazy."""
    inputs = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    raw = {name: _run(spark, sql, inputs) for name, sql in RAW_SQL.items()}
    first, second = (_run(spark, sql, inputs) for sql in DIAGNOSIS_PARTS)
    raw["stg_ehp__diag"] = first.unionByName(second)
    return raw


def _run(spark: SparkSession, sql: str, inputs: dict[str, DataFrame]) -> DataFrame:
    used = {name: df for name, df in inputs.items() if "{" + name + "}" in sql}
    return spark.sql(sql, **used)
