"""The star build as a whole, on normal and on heavily skewed raw tables."""

from __future__ import annotations

import os
import time
from datetime import datetime

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from oracle.build import _names_in
from oracle.models import MODELS
from wardmart.operators import facts
from wardmart.plans.star import FACTS, HOT_VISITS, KEYS, MARTS, Star
from wardmart.session import table_root
from wardmart.sources.store import TableStore


@pytest.mark.parametrize("mart", MARTS)
def test_keys_are_dense(star, mart):
    key = KEYS[mart]
    known = star.table(mart).where(f"{key} <> -1")
    row = known.agg(F.min(key), F.max(key), F.count("*"), F.countDistinct(key)).first()
    assert row[0] == 1
    assert row[1] == row[2] == row[3]
    unknown = star.table(mart).where(f"{key} = -1").count()
    assert unknown == (1 if mart.startswith("dim_") else 0)


def test_facts_fan_out(star):
    """Duplicate rooms and repeated visit numbers multiply rows, and nothing is lost."""
    assert star.table("fct_kunjungan").count() > star.raw["stg_ehp__vist"].count()
    assert star.table("fct_diagnosis").count() > star.raw["stg_ehp__diag"].count()
    for fact, raw in zip(FACTS, ("stg_ehp__vist", "stg_ehp__diag", "stg_ehp__trtm")):
        numbers = star.raw[raw].select(F.col("REFR_NO").alias("refr_no"))
        assert numbers.join(star.table(fact), "refr_no", "left_anti").isEmpty()


def test_load_time_is_one_value(spark, star):
    at = datetime(2026, 8, 1, 1)
    built = Star(star.raw, TableStore(spark, table_root(spark)), load_ts=at)
    for mart in ("dim_departemen", "dim_dokter"):
        stamps = built.table(mart).select("dw_load_date").distinct().collect()
        assert [r[0] for r in stamps] == [at]


def test_staged_copies_are_released(star):
    star.build()
    assert not [name for name in star.store.names() if "__" in name]
    assert not os.listdir(f"{star.store.root}/fct_kunjungan__ordered")


def test_ad_hoc_sql(star):
    assert star.sql("select count(*) as n from fct_kunjungan").first()["n"] == star.table("fct_kunjungan").count()


@pytest.fixture(scope="module")
def skewed(spark, star):
    """A third of the visits share one patient, room and team, many are exact copies; a third
    of the diagnoses and treatments belong to one visit number with several visits."""
    raw = dict(star.raw)
    visits = raw["stg_ehp__vist"].where("cast(substr(REFR_NO, 2) as int) < 600")
    third = F.pmod(F.xxhash64("MEDT_ID"), F.lit(3)) == 0
    hot = visits.withColumns(
        {
            "PAT_ID": F.when(third, "P0000007").otherwise(F.col("PAT_ID")),
            "ROM_ID": F.when(third, "R00001").otherwise(F.col("ROM_ID")),
            "MEDT_ID": F.when(third, "M3").otherwise(F.col("MEDT_ID")),
        }
    )
    few = hot.where("REFR_NO in ('W10', 'W11', 'W12')").withColumn("REFR_NO", F.lit("W8"))
    sixty = F.explode(F.sequence(F.lit(1), F.lit(60)))
    copies = hot.where("REFR_NO = 'W20'").withColumn("n", sixty).drop("n")
    raw["stg_ehp__vist"] = hot.unionByName(few).unionByName(copies)
    appointments = raw["stg_ehp__appt"]
    raw["stg_ehp__appt"] = appointments.withColumn(
        "PAT_ID", F.when(F.col("REFR_NO") % 3 == 0, "P0000007").otherwise(F.col("PAT_ID"))
    )
    for name in ("stg_ehp__diag", "stg_ehp__trtm"):
        number = F.when(F.pmod(F.xxhash64("*"), F.lit(3)) == 0, "W8").otherwise(F.col("REFR_NO"))
        raw[name] = raw[name].withColumn("REFR_NO", number)
    store = TableStore(spark, table_root(spark))
    stored = {name: store.write(name, df) for name, df in raw.items()}
    con = duckdb.connect()
    for name in stored:
        con.execute(f"create view {name} as select * from '{store.path(name)}/*.parquet'")
    return stored, con


@pytest.mark.parametrize("rows_per_task", [1_000_000, 2])
def test_skewed_facts_match_the_oracle(spark, skewed, rows_per_task):
    """With two rows per task nearly every key counts as hot and takes the split paths."""
    raw, con = skewed
    built = Star(raw, TableStore(spark, table_root(spark)), rows_per_task=rows_per_task)
    for fact in FACTS:
        got = built.table(fact).drop("dw_load_date")
        assert differences(got, con, with_models(fact)) == []
    assert built.table(HOT_VISITS).isEmpty() == (rows_per_task != 2)


def with_models(name):
    def needed(sql, done):
        for used in _names_in(sql, MODELS):
            if used not in done:
                needed(MODELS[used], done)
                done.append(used)
        return done

    tables = [*needed(MODELS[name], []), name]
    ctes = ",\n".join(f"{t} as materialized (\n{MODELS[t]}\n)" for t in tables)
    return f"with {ctes}\nselect * from {name}"


def test_other_session_settings_give_the_same_facts(spark, star):
    """Many partitions, no adaptive execution, no ANSI mode and another time zone."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "23",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.session.timeZone": "America/New_York",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        built = Star(star.raw, TableStore(spark, table_root(spark)))
        for fact in FACTS:
            got, wanted = (s.table(fact).drop("dw_load_date") for s in (built, star))
            assert got.exceptAll(wanted).isEmpty()
            assert wanted.exceptAll(got).isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_fact_columns_are_listed_once():
    for columns in (facts.FCT_KUNJUNGAN, facts.FCT_DIAGNOSIS, facts.FCT_TINDAKAN_MEDIS):
        assert len(columns) == len(set(columns))


def test_facts_are_built_one_after_another(spark):
    """Their shuffles and copies then do not take disk at the same time."""
    running, most = [], []

    class Timed(Star):
        def table(self, name):
            running.append(name)
            most.append(len([n for n in running if n in FACTS]))
            time.sleep(0.05)
            running.remove(name)

    Timed({}, TableStore(spark, table_root(spark))).build()
    assert max(most) == 1
