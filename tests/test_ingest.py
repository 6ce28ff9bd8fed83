"""CSV archive in, raw tables out: bad rows, missing files, empty tables, and a full run."""

from __future__ import annotations

import shutil

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from wardmart.plans.catalog import publish, publish_views, view_text
from wardmart.plans.layers import listing
from wardmart.plans.refresh import refresh
from wardmart.plans.star import MARTS, Star
from wardmart.session import table_root
from wardmart.sources.ingest import read_csv, read_csv_counted, require_rows, row_counts, source_files
from wardmart.sources.projections import raw_tables
from wardmart.sources.schemas import RAW_FILES, raw_schema
from wardmart.sources.store import TableStore

SMALL = "id int, n int, d date"


def test_a_bad_row_is_dropped_whole(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "id,n,d\n1,10,2024-01-01\n2,ten,2024-01-01\n3,30,someday\n4,40,2024-01-01,extra\n"
    )
    store = TableStore(spark, table_root(spark))
    loaded = store.write("t", read_csv(spark, [str(tmp_path / "t.csv")], SMALL))
    assert [r["id"] for r in loaded.collect()] == [1]
    assert loaded.select("id").count() == loaded.count() == 1


def test_dropped_rows_are_counted(spark, tmp_path):
    """The same rows stay as when bad ones are dropped by the reader; no second scan counts them."""
    (tmp_path / "t.csv").write_text(
        "id,n,d\n1,10,2024-01-01\n2,ten,2024-01-01\n3,30,someday\n4,40,2024-01-01,extra\n5,50\n6,,\n"
    )
    schema = spark.createDataFrame([], SMALL).schema
    rows, counts = read_csv_counted(spark, [str(tmp_path / "t.csv")], schema)
    store = TableStore(spark, table_root(spark))
    loaded = store.write("t", rows)
    dropping = read_csv(spark, [str(tmp_path / "t.csv")], SMALL)
    assert sorted(loaded.collect()) == sorted(dropping.collect())
    assert counts.get == {"read": 6, "rejected": 6 - loaded.count()}
    assert counts.get["rejected"] >= 3


def test_a_header_in_another_order_is_an_error_there_too(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,id,d\n1,2,2024-01-01\n")
    rows, _ = read_csv_counted(spark, [str(tmp_path / "t.csv")], spark.createDataFrame([], SMALL).schema)
    with pytest.raises(Exception, match="CSV header does not conform"):
        rows.collect()


def test_quotes_and_empty_fields(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x ""y"", z",\n')
    assert list(read_csv(spark, [str(tmp_path / "t.csv")], "a string, b string").first()) == ['x "y", z', None]


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, [str(tmp_path / "t.csv")], "a string, b string").collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",z\nu,v\n')
    rows = read_csv(spark, [str(tmp_path / "t.csv")], "a string, b string", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("x\ny", "z"), ("u", "v")]


def test_missing_files_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as error:
        source_files(spark, str(tmp_path))
    assert all(name in str(error.value) for files in RAW_FILES.values() for name in files)


def test_empty_tables_stop_the_run(spark):
    empty = spark.createDataFrame([], SMALL)
    with pytest.raises(ValueError, match="'b'"):
        require_rows({"a": spark.range(1), "b": empty})


def test_row_counts_end_with_the_total(spark):
    counts = row_counts({"a": spark.range(3), "b": spark.range(4)}).collect()
    assert {r["table_name"]: r["row_count"] for r in counts} == {"a": 3, "b": 4, "TOTAL": 7}


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """The projected raw tables as an archive of CSV files, one file per expected name."""
    folder = tmp_path_factory.mktemp("archive")
    for name, df in raw_tables(spark, SF_DIR).items():
        unused = {n: F.lit(None) for n in raw_schema(name).names if n not in df.columns}
        text = [
            F.coalesce(F.col(f.name).try_cast(f.dataType).cast("string"), F.col(f.name).cast("string"))
            for f in raw_schema(name)
        ]
        whole = df.withColumns(unused).select(
            *[column.alias(n) for column, n in zip(text, raw_schema(name).names)]
        )
        parts = [whole]
        if name == "stg_ehp__diag":
            even = F.regexp_extract("REFR_NO", r"(\d)$", 1).cast("int") % 2 == 0
            parts = [whole.where(even), whole.where(~even)]
        for relative, part in zip(RAW_FILES[name], parts):
            target = folder / relative
            target.parent.mkdir(parents=True, exist_ok=True)
            out = folder / f"tmp_{target.stem}"
            part.coalesce(1).write.option("header", True).csv(str(out))
            shutil.copy(next(out.glob("part-*.csv")), target)
    return str(folder)


def test_sizes_of_all_eleven_files(spark, archive):
    sizes = source_files(spark, archive).collect()
    assert len(sizes) == 11
    assert all(r["bytes"] > 0 for r in sizes)


def test_archive_to_star(spark, archive, star):
    """From CSV the facts have the same rows as from the projections."""
    built, tests = refresh(spark, archive, table_root(spark))
    assert set(RAW_FILES) <= set(built.store.names())
    assert tests.count() == 75
    assert set(built.rejected) == set(RAW_FILES)
    assert built.rejected["stg_ehp__vist"] == 0
    assert tests.where("status = 'fail'").isEmpty()
    for mart in ("fct_kunjungan", "fct_diagnosis", "fct_tindakan_medis"):
        # Staff with an unreadable hire date are bad CSV rows, so doctors and keys differ.
        order = [n for n in star.table(mart).columns if not n.endswith(("_key", "_date"))]
        got, wanted = built.table(mart).select(*order), star.table(mart).select(*order)
        assert got.exceptAll(wanted).isEmpty()
        assert wanted.exceptAll(got).isEmpty()

    publish(built)
    assert listing(built) == sorted(MARTS)
    assert listing(built, "raw") == sorted(RAW_FILES)
    visits = spark.sql("select count(*) as n from analytics_marts.fct_kunjungan").first()["n"]
    assert visits == star.table("fct_kunjungan").count()
    assert spark.table("int_dokter_per_kunjungan").count() == spark.table("stg_kunjungan").count()
    assert "dw_load_date" in spark.table("stg_departemen").columns
    assert not [n for n in spark.table("int_kunjungan_enriched").columns if n.endswith("_key")]
    assert "_row_id" not in spark.table("int_pasien_dengan_asuransi").columns

    with pytest.raises(ValueError, match="persistent catalog"):
        publish(built, lasting=True)  # the catalog of the tests is in memory
    publish_views(built)
    for view in ("analytics_staging.stg_pasien", "analytics_intermediate.int_dokter_per_kunjungan"):
        name = view.split(".")[1]
        text = spark.sql(f"show create table {view}").first()[0]
        assert view_text(built, name) in text
        assert f"parquet.`{built.store.path(name)}`" in text
        assert spark.table(view).columns == spark.table(name).columns
        assert spark.table(view).exceptAll(spark.table(name)).isEmpty()
        assert spark.table(view).count() == spark.table(name).count()
    before = spark.table("analytics_staging.stg_pasien").count()
    built.store.write("stg_pasien", built.store.read("stg_pasien").limit(1))
    assert spark.table("analytics_staging.stg_pasien").count() == before
    spark.sql(f"create or replace view analytics_staging.stg_pasien as {view_text(built, 'stg_pasien')}")
    assert spark.table("analytics_staging.stg_pasien").count() == 1


def test_an_in_memory_catalog_is_refused_before_anything_is_built(spark):
    star = Star({}, TableStore(spark, table_root(spark)))
    with pytest.raises(ValueError, match="persistent catalog"):
        publish(star, lasting=True)
    assert star.store.names() == []
