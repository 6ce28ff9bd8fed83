"""The star schema build: raw tables in, stored dimensions and facts out."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from threading import Lock, RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from wardmart.functions.keys import ROW_ID, dense_key, with_row_id, with_unknown
from wardmart.functions.scalar import month_number
from wardmart.functions.skew import ROWS_PER_TASK, hot_keys, split_hot
from wardmart.operators import dimensions, facts, intermediate, nearest, staging
from wardmart.session import table_root
from wardmart.sources.projections import AS_OF, raw_tables
from wardmart.sources.store import TableStore

DIMENSIONS = ("dim_tanggal", "dim_pasien", "dim_dokter", "dim_departemen", "dim_ruangan")
FACTS = ("fct_kunjungan", "fct_diagnosis", "fct_tindakan_medis")
MARTS = DIMENSIONS + FACTS

KEYS = {
    "dim_tanggal": "tanggal_key",
    "dim_pasien": "pasien_key",
    "dim_dokter": "dokter_key",
    "dim_departemen": "departemen_key",
    "dim_ruangan": "ruangan_key",
    "fct_kunjungan": "kunjungan_key",
    "fct_diagnosis": "diagnosis_key",
    "fct_tindakan_medis": "tindakan_key",
}

KEYED_VISITS = "kunjungan_keyed"
HOT_VISITS = "nomor_panas"
VISIT_KEYS = "kunci_kunjungan"
HOT_VISIT_KEYS = "kunci_kunjungan_panas"
VISITS_BY_MONTH = "fct_kunjungan_bulan"
ARRIVAL_MONTH = "bulan_masuk"
"""Folder of the visit fact's rows: year and month of arrival as a number, -1 if unknown."""
ROOMS = "kamar"
EVENTS = "urutan_waktu"
CARRIED = "urutan_batas"

LOOKUP_ROWS = 500_000
"""A lookup of two keys and a short id is broadcast up to so many rows, about 50 MB."""

STAMPED = ("stg_departemen", "stg_ruangan")
"""Staging tables that carry their load time."""

LOAD_COLUMNS = ("dw_load_date", "dw_updated_date")


class Star:
    """Tables of one warehouse, each built and stored the first time it is asked for.

    Staging and intermediate tables stay lazy. Marts, and the visits with their
    keys that all facts share, are stored as Parquet.
    """

    def __init__(
        self,
        raw: dict[str, DataFrame],
        store: TableStore,
        load_ts: datetime | None = None,
        rows_per_task: int = ROWS_PER_TASK,
        as_of: str | None = None,
    ):
        """``as_of`` is the day that "the last 12 months" end on, today by default."""
        self.raw = raw
        self.store = store
        self.spark = store.spark
        self.load_ts = load_ts or datetime.now(timezone.utc)
        self.rows_per_task = rows_per_task
        self.as_of = F.lit(as_of).cast("date") if as_of else F.current_date()
        self.rejected: dict[str, int] = {}
        """Lines dropped while loading, by raw table; empty for tables that were not loaded from files."""
        self._tables: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, RLock] = defaultdict(RLock)

    # staging and intermediate: lazy

    def staging(self, name: str) -> DataFrame:
        staged = self._staging_builders()[name]()
        return staged.withColumn("dw_load_date", self._stamp()) if name in STAMPED else staged

    def _staging_builders(self) -> dict[str, Callable[[], DataFrame]]:
        raw = self.raw
        return {
            "stg_pasien": lambda: staging.stg_pasien(raw["stg_ehp__patn"]),
            "stg_kunjungan": lambda: staging.stg_kunjungan(raw["stg_ehp__vist"]),
            "stg_appointment": lambda: staging.stg_appointment(raw["stg_ehp__appt"]),
            "stg_diagnosis": lambda: staging.stg_diagnosis(raw["stg_ehp__diag"]),
            "stg_tindakan_medis": lambda: staging.stg_tindakan_medis(raw["stg_ehp__trtm"]),
            "stg_staff_dokter": lambda: staging.stg_staff_dokter(raw["stg_ehp__stff"]),
            "stg_departemen": lambda: staging.stg_departemen(raw["stg_ehp__dpmt"]),
            "stg_ruangan": lambda: staging.stg_ruangan(raw["stg_ehp__roms"], raw["stg_ehp__dpmt"]),
            "stg_tim_medis": lambda: staging.stg_tim_medis(raw["stg_ehp__medt"]),
            "stg_asuransi": lambda: staging.stg_asuransi(raw["stg_ehp__insr"]),
        }

    def _stamp(self) -> Column:
        return F.lit(self.load_ts)

    def insured_patients(self) -> DataFrame:
        return intermediate.int_pasien_dengan_asuransi(
            with_row_id(self.staging("stg_pasien")),
            self.staging("stg_asuransi"),
        )

    def visits_with_doctor(self) -> DataFrame:
        return intermediate.int_dokter_per_kunjungan(
            with_row_id(self.staging("stg_kunjungan")),
            self.staging("stg_tim_medis"),
            self.rows_per_task,
        )

    def enriched_visits(self) -> DataFrame:
        """Visits with keys and nearest appointment, from the stored keyed visits."""
        return intermediate.int_kunjungan_enriched(
            with_row_id(self.table(KEYED_VISITS)),
            self.nearest_appointments(),
            self.table(HOT_VISITS),
        )

    def nearest_appointments(self) -> DataFrame:
        """Per visit number, from the stored order of visits and appointments."""
        return nearest.nearest_appointment(self.table(EVENTS), self.table(CARRIED))

    def keyed_visits(self) -> DataFrame:
        """Visits with their first doctor and the keys of four dimensions, NULL where none fits."""
        doctors = facts.doctor_lookup(self.table("dim_dokter"))
        return facts.keyed_visits(
            self.visits_with_doctor().drop(ROW_ID),
            facts.patient_lookup(self.table("dim_pasien")),
            self._lookup(doctors),
            self.rooms(),
        )

    def diagnoses(self) -> DataFrame:
        """The diagnosis fact before it is numbered."""
        return facts.fct_diagnosis(
            self.staging("stg_diagnosis"),
            (self.table(VISIT_KEYS), self.table(HOT_VISIT_KEYS)),
            self.rooms(),
            self.table("dim_tanggal"),
            self.table(HOT_VISITS),
        )

    def rooms(self) -> DataFrame:
        """Stored, so that its true size decides how facts are joined with it."""
        return self._lookup(self.table(ROOMS))

    def _lookup(self, keys: DataFrame) -> DataFrame:
        """Keys of a stored dimension, broadcast if they are few by count.

        Spark goes by the bytes of the files, so under a low threshold it would shuffle and sort
        every visit or diagnosis to meet a few thousand rooms.
        """
        return F.broadcast(keys) if keys.count() <= LOOKUP_ROWS else keys

    # stored tables

    def table(self, name: str) -> DataFrame:
        if name in FACTS and KEYED_VISITS not in self._tables:
            self.build((name,))
        if name == "fct_kunjungan":
            return self.table(VISITS_BY_MONTH).drop(ARRIVAL_MONTH)
        with self._locks[name]:
            if name not in self._tables:
                self._tables[name] = self._build(name)
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def build(self, names: tuple[str, ...] = MARTS) -> dict[str, DataFrame]:
        """Store the named marts. Dimensions that do not depend on each other run side by side,
        so the short tail of one leaves no executor idle. Facts fill the executors by
        themselves and follow each other: side by side, the shuffles and copies that
        each needs while it is numbered would take disk at the same time.
        """
        facts_wanted = [n for n in names if n in FACTS]
        dimensions_wanted = DIMENSIONS if facts_wanted else names
        prepared = [HOT_VISITS] if facts_wanted else []
        if "fct_kunjungan" in facts_wanted:
            prepared.append(CARRIED)
        if len(facts_wanted) > ("fct_kunjungan" in facts_wanted):
            prepared += [VISIT_KEYS, HOT_VISIT_KEYS]
        layers = (dimensions_wanted, prepared, *[(name,) for name in facts_wanted])
        for layer in layers:
            with ThreadPoolExecutor(max_workers=len(DIMENSIONS)) as jobs:
                list(jobs.map(inheritable_thread_target(self.spark)(self.table), layer))
        return {name: self.table(name) for name in names}

    def row_counts(self) -> DataFrame:
        """(table_name, row_count) of the marts, which are built first."""
        return self.store.row_counts(list(self.build()))

    def sql(self, text: str) -> DataFrame:
        """Ad-hoc SQL over the marts, each visible under its own name."""
        for name, df in self.build().items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(text)

    def _build(self, name: str) -> DataFrame:
        if name == "dim_tanggal":
            days = dimensions.dim_tanggal(self.spark).coalesce(1)
            return self.store.write(name, with_unknown(days, dimensions.UNKNOWN[name]))
        if name == "dim_pasien":
            return self._dimension(name, dimensions.dim_pasien(self.insured_patients()), "pat_id")
        if name == "dim_dokter":
            doctors = with_row_id(self.staging("stg_staff_dokter"))
            attributes = dimensions.dim_dokter(doctors, self.raw["stg_ehp__dpmt"])
            return self._dimension(name, attributes, "stf_id")
        if name == "dim_departemen":
            departments = with_row_id(self.staging("stg_departemen"))
            return self._dimension(name, dimensions.dim_departemen(departments), "dep_id")
        if name == "dim_ruangan":
            rooms = staging.stg_ruangan(
                with_row_id(self.raw["stg_ehp__roms"]), self.raw["stg_ehp__dpmt"]
            )
            return self._dimension(name, dimensions.dim_ruangan(rooms), "rom_id")
        if name == ROOMS:
            lookup = facts.room_lookup(self.table("dim_ruangan"), self.table("dim_departemen"))
            return self.store.write(name, lookup)
        if name == EVENTS:
            visits = with_row_id(self.staging("stg_kunjungan"))
            events = nearest.events_in_time(visits, self.staging("stg_appointment"))
            return self.store.write(name, events)
        if name == CARRIED:
            return self.store.write(name, nearest.carried_over(self.table(EVENTS)))
        if name == KEYED_VISITS:
            self.build(DIMENSIONS)
            return self.store.write(name, self.keyed_visits())
        if name == HOT_VISITS:
            return self.store.write(name, hot_keys(self.table(KEYED_VISITS), "refr_no", self.rows_per_task))
        if name == VISIT_KEYS:
            usual, _ = split_hot(self._visit_keys(), "refr_no", self.table(HOT_VISITS))
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            return self.store.write_bucketed(name, usual.drop(facts.VISIT_ROW), "refr_no", buckets)
        if name == HOT_VISIT_KEYS:
            _, heavy = split_hot(self._visit_keys(), "refr_no", self.table(HOT_VISITS))
            return self.store.write(name, heavy)
        if name == VISITS_BY_MONTH:
            fact = facts.fct_kunjungan(self.enriched_visits(), self.table("dim_tanggal"))
            return self._visit_fact("fct_kunjungan", fact)
        if name == "fct_diagnosis":
            return self._fact(name, self.diagnoses(), ["refr_no", "urutan_diagnosis"], facts.FCT_DIAGNOSIS)
        if name == "fct_tindakan_medis":
            fact = facts.fct_tindakan_medis(
                self.staging("stg_tindakan_medis"),
                (self.table(VISIT_KEYS), self.table(HOT_VISIT_KEYS)),
                self.table("dim_tanggal"),
                self.table(HOT_VISITS),
            )
            return self._fact(name, fact, ["refr_no", "urutan_tindakan"], facts.FCT_TINDAKAN_MEDIS)
        raise KeyError(name)

    def _visit_keys(self) -> DataFrame:
        keys = ("refr_no", "pasien_key", "dokter_key", "ruangan_key", "departemen_key")
        rows = with_row_id(self.table(KEYED_VISITS).select(*keys))
        return rows.withColumnRenamed(ROW_ID, facts.VISIT_ROW)

    def _dimension(self, name: str, attributes: DataFrame, natural_key: str) -> DataFrame:
        columns = [col for col in attributes.columns if col != ROW_ID]
        order = facts.key_order([natural_key], columns)
        keyed = self._stamped(name, dense_key(self.store, name, attributes, order, KEYS[name]))
        unknown = dimensions.UNKNOWN[name] | {
            col: self._stamp() for col in LOAD_COLUMNS if col in keyed.columns
        }
        return self._replace(name, with_unknown(keyed, unknown))

    def _fact(self, name: str, fact: DataFrame, leading: list[str], columns: list[str]) -> DataFrame:
        order = facts.key_order(leading, columns)
        keyed = dense_key(self.store, name, fact, order, KEYS[name])
        return self._replace(name, self._stamped(name, keyed))

    def _visit_fact(self, name: str, fact: DataFrame) -> DataFrame:
        """The visit fact in one folder per month of arrival, rows of a file in key order.

        Adaptive execution cuts months with many rows into several files and lets no task
        write more than its advisory share.
        """
        order = facts.key_order(["refr_no"], facts.FCT_KUNJUNGAN)
        keyed = self._stamped(name, dense_key(self.store, name, fact, order, KEYS[name]))
        day = F.date_add(F.lit(dimensions.CALENDAR[0]).cast("date"), F.col("tanggal_masuk_key").cast("int") - 1)
        month = F.when(F.col("tanggal_masuk_key") > 0, month_number(F.year(day), F.month(day))).otherwise(-1)
        rows = keyed.withColumn(ARRIVAL_MONTH, month.cast("int")).hint("rebalance", ARRIVAL_MONTH)
        table = self.store.write(name, rows.sortWithinPartitions(ARRIVAL_MONTH, KEYS[name]), ARRIVAL_MONTH)
        self.store.release(f"{name}__ordered")
        return table

    def _stamped(self, name: str, df: DataFrame) -> DataFrame:
        df = df.withColumn("dw_load_date", self._stamp())
        overwritten = name in ("dim_departemen", "dim_ruangan")
        return df.withColumn("dw_updated_date", self._stamp()) if overwritten else df

    def _replace(self, name: str, df: DataFrame) -> DataFrame:
        table = self.store.write(name, df)
        self.store.release(f"{name}__ordered")
        return table


_STARS: dict[tuple[str, str], Star] = {}
_STARS_LOCK = Lock()


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    """The warehouse over the order database in ``sf_dir``, built once per Spark application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    with _STARS_LOCK:
        if at not in _STARS:
            store = TableStore(spark, table_root(spark))
            _STARS[at] = Star(raw_tables(spark, sf_dir), store, as_of=AS_OF)
    return _STARS[at]
