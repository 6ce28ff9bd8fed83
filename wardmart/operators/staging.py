"""Staging: cast, rename and filter the raw tables. Narrow, lazy, one scan each.

Names, sources and types stand in ``sources.schemas``; here is how they are read, and the
columns that are worked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.functions.keys import ROW_ID
from wardmart.functions.scalar import date_or_null, int_or_null, money_or_null, time_of_day
from wardmart.sources.schemas import STAGED_FROM, staged_columns

c = F.col


def _is(column: str, value: str) -> Column:
    """True only for the value; NULL gives false."""
    return F.coalesce(c(column) == value, F.lit(False))


def _moment(column: Column) -> Column:
    return column.try_cast("timestamp_ntz")


READ = {
    "as_is": lambda column: column,
    "trimmed": F.trim,
    "text": lambda column: column.cast("string"),
    "moment": _moment,
    "day": lambda column: column.try_cast("date"),
    "date": date_or_null,
    "time": lambda column: time_of_day(_moment(column)),
    "money": money_or_null,
    "whole": int_or_null,
}


def _staged(name: str, raw: DataFrame, **derived: Column) -> DataFrame:
    """The fixed columns of a staging table, its flags, and ``derived`` ones; rows without a key go."""
    _, required, flags = STAGED_FROM[name]
    columns = [READ[how](c(column)).alias(target) for target, column, how in staged_columns(name)]
    columns += [_is(*test).alias(flag) for flag, test in flags.items()]
    columns += [column.alias(target) for target, column in derived.items()]
    return raw.dropna(subset=list(required)).select(*columns)


def _middle_name() -> Column:
    return F.coalesce(F.trim("M_NAME"), F.lit(""))


def stg_pasien(patn: DataFrame) -> DataFrame:
    empty = F.lit("")
    middle = F.nullif(c("M_NAME"), empty)
    names = F.concat_ws(" ", F.coalesce("F_NAME", empty), middle, F.coalesce("L_NAME", empty))
    return _staged("stg_pasien", patn, nama_tengah=_middle_name(), nama_lengkap=F.trim(names))


def stg_kunjungan(vist: DataFrame) -> DataFrame:
    return _staged("stg_kunjungan", vist)


def stg_appointment(appt: DataFrame) -> DataFrame:
    return _staged("stg_appointment", appt)


def stg_diagnosis(diag: DataFrame) -> DataFrame:
    return _staged("stg_diagnosis", diag)


def stg_tindakan_medis(trtm: DataFrame) -> DataFrame:
    return _staged("stg_tindakan_medis", trtm)


def stg_staff_dokter(stff: DataFrame) -> DataFrame:
    return _staged(
        "stg_staff_dokter",
        stff.where(c("ROLE_DES") == "Doctor"),
        nama_tengah=_middle_name(),
        nama_lengkap=F.trim(F.concat("F_NAME", F.lit(" "), "L_NAME")),
    )


def stg_departemen(dpmt: DataFrame) -> DataFrame:
    """Location text such as 'Block A, Floor 1' is split where the words occur."""

    def part(word: str, position: int) -> Column:
        piece = F.trim(F.split_part("DEP_LOC", F.lit(","), F.lit(position)))
        return F.when(c("DEP_LOC").like(f"%{word}%"), piece)

    return _staged("stg_departemen", dpmt, blok=part("Block", 1), lantai=part("Floor", 2))


def stg_ruangan(roms: DataFrame, dpmt: DataFrame) -> DataFrame:
    named = roms.join(dpmt.select("DEP_ID", "DEP_NAME"), "DEP_ID", "left")
    row_id = {ROW_ID: c(ROW_ID)} if ROW_ID in roms.columns else {}
    return _staged("stg_ruangan", named, nama_departemen=c("DEP_NAME"), **row_id)


def stg_tim_medis(medt: DataFrame) -> DataFrame:
    return _staged("stg_tim_medis", medt)


def stg_asuransi(insr: DataFrame) -> DataFrame:
    return _staged("stg_asuransi", insr)
