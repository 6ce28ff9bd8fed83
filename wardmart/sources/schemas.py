"""The ten raw tables. Column order is the order in the CSV files."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column names and types.
RAW_DDL: dict[str, str] = {
    "stg_ehp__patn": """
        PAT_ID string, F_NAME string, L_NAME string, M_NAME string, GEN_CD bigint,
        GEN_DES string, DT_BRT date, CON_NO string, EM_ADD string, EC_F_NAME string,
        EC_L_NAME string, EC_M_NAME string, EC_CON_NO string, B_TYPE string, MAR_ST string,
        NAT_ID_S string, NAT_ID_T string, NAT_ID_N string, NAT_ID_E date, INGST_TMSTMP string""",
    "stg_ehp__vist": """
        REFR_NO string, PAT_ID string, MEDT_ID string, VIS_EN timestamp_ntz,
        VIS_EX timestamp_ntz, VSTAT_CD bigint, VSTAT_DES string, VTYPE_CD bigint,
        VTYPE_DES string, ROM_ID string""",
    "stg_ehp__appt": """
        REFR_NO bigint, PAT_ID string, APT_TIME timestamp_ntz, CTD_ID string, DOC_ID string,
        ASTAT_CD bigint, ASTAT_DES string, ATYPE_CD bigint, ATYPE_DES string""",
    "stg_ehp__trtm": """
        REFR_NO string, TRTM_TOT bigint, TRTM_EN timestamp_ntz, TTYPE_CD bigint,
        TTYPE_DES string, TRTM_CD bigint, TSTAT_CD bigint, TRTM_DES string,
        TSTAT_DES string, TRTM_SEQ bigint""",
    "stg_ehp__stff": """
        STF_ID string, F_NAME string, L_NAME string, M_NAME string, GEN_CD bigint,
        GEN_DES string, DT_BRT date, DEP_ID string, ROLE_CD bigint, ROLE_DES string,
        CON_NO string, EM_ADD string, STAT_CD bigint, STAT_DES string, HIRE_DATE string,
        ROLE_DATE string, SAL_YR string, SAL_MN string, INGST_TMSTMP string""",
    "stg_ehp__dpmt": "DEP_ID string, DEP_NAME string, DEP_DES string, DEP_LOC string",
    "stg_ehp__roms": """
        ROM_ID string, DEP_ID string, PRPS_CD bigint, PRPS_DES string, RTYPE_CD bigint,
        RTYPE_DES string, CPCT_NO bigint""",
    "stg_ehp__medt": """
        MEDT_ID string, TEAM_NO bigint, STF_ID string, ROLE_CD bigint, ROLE_DES string""",
    "stg_ehp__insr": """
        POL_NO string, PAT_ID string, COM_NAME string, ITYPE_CD string, ITYPE_DES string,
        POL_ST string, POL_ED string, ISTAT_CD bigint, ISTAT_DES string, CON_NO string""",
    "stg_ehp__diag": """
        REFR_NO string, DIG_TOT bigint, DIG_EN timestamp_ntz, DIG_SEQ bigint, DIG_CD bigint,
        DIG_DES string, DSTAT_CD bigint, DSTAT_DES string, DTYPE_CD bigint, DTYPE_DES string,
        ROM_ID string""",
}

# File names below the archive folder. The diagnosis table has two files.
RAW_FILES: dict[str, list[str]] = {
    name: [f"{name.upper()}.csv"] for name in RAW_DDL if name != "stg_ehp__diag"
} | {
    "stg_ehp__diag": [
        "STG_EHP__DIAG/STG_EHP__DIAG_1.csv",
        "STG_EHP__DIAG/STG_EHP__DIAG_2.csv",
    ]
}

# Staged column, source column and how it is read, "as_is" unless said.
STAGED_COLUMNS: dict[str, str] = {
    "stg_pasien": """
        pat_id PAT_ID, nama_depan F_NAME trimmed, nama_belakang L_NAME trimmed,
        kode_jenis_kelamin GEN_CD, jenis_kelamin GEN_DES, tanggal_lahir DT_BRT day,
        nomor_kontak CON_NO, email EM_ADD, golongan_darah B_TYPE, status_pernikahan MAR_ST,
        ingst_tmstmp INGST_TMSTMP""",
    "stg_kunjungan": """
        refr_no REFR_NO, pat_id PAT_ID, medt_id MEDT_ID, waktu_masuk VIS_EN moment,
        waktu_keluar VIS_EX moment, tanggal_masuk VIS_EN day, tanggal_keluar VIS_EX day,
        jam_masuk VIS_EN time, jam_keluar VIS_EX time, kode_status VSTAT_CD,
        deskripsi_status VSTAT_DES, kode_tipe VTYPE_CD, deskripsi_tipe VTYPE_DES, rom_id ROM_ID""",
    "stg_appointment": """
        appt_refr_no REFR_NO text, pat_id PAT_ID, waktu_appointment APT_TIME moment,
        tanggal_appointment APT_TIME day, ctd_id CTD_ID, doc_id DOC_ID, kode_status ASTAT_CD,
        deskripsi_status ASTAT_DES, kode_tipe ATYPE_CD, deskripsi_tipe ATYPE_DES""",
    "stg_diagnosis": """
        refr_no REFR_NO, urutan_diagnosis DIG_SEQ, kode_diagnosis DIG_CD,
        deskripsi_diagnosis DIG_DES, waktu_diagnosis DIG_EN moment, tanggal_diagnosis DIG_EN day,
        total_biaya DIG_TOT money, kode_status DSTAT_CD, deskripsi_status DSTAT_DES,
        kode_tipe DTYPE_CD, deskripsi_tipe DTYPE_DES, rom_id ROM_ID""",
    "stg_tindakan_medis": """
        refr_no REFR_NO, urutan_tindakan TRTM_SEQ, kode_tindakan TRTM_CD,
        deskripsi_tindakan TRTM_DES, kode_tipe TTYPE_CD, deskripsi_tipe TTYPE_DES,
        kode_status TSTAT_CD, deskripsi_status TSTAT_DES, waktu_tindakan TRTM_EN moment,
        tanggal_tindakan TRTM_EN day, total_biaya TRTM_TOT money""",
    "stg_staff_dokter": """
        stf_id STF_ID, nama_depan F_NAME trimmed, nama_belakang L_NAME trimmed,
        kode_jenis_kelamin GEN_CD, jenis_kelamin GEN_DES, tanggal_lahir DT_BRT day, dep_id DEP_ID,
        kode_peran ROLE_CD, deskripsi_peran ROLE_DES, kode_status STAT_CD, status_karyawan STAT_DES,
        tanggal_masuk HIRE_DATE date, tanggal_peran ROLE_DATE date, gaji_tahunan SAL_YR money,
        nomor_kontak CON_NO, email EM_ADD, ingst_tmstmp INGST_TMSTMP""",
    "stg_departemen": "dep_id DEP_ID, nama_departemen DEP_NAME, deskripsi DEP_DES, lokasi DEP_LOC",
    "stg_ruangan": """
        rom_id ROM_ID, dep_id DEP_ID, kode_tujuan PRPS_CD, deskripsi_tujuan PRPS_DES,
        kode_tipe RTYPE_CD, deskripsi_tipe RTYPE_DES, kapasitas CPCT_NO whole""",
    "stg_tim_medis": """
        medt_id MEDT_ID, nomor_tim TEAM_NO, stf_id STF_ID, kode_peran ROLE_CD,
        deskripsi_peran ROLE_DES""",
    "stg_asuransi": """
        pol_no POL_NO, pat_id PAT_ID, nama_asuransi COM_NAME, kode_tipe ITYPE_CD,
        jenis_penjamin ITYPE_DES, tanggal_mulai POL_ST date, tanggal_selesai POL_ED date,
        kode_status ISTAT_CD, deskripsi_status ISTAT_DES, nomor_kontak CON_NO""",
}

# Raw table, columns that must not be NULL, and flag = source column and value.
STAGED_FROM: dict[str, tuple[str, tuple[str, ...], dict[str, tuple[str, str]]]] = {
    "stg_pasien": ("stg_ehp__patn", ("PAT_ID",), {}),
    "stg_kunjungan": ("stg_ehp__vist", ("REFR_NO",), {"is_rawat_inap": ("VSTAT_DES", "Admitted")}),
    "stg_appointment": ("stg_ehp__appt", ("PAT_ID",), {"is_completed": ("ASTAT_DES", "Completed")}),
    "stg_diagnosis": ("stg_ehp__diag", ("REFR_NO",), {}),
    "stg_tindakan_medis": (
        "stg_ehp__trtm",
        ("REFR_NO",),
        {
            "is_selesai": ("TSTAT_DES", "Completed"),
            "is_operasi": ("TTYPE_DES", "Surgery"),
            "is_obat": ("TTYPE_DES", "Medication"),
        },
    ),
    "stg_staff_dokter": ("stg_ehp__stff", ("STF_ID",), {}),
    "stg_departemen": ("stg_ehp__dpmt", ("DEP_ID",), {}),
    "stg_ruangan": ("stg_ehp__roms", ("ROM_ID",), {}),
    "stg_tim_medis": ("stg_ehp__medt", ("MEDT_ID", "STF_ID"), {"is_dokter": ("ROLE_DES", "Doctor")}),
    "stg_asuransi": ("stg_ehp__insr", ("PAT_ID",), {"is_aktif": ("ISTAT_DES", "Active")}),
}


def staged_columns(name: str) -> list[tuple[str, str, str]]:
    """(staged column, source column, how it is read) of a staging table."""
    parts = [entry.split() for entry in STAGED_COLUMNS[name].split(",")]
    return [(part[0], part[1], part[2] if len(part) > 2 else "as_is") for part in parts]


def raw_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_DDL[name])
