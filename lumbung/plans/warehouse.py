"""The star schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import (
    category_of,
    equality_flag,
    ordinal_rank,
    presence_flag,
    surrogate_key,
    whole_number,
)
from lumbung.functions.identity import KeyKind
from lumbung.operators.checks import orphan_keys
from lumbung.operators.conform import union_all
from lumbung.operators.dedup import dedup_by_key, pick_per_entity
from lumbung.operators.dimensions import date_dimension, value_dimension
from lumbung.operators.facts import Flag, KeyLookup, build_fact
from lumbung.operators.lookup import bounded, lookup
from lumbung.plans import fixed_values as v
from lumbung.plans.schemas import DIMENSIONS

Tables = Mapping[str, DataFrame]

# The event dates that make up the date dimension.  Enrolment dates are not
# among them; an enrolment on any other day has no date key.
EVENT_DATES = {
    "olah_aktivitas_belajar": "tanggal_aktivitas",
    "olah_hasil_latihan": "tanggal_latihan",
    "olah_transaksi": "tanggal_transaksi",
    "olah_ulasan": "tanggal_ulasan",
}
ENROLMENT_DATE = ("olah_pendaftaran_program", "tanggal_daftar")


@dataclass(frozen=True)
class WarehouseOptions:
    """``key_kind``: see ``surrogate_key``.  ``enrolment_dates`` adds the enrolment
    dates to the date dimension; they pass no date gate, so its size is then left
    to the optimizer.  ``hot_keys``, ``salts``: see ``build_fact``.  ``look_up_keys``:
    fetch every fact key from its dimension, also those that can be computed."""

    key_kind: KeyKind = "md5_60"
    enrolment_dates: bool = False
    hot_keys: int = 0
    salts: int | None = None
    look_up_keys: bool = False


def dim_waktu(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """D1."""
    dates = list(EVENT_DATES.items()) + ([ENROLMENT_DATE] if options.enrolment_dates else [])
    return date_dimension(
        [(staging[table], column) for table, column in dates], v.MONTH_NAMES, options.key_kind
    )


def dim_platform(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """D2."""
    return staging["kamus_platform"].select(
        surrogate_key(F.col("id_platform"), options.key_kind).alias("platform_key"),
        "id_platform",
        "nama_platform",
        "jenis_platform",
    )


def dim_pengguna(staging: Tables, platforms: DataFrame, options: WarehouseOptions) -> DataFrame:
    """D3: one row per person, with the attributes of the first of their accounts.

    First means by platform name and then by account id.
    """
    people = pick_per_entity(
        staging["peta_pengguna_lintas_platform"],
        "id_pengguna_global",
        ["nama_platform", "id_pengguna_platform"],
        ["nama_platform", "nama_standar", "email_asli", "provinsi_standar", "tanggal_daftar"],
    )
    # the platform dimension is the configured list of platforms
    rows = lookup(
        people, bounded(platforms), {"nama_platform": "nama_platform"}, ["platform_key"]
    )
    return rows.select(
        surrogate_key(F.col("id_pengguna_global"), options.key_kind).alias("pengguna_key"),
        F.col("id_pengguna_global").alias("id_pengguna_sumber"),
        "platform_key",
        F.col("nama_standar").alias("nama_pengguna"),
        F.col("email_asli").alias("email"),
        F.col("provinsi_standar").alias("provinsi"),
        "tanggal_daftar",
    )


def dim_kelas(
    staging: Tables,
    platforms: DataFrame,
    subjects: DataFrame,
    levels: DataFrame,
    options: WarehouseOptions,
) -> DataFrame:
    """One row per global course; a merged course has its first platform."""
    columns = [
        "id_kelas_global",
        "id_platform",
        "id_kelas_platform",
        "nama_kelas_standar",
        "mata_pelajaran_standar",
        "jenjang_standar",
        "tingkat_kesulitan_standar",
    ]
    rows = dedup_by_key(
        staging["peta_kelas_lintas_platform"].select(*columns),
        ["id_kelas_global"],
        ["id_platform", "id_kelas_platform"],
    )
    rows = lookup(rows, bounded(platforms), {"id_platform": "id_platform"}, ["platform_key"])
    rows = lookup(
        rows, subjects, {"mata_pelajaran_standar": "nama_mata_pelajaran"}, ["mata_pelajaran_key"]
    )
    rows = lookup(rows, levels, {"jenjang_standar": "nama_jenjang"}, ["jenjang_key"])
    return rows.select(
        surrogate_key(F.col("id_kelas_global"), options.key_kind).alias("kelas_key"),
        F.col("id_kelas_global").alias("id_kelas_sumber"),
        "platform_key",
        F.col("nama_kelas_standar").alias("nama_kelas"),
        "mata_pelajaran_key",
        "jenjang_key",
        "tingkat_kesulitan_standar",
    )


def dim_perangkat(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """The known devices."""
    return value_dimension(
        [
            (staging["olah_aktivitas_belajar"], "perangkat_standar"),
            (staging["olah_ulasan"], "perangkat_standar"),
        ],
        "kategori_perangkat",
        "perangkat_key",
        keep=F.lower("kategori_perangkat") != F.lit(v.UNKNOWN_DEVICE),
        key_kind=options.key_kind,
    )


def dim_paket(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """The packages among the three standard ones."""
    standard = staging["olah_transaksi"].select(
        v.PACKAGE(F.col("nama_paket_standar")).alias("jenis_paket")
    )
    return value_dimension(
        [(standard, "jenis_paket")],
        "jenis_paket",
        "paket_key",
        keep=F.col("jenis_paket").isin(*v.PACKAGE_LABELS),
        key_kind=options.key_kind,
    )


def dim_metode_bayar(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """D7.  The categories are looked up by the standard method names, of which
    the dictionary lists only some; the others are "lainnya"."""
    return value_dimension(
        [(staging["olah_transaksi"], "metode_bayar_standar")],
        "nama_metode",
        "metode_bayar_key",
        {"kategori_metode": v.METHOD_CATEGORY(F.col("nama_metode"))},
        key_kind=options.key_kind,
    )


def dim_mata_pelajaran(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """D8."""
    name = F.col("nama_mata_pelajaran")
    category = category_of(name, v.SUBJECT_CATEGORIES, v.OTHER_SUBJECT_CATEGORY)
    return (
        staging["kamus_mata_pelajaran"]
        .select(F.col("nama_mapel_standar").alias("nama_mata_pelajaran"))
        .distinct()
        .select(
            surrogate_key(name, options.key_kind).alias("mata_pelajaran_key"),
            name,
            category.alias("kategori"),
        )
    )


def dim_jenjang(staging: Tables, options: WarehouseOptions) -> DataFrame:
    """D9."""
    rank = ordinal_rank(F.col("nama_jenjang"), v.SCHOOL_LEVEL_RANKS, v.OTHER_SCHOOL_LEVEL_RANK)
    return value_dimension(
        [
            (staging["peta_pengguna_lintas_platform"], "jenjang_standar"),
            (staging["peta_kelas_lintas_platform"], "jenjang_standar"),
        ],
        "nama_jenjang",
        "jenjang_key",
        {"tingkat": rank},
        key_kind=options.key_kind,
    )


def build_dimensions(
    staging: Tables, options: WarehouseOptions = WarehouseOptions()
) -> dict[str, DataFrame]:
    """All dimensions, lazily.  Each is built once and handed to those that refer to it."""
    platforms = dim_platform(staging, options)
    subjects = dim_mata_pelajaran(staging, options)
    levels = dim_jenjang(staging, options)
    built = {
        "dim_waktu": dim_waktu(staging, options),
        "dim_platform": platforms,
        "dim_pengguna": dim_pengguna(staging, platforms, options),
        "dim_mata_pelajaran": subjects,
        "dim_jenjang": levels,
        "dim_kelas": dim_kelas(staging, platforms, subjects, levels, options),
        "dim_paket": dim_paket(staging, options),
        "dim_metode_bayar": dim_metode_bayar(staging, options),
        "dim_perangkat": dim_perangkat(staging, options),
    }
    return {name: built[name] for name in DIMENSIONS}


# dimensions whose rows are values of event tables, and can only grow
EVENT_DIMENSIONS = ("dim_waktu", "dim_paket", "dim_metode_bayar", "dim_perangkat")
NATURAL_KEYS = {
    "dim_waktu": ("waktu_key", "tanggal"),
    "dim_platform": ("platform_key", "id_platform"),
    "dim_pengguna": ("pengguna_key", "id_pengguna_sumber"),
    "dim_mata_pelajaran": ("mata_pelajaran_key", "nama_mata_pelajaran"),
    "dim_jenjang": ("jenjang_key", "nama_jenjang"),
    "dim_kelas": ("kelas_key", "id_kelas_sumber"),
    "dim_paket": ("paket_key", "jenis_paket"),
    "dim_metode_bayar": ("metode_bayar_key", "nama_metode"),
    "dim_perangkat": ("perangkat_key", "kategori_perangkat"),
}


def dimension_keys(dimensions: Tables) -> dict[str, tuple[DataFrame, str, str]]:
    """What each surrogate key stands for, for ``collision_report``."""
    return {name: (df, *NATURAL_KEYS[name]) for name, df in dimensions.items() if name in NATURAL_KEYS}


def _day(column: str) -> KeyLookup:
    # the gate ends the days at ``as_of``, and the dimension is made of these very days
    return KeyLookup("dim_waktu", "waktu_key", column, "tanggal", size_bounded=True, always_there=True)


# an enrolment may lie on a day without any event, and its date passes no gate
_ENROLMENT_DAY = KeyLookup("dim_waktu", "waktu_key", "tanggal_daftar", "tanggal")
# one row per configured platform
_PLATFORM = KeyLookup(
    "dim_platform", "platform_key", "id_platform", "id_platform", size_bounded=True, always_there=True
)
# the bridges that resolved an event's user and course are what these dimensions are made of
_USER = KeyLookup(
    "dim_pengguna", "pengguna_key", "id_pengguna_global", "id_pengguna_sumber", always_there=True
)
_COURSE = KeyLookup(
    "dim_kelas", "kelas_key", "id_kelas_global", "id_kelas_sumber", always_there=True
)
# devices, packages and methods are the values of fixed dictionaries
_DEVICE = KeyLookup(
    "dim_perangkat", "perangkat_key", "perangkat_standar", "kategori_perangkat", size_bounded=True
)
_PACKAGE = KeyLookup(
    "dim_paket", "paket_key", "nama_paket_standar", "jenis_paket", size_bounded=True
)
_METHOD = KeyLookup(
    "dim_metode_bayar", "metode_bayar_key", "metode_bayar_standar", "nama_metode", size_bounded=True
)


@dataclass(frozen=True)
class FactTable:
    events: str
    lookups: tuple[KeyLookup, ...]
    columns: tuple[Flag, ...]


def _as_is(column: str, name: str | None = None) -> Flag:
    return Flag(name or column, F.col(column))


def _is(column: str, wanted: str, name: str) -> Flag:
    return Flag(name, equality_flag(F.col(column), wanted))


def fact_tables() -> dict[str, FactTable]:
    """X1-X5.  A function, because columns need a running session."""
    state, paid = "status_pendaftaran_standar", "status_bayar_standar"
    return {
        "fakta_pendaftaran_program": FactTable(
            "olah_pendaftaran_program",
            (_ENROLMENT_DAY, _PLATFORM, _USER, _COURSE),
            (
                _as_is("id_pendaftaran", "id_pendaftaran_sumber"),
                _as_is(state, "status_pendaftaran"),
                _is(state, "aktif", "aktif_flag"),
                _is(state, "batal", "batal_flag"),
            ),
        ),
        "fakta_aktivitas_belajar": FactTable(
            "olah_aktivitas_belajar",
            (_day("tanggal_aktivitas"), _PLATFORM, _USER, _COURSE, _DEVICE),
            (
                _as_is("id_aktivitas", "id_aktivitas_sumber"),
                Flag("durasi_menit", whole_number(F.col("durasi_belajar_menit"))),
            ),
        ),
        "fakta_hasil_latihan": FactTable(
            "olah_hasil_latihan",
            (_day("tanggal_latihan"), _PLATFORM, _USER, _COURSE),
            (
                _as_is("id_hasil", "id_hasil_sumber"),
                _as_is("nilai_standar"),
                _as_is("status_lulus"),
                _is("status_lulus", "lulus", "lulus_flag"),
            ),
        ),
        "fakta_transaksi": FactTable(
            "olah_transaksi",
            (_day("tanggal_transaksi"), _PLATFORM, _USER, _PACKAGE, _METHOD),
            (
                _as_is("id_transaksi", "id_transaksi_sumber"),
                _as_is("jumlah_bayar"),
                _as_is(paid, "status_bayar"),
                _is(paid, "berhasil", "berhasil_flag"),
                _is(paid, "gagal", "gagal_flag"),
                _is(paid, "pending", "pending_flag"),
            ),
        ),
        "fakta_ulasan": FactTable(
            "olah_ulasan",
            (_day("tanggal_ulasan"), _PLATFORM, _USER, _COURSE),
            (
                _as_is("id_ulasan", "id_ulasan_sumber"),
                _as_is("rating_standar_5"),
                Flag("komentar_tersedia_flag", presence_flag(F.col("komentar"))),
            ),
        ),
    }


def fact_orphans(facts: Tables, dimensions: Tables) -> DataFrame:
    """Computed fact keys that are in no row of their dimension, with their number of rows.

    An event of a user or course that has left the sources since is the one way
    to get one, because the bridges are replaced in every run.
    """
    plans = fact_tables()
    return union_all(
        orphan_keys(df, item.key, dimensions[item.dimension], item.key).select(
            F.lit(name).alias("table_name"), F.lit(item.key).alias("key_name"), F.col(item.key).alias("key"), "n_rows"
        )
        for name, df in facts.items()
        for item in plans[name].lookups
        if item.always_there
    )


def build_facts(
    staging: Tables, dimensions: Tables, options: WarehouseOptions = WarehouseOptions()
) -> dict[str, DataFrame]:
    return {
        name: build_fact(
            staging[fact.events],
            dimensions,
            fact.lookups,
            fact.columns,
            hot_keys=options.hot_keys,
            salts=options.salts,
            computed_keys=None if options.look_up_keys else options.key_kind,
        )
        for name, fact in fact_tables().items()
    }
