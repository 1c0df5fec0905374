"""Staging tables, dimensions and facts of the integration, over the derived sources."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumbung.operators.conform import union_all
from lumbung.operators.dimensions import date_dimension, value_dimension
from lumbung.operators.facts import build_fact
from lumbung.operators.lookup import bounded, lookup
from lumbung.plans import warehouse as w
from lumbung.plans.fixed_values import MONTH_NAMES, UNKNOWN_DEVICE
from lumbung.plans.pipeline import PipelineConfig, run_pipeline
from lumbung.functions.identity import collision_report
from lumbung.plans.schemas import (
    DIMENSIONS,
    FACT_DIMENSION_KEYS,
    FACT_EVENT_IDS,
    FACTS,
    SOURCES,
    STAGING,
)
from lumbung.plans.staging import (
    EVENT_TABLES,
    Slice,
    StagingOptions,
    bridge_keys,
    build_all_events,
    build_events,
    build_references,
    course_bridge,
    held_events,
    in_slice,
    rejected_events,
    slices,
    user_bridge,
)
from lumbung.sources.paths import bytes_below
from lumbung.sources.readers import TableSource
from lumbung.sources.stores import ParquetStore, shared_folder
from workload.derived_sources import derived_sources
from workload.registry import query
from workload.star_oracles import AS_OF, statement, whole

STAGING_OPTIONS = StagingOptions(as_of=dt.date.fromisoformat(AS_OF))
OPTIONS = w.WarehouseOptions()
# from so many bytes of given tables on, event tables are staged in slices of their ids: few, as each reads the tables again
SLICE_BYTES, MOST_SLICES = 1 << 30, 2
BATCHES = ("BATCH-20240120-000000", "BATCH-20240121-000000")


def _event_slices(spark: SparkSession, sf_dir: str) -> list[Slice | None]:
    """Every slice reads the given tables again, so there are few however large these are."""
    given = sum(bytes_below(spark, f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders", "events"))
    return slices(min(MOST_SLICES, 1 + given // SLICE_BYTES))


def stage(
    spark: SparkSession,
    sf_dir: str,
    events: Iterable[str] = (),
    store: ParquetStore | None = None,
    read_once: Iterable[str] = (),
    columns: Mapping[str, Iterable[str]] | None = None,
) -> dict[str, DataFrame]:
    """The dictionaries, the bridges and the named event tables.

    With a store they are written to it and read back, as the pipeline does, but for
    event tables that are ``read_once``: these go to their reader without files between.
    Event tables are written one after another, as each fills the cluster and what it shuffles
    goes with its write.  ``columns``: those that are read of a table (default all).
    Event tables of large inputs are written in slices, with or without a store and a reader of their own.
    """
    sources = derived_sources(spark, sf_dir)
    parts = _event_slices(spark, sf_dir) if events else slices(1)
    if len(parts) > 1:
        store, read_once = store or ParquetStore(spark, shared_folder(spark, "staging")), ()
    references = write_all(store, build_references(spark, sources))
    if len(parts) > 1:
        users, courses = references["peta_pengguna_lintas_platform"], references["peta_kelas_lintas_platform"]

        def sliced(name: str) -> Iterable[DataFrame]:
            read = (columns or {}).get(name)
            return (build_events(name, sources, users, courses, STAGING_OPTIONS, None, read, part) for part in parts)

        return {**references, **{name: store.write_parts(name, sliced(name)) for name in events}}
    staged = build_all_events(sources, references, STAGING_OPTIONS, events, columns=columns)
    if store is not None:
        staged = {name: df if name in read_once else store.write(name, df) for name, df in staged.items()}
    return {**references, **staged}


def _read_once(readers: Iterable[Iterable[str]]) -> set[str]:
    """The event tables that only one of the readers reads."""
    reads = Counter(chain.from_iterable(readers))
    return {name for name, n in reads.items() if n == 1}


def write_all(store: ParquetStore | None, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    if store is None:
        return tables
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(tables, pool.map(lambda name: store.write(name, tables[name]), tables)))


# ---- T2-T9.  The platform dictionary is a literal of four rows; it is no query
# of its own and is seen through the tables that refer to it.


def _register_staging(name: str) -> None:
    events = [name] if name in EVENT_TABLES else []

    @query(f"staging_{name}", whole(name))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stage(spark, sf_dir, events)[name]


for _name in STAGING:
    if _name != "kamus_platform":
        _register_staging(_name)


# ---- Q9 over the real gates


def _reject_reasons(kind: str, id_column: str, day: str, measure: str, low_high: str) -> str:
    course = "" if kind == "transaksi" else "WHEN id_kelas_global IS NULL THEN 'id_kelas_global is missing'"
    gates = (
        ""
        if kind == "pendaftaran"
        else f"WHEN (tanggal <= DATE '{AS_OF}') IS NOT TRUE THEN '{day} is missing or in the future'"
        f" WHEN ({low_high}) IS NOT TRUE THEN '{measure} is out of range'"
    )
    return (
        f"SELECT '{id_column}' AS event_id, id_platform, CASE {gates}"
        f" WHEN id IS NULL THEN '{id_column} is missing'"
        f" WHEN id_pengguna_global IS NULL THEN 'id_pengguna_global is missing' {course}"
        f" END AS reject_reason FROM resolved_{kind}"
    )


_REASONS = " UNION ALL ".join(
    _reject_reasons(*row)
    for row in (
        ("aktivitas", "id_aktivitas", "tanggal_aktivitas", "durasi_belajar_menit", "durasi >= 0"),
        ("latihan", "id_hasil", "tanggal_latihan", "nilai_standar", "nilai_standar BETWEEN 0 AND 100"),
        ("transaksi", "id_transaksi", "tanggal_transaksi", "jumlah_bayar", "jumlah_bayar >= 0"),
        ("ulasan", "id_ulasan", "tanggal_ulasan", "rating_standar_5", "rating_standar_5 BETWEEN 1 AND 5"),
        ("pendaftaran", "id_pendaftaran", "tanggal_daftar", "", ""),
    )
)


@query(
    "rejected_events",
    statement(
        f"SELECT event_id, id_platform, reject_reason, count(*) AS n_rows FROM ({_REASONS})"
        " WHERE reject_reason IS NOT NULL GROUP BY ALL"
    ),
)
def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = derived_sources(spark, sf_dir)
    # written first, as five tables use them
    bridges = {"users": user_bridge(sources), "courses": course_bridge(sources)}
    written = write_all(ParquetStore(spark, shared_folder(spark, "rejected")), bridges)
    users, courses = written["users"], written["courses"]
    return union_all(
        rejected_events(name, sources, users, courses, STAGING_OPTIONS).select(
            F.lit(table.id).alias("event_id"), "id_platform", "reject_reason", "n_rows"
        )
        for name, table in EVENT_TABLES.items()
    )


@query("quarantine_replay", statement("SELECT id_hasil FROM olah_hasil_latihan"))
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: half of the users come a batch after their results; the held results are admitted then, once each."""
    name, sources = "olah_hasil_latihan", derived_sources(spark, sf_dir)
    store = ParquetStore(spark, shared_folder(spark, "quarantine"))
    written = write_all(store, {"users": user_bridge(sources), "courses": course_bridge(sources)})
    users, courses = written["users"], written["courses"]
    known = users.where(F.md5("email_hash") < "8")
    parts = _event_slices(spark, sf_dir)
    store.write_parts(
        "held", (held_events(name, sources, known, courses, BATCHES[0], STAGING_OPTIONS, part=p) for p in parts)
    )
    first = store.write_parts("first", (build_events(name, sources, known, courses, STAGING_OPTIONS, part=p) for p in parts))
    nothing = {code: {t: df.where("false") for t, df in tables.items()} for code, tables in sources.items()}
    held = store.read("held")
    admitted = (build_events(name, nothing, users, courses, STAGING_OPTIONS, held, part=p) for p in parts)
    late = next(admitted) if len(parts) == 1 else store.write_parts("late", admitted)
    return first.unionByName(late).select("id_hasil")


# ---- D1-D9


def _platforms(staging: dict) -> DataFrame:
    return w.dim_platform(staging, OPTIONS)


def _courses(staging: dict) -> DataFrame:
    return w.dim_kelas(
        staging,
        _platforms(staging),
        w.dim_mata_pelajaran(staging, OPTIONS),
        w.dim_jenjang(staging, OPTIONS),
        OPTIONS,
    )


DIMENSION_BUILDERS: dict[str, Callable[[dict], DataFrame]] = {
    "dim_waktu": lambda s: w.dim_waktu(s, OPTIONS),
    "dim_platform": _platforms,
    "dim_pengguna": lambda s: w.dim_pengguna(s, _platforms(s), OPTIONS),
    "dim_kelas": _courses,
    "dim_mata_pelajaran": lambda s: w.dim_mata_pelajaran(s, OPTIONS),
    "dim_jenjang": lambda s: w.dim_jenjang(s, OPTIONS),
    "dim_perangkat": lambda s: w.dim_perangkat(s, OPTIONS),
    "dim_paket": lambda s: w.dim_paket(s, OPTIONS),
    "dim_metode_bayar": lambda s: w.dim_metode_bayar(s, OPTIONS),
}
# the event tables each dimension is made of, and the column of each that holds its values
DIMENSION_VALUES = {
    "dim_waktu": w.EVENT_DATES,
    "dim_perangkat": {"olah_aktivitas_belajar": "perangkat_standar", "olah_ulasan": "perangkat_standar"},
    "dim_paket": {"olah_transaksi": "nama_paket_standar"},
    "dim_metode_bayar": {"olah_transaksi": "metode_bayar_standar"},
}
DIMENSION_EVENTS = {name: tuple(values) for name, values in DIMENSION_VALUES.items()}


def _read_columns(dimensions: Iterable[str]) -> dict[str, set[str]]:
    """The columns that the dimensions read of each event table."""
    columns: dict[str, set[str]] = {}
    for name in dimensions:
        for table, column in DIMENSION_VALUES.get(name, {}).items():
            columns.setdefault(table, set()).add(column)
    return columns


def _register_dimension(name: str) -> None:
    @query(name, whole(name))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        columns = _read_columns([name])
        # several event tables are written one by one, a column each, so that their shuffles do not lie on disk together
        store = ParquetStore(spark, shared_folder(spark, name)) if len(columns) > 1 else None
        return DIMENSION_BUILDERS[name](stage(spark, sf_dir, columns, store, columns=columns))


for _name in DIMENSIONS:
    if _name != "dim_platform":
        _register_dimension(_name)


@query(
    "platform_usage",
    statement(
        "SELECT p.platform_key, p.id_platform, p.nama_platform, p.jenis_platform,"
        " count(u.id_pengguna_global) AS n_accounts FROM dim_platform p"
        " LEFT JOIN peta_pengguna_lintas_platform u USING (nama_platform) GROUP BY ALL"
    ),
)
def platform_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/D2 beside the number of accounts on each platform."""
    staging = stage(spark, sf_dir)
    accounts = staging["peta_pengguna_lintas_platform"].groupBy("nama_platform").agg(F.count(F.lit(1)).alias("n_accounts"))
    return (
        _platforms(staging)
        .join(accounts, "nama_platform", "left")
        .select(
            "platform_key",
            "id_platform",
            "nama_platform",
            "jenis_platform",
            F.coalesce("n_accounts", F.lit(0)).alias("n_accounts"),
        )
    )


# ---- X1-X5.  As in the pipeline, staging tables that are used several times are
# written to the shared folder first, and so are the bridges.


def _register_fact(name: str) -> None:
    @query(name, whole(name))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _fact(spark, sf_dir, name, OPTIONS)


def _fact(spark: SparkSession, sf_dir: str, name: str, options: w.WarehouseOptions) -> DataFrame:
    """One fact table; besides its own events only those are staged that a lookup needs."""
    fact = w.fact_tables()[name]
    looked_up = [item for item in fact.lookups if options.look_up_keys or not item.always_there]
    wanted = {item.dimension for item in looked_up}
    events = {fact.events} | (set(w.EVENT_DATES) if "dim_waktu" in wanted else set())
    store = ParquetStore(spark, shared_folder(spark, name))
    readers = [(fact.events,), *(set(DIMENSION_EVENTS.get(item, ())) & {*events} for item in wanted)]
    if "dim_perangkat" in wanted and fact.events not in DIMENSION_EVENTS["dim_perangkat"]:
        readers.append((fact.events,))  # in place of the tables that are not staged
    # the fact reads its own events whole and, where no dimension reads them, without files between
    columns = {table: names for table, names in _read_columns(wanted).items() if table != fact.events}
    staging = stage(spark, sf_dir, sorted(events), store, _read_once(readers) & {fact.events}, columns)
    # a device that the table's own events do not have is not looked up
    own = {table: staging[fact.events] for table in ("olah_aktivitas_belajar", "olah_ulasan") if table not in staging}
    dimensions = write_all(store, {name: DIMENSION_BUILDERS[name]({**own, **staging}) for name in wanted})
    computed = None if options.look_up_keys else options.key_kind
    parts = _event_slices(spark, sf_dir) if options.look_up_keys else slices(1)  # computed keys shuffle nothing
    built = (
        build_fact(
            in_slice(staging[fact.events], EVENT_TABLES[fact.events], part),
            dimensions,
            fact.lookups,
            fact.columns,
            computed_keys=computed,
        )
        for part in parts
    )
    return next(built) if len(parts) == 1 else store.write_parts(f"looked_up/{name}", built)


for _name in FACTS:
    _register_fact(_name)


@query("fakta_aktivitas_belajar_looked_up", whole("fakta_aktivitas_belajar"))
def activities_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key fetched from its dimension."""
    return _fact(spark, sf_dir, "fakta_aktivitas_belajar", w.WarehouseOptions(look_up_keys=True))


@query("fakta_transaksi_looked_up", whole("fakta_transaksi"))
def payments_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key fetched from its dimension."""
    return _fact(spark, sf_dir, "fakta_transaksi", w.WarehouseOptions(look_up_keys=True))


# ---- I5 over the bridges and dimensions

_KEYS = {
    "peta_pengguna_lintas_platform": ("id_pengguna_global", "email_hash"),
    "peta_kelas_lintas_platform": ("id_kelas_global", "nama_kelas_standar"),
    **w.NATURAL_KEYS,
}


@query(
    "key_collisions",
    statement(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(DISTINCT {natural}) AS n_natural,"
            f" count(DISTINCT {key}) AS n_keys, (SELECT count(*) FROM (SELECT {key} FROM {name}"
            f" GROUP BY {key} HAVING count(DISTINCT {natural}) > 1)) AS n_collisions FROM {name}"
            for name, (key, natural) in _KEYS.items()
        )
    ),
)
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ParquetStore(spark, shared_folder(spark, "keys"))
    columns = _read_columns(DIMENSION_VALUES)  # no dimension is made of enrolments
    staging = stage(spark, sf_dir, columns, store, columns=columns)
    dimensions = write_all(store, {name: build(staging) for name, build in DIMENSION_BUILDERS.items()})
    return collision_report({**bridge_keys(staging), **w.dimension_keys(dimensions)})


# ---- R1-R8: two batches through the whole pipeline

_LOADED = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_in,"
    f" {'0' if name.startswith(('olah_', 'fakta_')) else 'count(*)'} AS n_new,"
    f" {'count(*)' if name.startswith(('olah_', 'fakta_')) else '0'} AS n_skipped FROM {name}"
    for name in [*STAGING, *DIMENSIONS, *FACTS]
)


def _parquet_sources(spark: SparkSession, sf_dir: str, folder: str) -> dict:
    store, derived = ParquetStore(spark, folder), derived_sources(spark, sf_dir)
    write_all(store, {f"{code}/{name}": derived[code][name] for code, tables in SOURCES.items() for name in tables})
    return {
        code: {
            name: TableSource(name, schema, "parquet", store.path(f"{code}/{name}"))
            for name, schema in tables.items()
        }
        for code, tables in SOURCES.items()
    }


@query("pipeline_second_run", statement(_LOADED))
def pipeline_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load metrics of a second, identical run: nothing new in events and facts."""
    folder = shared_folder(spark, "pipeline")
    sources = _parquet_sources(spark, sf_dir, f"{folder}/given")
    for batch in BATCHES:
        config = PipelineConfig(sources, folder, batch, STAGING_OPTIONS, fact_scope="all")
        summary = run_pipeline(spark, config)
    return summary.as_frame(spark)


# ---- two different batches: the first has the events of half of the ids


def _row_text(names: Iterable[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({name} AS {{text}}), '~')" for name in names) + ")"


def _names(table: str) -> list[str]:
    # parsed here, because there is no session yet when the SQL is made
    return re.findall(r"(?:^|, )(\w+) ", {**DIMENSIONS, **FACTS}[table])


def _rows_sql(table: str, source: str, test: str = "") -> str:
    shown = _row_text(_names(table)).format(text="VARCHAR")
    return f"SELECT '{table}' AS table_name, {shown} AS row_text FROM {source} {test}"


_WITH_ENROLMENT_DAYS = {"dim_waktu": "dim_waktu_all", "fakta_pendaftaran_program": "fakta_pendaftaran_all"}
_ONE_LOAD = {name: _WITH_ENROLMENT_DAYS.get(name, name) for name in [*DIMENSIONS, *FACTS]}


def _first_of_its_keys(table: str, source: str) -> str:
    """Rows of the first batch, and later ones whose dimension keys it does not have."""
    early = f"md5(substr({FACT_EVENT_IDS[table]}, 7)) < '8'"
    keys = _row_text(FACT_DIMENSION_KEYS[table]).format(text="VARCHAR")
    first = _rows_sql(table, source, f"WHERE {early}")
    later = f"(SELECT *, {keys} AS key_text FROM {source} WHERE ({early}) IS NOT TRUE)"
    seen = f"(SELECT DISTINCT {keys} AS key_text FROM {source} WHERE {early})"
    return f"{first} UNION ALL {_rows_sql(table, f'{later} ANTI JOIN {seen} USING (key_text)')}"


def _two_batches(spark: SparkSession, sf_dir: str, fact_key: str) -> DataFrame:
    folder = shared_folder(spark, "batches")
    whole_ = _parquet_sources(spark, sf_dir, f"{folder}/given")
    half = {code: dict(tables) for code, tables in whole_.items()}
    store, events = ParquetStore(spark, f"{folder}/given/half"), _event_tables()

    def early(code: str, name: str) -> DataFrame:
        id_ = StructType.fromDDL(SOURCES[code][name]).fieldNames()[0]
        return spark.read.parquet(whole_[code][name].path).where(F.md5(id_) < "8")

    write_all(store, {f"{code}/{name}": early(code, name) for code, names in events.items() for name in names})
    for code, names in events.items():
        for name in names:
            # asked for after the write: the commit says where the rows are
            half[code][name] = TableSource(name, SOURCES[code][name], "parquet", store.path(f"{code}/{name}"))
    options = w.WarehouseOptions(enrolment_dates=True)
    for batch, sources in zip(BATCHES, (half, whole_)):
        run_pipeline(spark, PipelineConfig(sources, folder, batch, STAGING_OPTIONS, options, fact_key))
    loaded = ParquetStore(spark, f"{folder}/warehouse")
    return union_all(
        loaded.read(name).select(
            F.lit(name).alias("table_name"), F.expr(_row_text(_names(name)).format(text="STRING")).alias("row_text")
        )
        for name in _ONE_LOAD
    )


def _event_tables() -> dict[str, list[str]]:
    tables: dict[str, list[str]] = {code: [] for code in SOURCES}
    for table in EVENT_TABLES.values():
        for code, spec in table.sources(STAGING_OPTIONS).items():
            tables[code].append(spec.table)
    return tables


@query("pipeline_two_batches", statement(" UNION ALL ".join(_rows_sql(n, s) for n, s in _ONE_LOAD.items())))
def pipeline_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every dimension and fact after two loads, which is what one load of all gives."""
    return _two_batches(spark, sf_dir, "event")


@query(
    "pipeline_dimension_keys",
    statement(
        " UNION ALL ".join(
            _first_of_its_keys(n, s) if n in FACTS else _rows_sql(n, s) for n, s in _ONE_LOAD.items()
        )
    ),
)
def pipeline_dimension_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a fact row counts as loaded if its dimension keys are."""
    return _two_batches(spark, sf_dir, "dimensions")


# ---- the flagship: activity facts by month and platform


@query(
    "monthly_activity",
    statement(
        "SELECT w.tahun, w.bulan, w.nama_bulan, p.nama_platform, count(*) AS n_activities,"
        " sum(f.durasi_menit)::BIGINT AS minutes,"
        " sum(CASE WHEN f.perangkat_key IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_unknown_device"
        " FROM fakta_aktivitas_belajar f JOIN dim_waktu w USING (waktu_key)"
        " JOIN dim_platform p USING (platform_key) GROUP BY ALL"
    ),
)
def monthly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activities are staged once; dimensions and facts are built from them."""
    store, name = ParquetStore(spark, shared_folder(spark, "activity")), "olah_aktivitas_belajar"
    read = ["id_platform", "tanggal_aktivitas", "durasi_belajar_menit", "perangkat_standar"]
    staging = stage(spark, sf_dir, [name], store, columns={name: read})
    events = staging[name]
    days = date_dimension([(events, "tanggal_aktivitas")], MONTH_NAMES)
    devices = value_dimension(
        [(events, "perangkat_standar")],
        "kategori_perangkat",
        "perangkat_key",
        keep=F.col("kategori_perangkat") != UNKNOWN_DEVICE,
    )
    platforms = _platforms(staging)
    fact = w.fact_tables()["fakta_aktivitas_belajar"]
    facts = build_fact(
        events,
        {"dim_waktu": days, "dim_platform": platforms, "dim_perangkat": devices},
        [item for item in fact.lookups if item.size_bounded],
        [item for item in fact.columns if item.name == "durasi_menit"],
    )
    # one row per calendar day, and one per configured platform
    named = lookup(
        facts, bounded(days), {"waktu_key": "waktu_key"}, ["tahun", "bulan", "nama_bulan"], "inner"
    )
    named = lookup(
        named, bounded(platforms), {"platform_key": "platform_key"}, ["nama_platform"], "inner"
    )
    return named.groupBy("tahun", "bulan", "nama_bulan", "nama_platform").agg(
        F.count(F.lit(1)).alias("n_activities"),
        F.sum("durasi_menit").alias("minutes"),
        F.sum(F.when(F.col("perangkat_key").isNull(), 1).otherwise(0)).alias("n_unknown_device"),
    )
