"""The staging tables (T1-T9): dictionaries, bridges and conformed events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumbung.functions import global_id, literal_tags, packed_id, standardize, unpacked_id
from lumbung.operators.conform import union_all
from lumbung.operators.dedup import dedup_by_key
from lumbung.operators.gate import (
    Rule,
    at_least,
    not_after,
    quality_gate,
    reject_report,
    required,
    tag_rejects,
    within,
)
from lumbung.operators.lookup import lookup, salted_lookup
from lumbung.plans import catalog
from lumbung.plans.catalog import COURSE_ID, USER_ID, TableFields
from lumbung.plans.fields import key, project
from lumbung.plans.fixed_values import PLATFORMS
from lumbung.plans.schemas import STAGING
from lumbung.sources.readers import literal_table

# source code -> table name -> frame
Sources = Mapping[str, Mapping[str, DataFrame]]
# a slice of the event ids: its number, and that of all slices
Slice = tuple[int, int]


@dataclass(frozen=True)
class EventTable:
    """One conformed event table: its id, its date and what a row has to satisfy."""

    name: str
    id: str
    sources: Callable[["StagingOptions"], Mapping[str, TableFields]]
    rules: Callable[[dt.date | None], Sequence[Rule]]
    has_course: bool = True


@dataclass(frozen=True)
class StagingOptions:
    """``as_of``: the day after which an event date is a mistake (default today).

    ``review_device_columns``: more names to look for a review's device.
    ``hot_keys``: salt that many of the most frequent users and courses in the
    bridge lookups; 0 leaves skew to adaptive execution.  ``salts``: see
    ``salted_lookup``.  ``id_digits``: see ``global_id``.  ``hash_bridges``: the bridges of
    events are hashed in each shuffle partition, so the plan is the same at every size; without
    it the optimizer decides, which broadcasts small bridges and shuffles no event for them.
    """

    as_of: dt.date | None = None
    review_device_columns: tuple[str, ...] = ()
    hot_keys: int = 0
    salts: int | None = None
    id_digits: int = 32
    hash_bridges: bool = True


EVENT_TABLES = {
    table.name: table
    for table in (
        EventTable(
            "olah_aktivitas_belajar",
            "id_aktivitas",
            lambda options: catalog.ACTIVITY_SOURCES,
            lambda day: [not_after("tanggal_aktivitas", day), at_least("durasi_belajar_menit", 0)],
        ),
        EventTable(
            "olah_hasil_latihan",
            "id_hasil",
            lambda options: catalog.RESULT_SOURCES,
            lambda day: [not_after("tanggal_latihan", day), within("nilai_standar", 0, 100)],
        ),
        EventTable(
            "olah_transaksi",
            "id_transaksi",
            lambda options: catalog.PAYMENT_SOURCES,
            lambda day: [not_after("tanggal_transaksi", day), at_least("jumlah_bayar", 0)],
            has_course=False,
        ),
        EventTable(
            "olah_ulasan",
            "id_ulasan",
            lambda options: catalog.review_sources(options.review_device_columns),
            lambda day: [not_after("tanggal_ulasan", day), within("rating_standar_5", 1, 5)],
        ),
        EventTable(
            "olah_pendaftaran_program",
            "id_pendaftaran",
            lambda options: catalog.ENROLMENT_SOURCES,
            lambda day: [],
        ),
    )
}


def platform_dictionary(spark: SparkSession) -> DataFrame:
    """T1."""
    rows = [(id_, name, kind, f"Platform {name}") for id_, name, kind in PLATFORMS.values()]
    return literal_table(spark, rows, STAGING["kamus_platform"])


def subject_dictionary(sources: Sources) -> DataFrame:
    """The subjects of each source with their standard names."""
    return (
        _all_courses(sources)
        .select(
            F.col("mata_pelajaran_standar").alias("nama_mapel_standar"),
            F.col("mata_pelajaran_sumber").alias("nama_mapel_sumber"),
            "nama_platform",
        )
        .distinct()
    )


def user_bridge(sources: Sources, options: StagingOptions = StagingOptions()) -> DataFrame:
    """Who is who.  Equal addresses on several platforms are one person.

    The global id follows from the address alone, so no row has to be compared
    with another one; users without an address have no identity and are left out.
    """
    users = union_all(
        _tagged(project(sources[code][spec.table], spec.fields), code)
        for code, spec in catalog.USERS.items()
    )
    return (
        users.where(F.col("email_hash").isNotNull())
        .withColumns(
            {
                "id_pengguna_global": global_id("USR-", F.col("email_hash"), options.id_digits),
                "confidence_score": F.lit(1).cast("decimal(3,2)"),
            }
        )
        .select(*_names("peta_pengguna_lintas_platform"))
    )


def course_bridge(sources: Sources, options: StagingOptions = StagingOptions()) -> DataFrame:
    """T4: courses of equal subject, school level and difficulty are one course."""
    grade = F.concat_ws(" ", "jenjang_standar", "tingkat_kesulitan_standar")
    return (
        _all_courses(sources)
        .withColumn(
            "nama_kelas_standar", F.concat_ws(" - ", F.col("mata_pelajaran_standar"), grade)
        )
        .withColumn("id_kelas_global", global_id("KLS-", F.col("nama_kelas_standar"), options.id_digits))
        .select(*_names("peta_kelas_lintas_platform"))
    )


def raw_events(table: EventTable, sources: Sources, options: StagingOptions) -> DataFrame:
    """The conformed rows of all sources, before any lookup or gate."""
    frames = []
    for code, spec in table.sources(options).items():
        fields = {**spec.fields, "id_pengguna_platform": key(USER_ID[code])}
        if table.has_course:
            fields["id_kelas_platform"] = key(COURSE_ID[code])
        frames.append(_tagged(project(sources[code][spec.table], fields), code))
    return union_all(frames)


def resolve_events(
    events: DataFrame,
    users: DataFrame,
    courses: DataFrame | None,
    how: str = "inner",
    hot_keys: int = 0,
    salts: int | None = None,
    hash_bridges: bool = True,
) -> DataFrame:
    """Replace platform ids by global ids.

    A row without user or course is rejected anyway, so the joins are inner
    joins unless the rejects are to be reported.  With ``hash_bridges`` each shuffle partition
    hashes its part of a bridge, so the events are not sorted.  Courses come first: their
    few different global ids cost the second shuffle little, those of users much.
    """

    names = {name: id_ for id_, name, _ in PLATFORMS.values()}

    def fetch(rows: DataFrame, bridge: DataFrame, id_: str, global_id_: str) -> DataFrame:
        # by the platform's id, which the events keep, so that its name goes through no shuffle for them;
        # the user or course id first: a sort compares it before the platform, which has few values
        on = {id_: id_, "id_platform": "id_platform"}
        bridge = bridge.withColumn("id_platform", standardize(F.col("nama_platform"), names))
        if hot_keys:
            return salted_lookup(
                rows, bridge, on, [global_id_], how, hot_keys=hot_keys, salts=salts, count_in=events
            )
        return lookup(rows, bridge.hint("shuffle_hash") if hash_bridges else bridge, on, [global_id_], how)

    rows = events
    if courses is not None:
        rows = fetch(rows, courses, "id_kelas_platform", "id_kelas_global")
    return fetch(rows, users, "id_pengguna_platform", "id_pengguna_global")


def event_rules(table: EventTable, options: StagingOptions) -> list[Rule]:
    keys = [table.id, "id_pengguna_global", *(["id_kelas_global"] if table.has_course else [])]
    return [*table.rules(options.as_of), *(required(name) for name in keys)]


def build_events(
    name: str,
    sources: Sources,
    users: DataFrame,
    courses: DataFrame,
    options: StagingOptions = StagingOptions(),
    held: DataFrame | None = None,
    columns: Iterable[str] | None = None,
    part: Slice | None = None,
) -> DataFrame:
    """Project, union, resolve, gate, and keep one row per event id.

    ``held`` are rows that an earlier batch delivered and the gate has kept back; they are tried again.
    ``columns`` are those that are read of the result (default all).  The row of an event is the least by
    its columns in their order, so the columns behind the last one that is read go through no shuffle.
    ``part``: only the events of one slice of the ids, see ``in_slice``.
    """
    table, names = EVENT_TABLES[name], _names(name)
    wanted = names if columns is None else [column for column in names if column in {*columns}]
    compared = names[: names.index(wanted[-1]) + 1]
    ids = {"id_pengguna_global": "USR-", **({"id_kelas_global": "KLS-"} if table.has_course else {})}
    rows = resolve_events(
        with_held(in_slice(raw_events(table, sources, options), table, part), in_slice(held, table, part), table),
        _packed(users, ids),
        _packed(courses, ids) if table.has_course else None,
        hot_keys=options.hot_keys,
        salts=options.salts,
        hash_bridges=options.hash_bridges,
    )
    accepted = quality_gate(rows, event_rules(table, options))
    kept = dedup_by_key(accepted.select(*compared), [table.id]).select(*wanted)
    unpacked = {column: unpacked_id(prefix, F.col(column)) for column, prefix in ids.items() if column in wanted}
    return kept.withColumns(unpacked)


def _packed(bridge: DataFrame, ids: Mapping[str, str]) -> DataFrame:
    """The bridge with its global id as bytes, which are less than half as much to shuffle and to sort."""
    mine = {column: packed_id(prefix, F.col(column)) for column, prefix in ids.items() if column in bridge.columns}
    return bridge.withColumns(mine)


def slices(n: int) -> list[Slice | None]:
    """All slices of ``n``; None stands for all ids."""
    return [(i, n) for i in range(n)] if n > 1 else [None]


def in_slice(rows: DataFrame | None, table: EventTable, part: Slice | None) -> DataFrame | None:
    """The rows whose event id falls into a slice; all rows of an event, and all without an id, fall into one.

    What is decided by event id can be done slice by slice.  Each reads the sources again, but lookups and
    copies shuffle only its share of the rows, and written slices need no disk for what they have shuffled.
    """
    if rows is None or part is None:
        return rows
    number, n = part
    return rows.where(F.pmod(F.xxhash64(table.id), F.lit(n)) == number)


def _marked(bridge: DataFrame, id_: str) -> DataFrame:
    """The bridge with a mark in place of a global id."""
    return bridge.withColumn(id_, F.when(F.col(id_).isNotNull(), F.lit("")))


def with_held(delivered: DataFrame, held: DataFrame | None, table: EventTable) -> DataFrame:
    """The delivered rows, and the held ones that are not delivered again."""
    if held is None:
        return delivered
    again = delivered.select(F.col(table.id).alias("__id")).distinct()
    rest = held.join(again, F.col(table.id) == F.col("__id"), "left_anti")
    return delivered.unionByName(rest.select(*delivered.columns))


def held_events(
    name: str,
    sources: Sources,
    users: DataFrame,
    courses: DataFrame,
    batch_id: str,
    options: StagingOptions = StagingOptions(),
    held: DataFrame | None = None,
    part: Slice | None = None,
) -> DataFrame:
    """Q9: the rows of one table that the gate rejects, as delivered, with the reason and the first batch.

    All different rows of an event are held, since any of them may pass later; they leave
    together once one has passed.  Rows without an id are shown for the batch that delivers
    them and not tried again.  ``part``: see ``build_events``.
    """
    table = EVENT_TABLES[name]
    delivered = in_slice(raw_events(table, sources, options), table, part)
    columns = delivered.columns
    if held is not None:
        held = in_slice(held.where(F.col(table.id).isNotNull()), table, part)
    # whether there is a global id is all that a gate asks of it
    rows = resolve_events(
        with_held(delivered, held, table),
        _marked(users, "id_pengguna_global"),
        _marked(courses, "id_kelas_global") if table.has_course else None,
        how="left",
        hot_keys=options.hot_keys,
        salts=options.salts,
        hash_bridges=options.hash_bridges,
    )
    tagged = tag_rejects(rows, event_rules(table, options))
    # of a row that passes only the id is needed: an id that one of its rows brings through the gate is not held
    kept = [F.when(F.col("reject_reason").isNotNull(), F.col(c)).alias(c) for c in columns if c != table.id]
    by_id = Window.partitionBy(table.id)
    rejected = (
        tagged.select(table.id, *kept, "reject_reason")
        .withColumn("__passed", F.count_if(F.col("reject_reason").isNull()).over(by_id))
        .where(F.col("reject_reason").isNotNull() & ((F.col("__passed") == 0) | F.col(table.id).isNull()))
        .select(*columns, "reject_reason")
        .distinct()
    )
    if held is None:
        return rejected.withColumn("first_batch", F.lit(batch_id))
    since = held.groupBy(F.col(table.id).alias("__id")).agg(F.min("first_batch").alias("__first"))
    return (
        rejected.join(since, F.col(table.id) == F.col("__id"), "left")
        .withColumn("first_batch", F.coalesce("__first", F.lit(batch_id)))
        .drop("__id", "__first")
    )


def rejected_events(
    name: str,
    sources: Sources,
    users: DataFrame,
    courses: DataFrame,
    options: StagingOptions = StagingOptions(),
) -> DataFrame:
    """Q9: how many rows of each platform the gate of one table rejects, by reason.

    Only the keys and the rule that a row breaks by itself matter.  Rows are counted by these
    first, so that the lookups shuffle no event but one narrow row for each combination.
    """
    table = EVENT_TABLES[name]
    keys = ["id_pengguna_platform", *(["id_kelas_platform"] if table.has_course else [])]
    own = [*table.rules(options.as_of), required(table.id)]
    looked_up = event_rules(table, options)[len(own) :]
    counts = (
        tag_rejects(raw_events(table, sources, options), own, "__own")
        .groupBy("id_platform", "nama_platform", "__own", *keys)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    rows = resolve_events(
        counts,
        users,
        courses if table.has_course else None,
        how="left",
        hot_keys=options.hot_keys,
        salts=options.salts,
        hash_bridges=options.hash_bridges,
    )
    broken = [Rule(rule.reason, ~F.col("__own").eqNullSafe(rule.reason)) for rule in own]
    return reject_report(rows, [*broken, *looked_up], ["id_platform"], "__n")


def build_references(
    spark: SparkSession, sources: Sources, options: StagingOptions = StagingOptions()
) -> dict[str, DataFrame]:
    """T1-T4, lazily."""
    return {
        "kamus_platform": platform_dictionary(spark),
        "kamus_mata_pelajaran": subject_dictionary(sources),
        "peta_pengguna_lintas_platform": user_bridge(sources, options),
        "peta_kelas_lintas_platform": course_bridge(sources, options),
    }


def bridge_keys(references: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, str, str]]:
    """What each bridge's global id stands for, for ``collision_report``."""
    natural = {
        "peta_pengguna_lintas_platform": ("id_pengguna_global", "email_hash"),
        "peta_kelas_lintas_platform": ("id_kelas_global", "nama_kelas_standar"),
    }
    return {name: (references[name], *columns) for name, columns in natural.items()}


def build_all_events(
    sources: Sources,
    references: Mapping[str, DataFrame],
    options: StagingOptions = StagingOptions(),
    names: Iterable[str] = tuple(EVENT_TABLES),
    held: Mapping[str, DataFrame] | None = None,
    columns: Mapping[str, Iterable[str]] | None = None,
) -> dict[str, DataFrame]:
    """T5-T9, lazily.

    ``references`` had better be written and read back: the bridges serve every
    event table, and their file sizes tell the optimizer whether to broadcast.
    ``columns``: those that are read of a table, see ``build_events``.
    """
    users = references["peta_pengguna_lintas_platform"]
    courses = references["peta_kelas_lintas_platform"]
    held, columns = held or {}, columns or {}
    return {
        name: build_events(name, sources, users, courses, options, held.get(name), columns.get(name)) for name in names
    }


def build_staging(
    spark: SparkSession, sources: Sources, options: StagingOptions = StagingOptions()
) -> dict[str, DataFrame]:
    """All staging tables, lazily."""
    references = build_references(spark, sources, options)
    return {**references, **build_all_events(sources, references, options)}


def _all_courses(sources: Sources) -> DataFrame:
    return union_all(
        _tagged(project(sources[code][spec.table], spec.fields), code)
        for code, spec in catalog.COURSES.items()
    )


def _tagged(df: DataFrame, code: str) -> DataFrame:
    id_, name, _ = PLATFORMS[code]
    return literal_tags(df, id_platform=id_, nama_platform=name)


def _names(table: str) -> list[str]:
    return StructType.fromDDL(STAGING[table]).fieldNames()
