"""Large event tables are staged in slices of their ids: the same rows, and less shuffled at once."""

import pytest
from helpers import rows_of
from test_plans import AS_OF, sources
from test_shuffles import shuffle_files
from test_steps_at_size import GIVEN, bridges

from lumbung.plans.staging import EVENT_TABLES, build_events, held_events, in_slice, raw_events, slices
from lumbung.sources.stores import ParquetStore
from workload import star_queries as star
from workload.registry import QUERIES

NAME = "olah_hasil_latihan"
TABLE = EVENT_TABLES[NAME]


def test_slices_share_the_events_between_them(spark):
    raw = raw_events(TABLE, sources(spark, **GIVEN), AS_OF)
    assert slices(1) == [None] and slices(2) == [(0, 2), (1, 2)]
    parts = [rows_of(in_slice(raw, TABLE, part)) for part in slices(3)]
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, rows_of(raw)))
    ids = [{row[0] for row in part} for part in parts]
    assert all(ids) and not (ids[0] & ids[1] or ids[0] & ids[2] or ids[1] & ids[2])


@pytest.mark.parametrize("n", [2, 5])
def test_slices_are_staged_and_held_as_the_whole(spark, n):
    given = sources(spark, **GIVEN)
    users, courses = bridges(given)
    whole = rows_of(build_events(NAME, given, users, courses, AS_OF))
    parts = [build_events(NAME, given, users, courses, AS_OF, part=part) for part in slices(n)]
    assert sorted(sum(map(rows_of, parts), [])) == sorted(whole) and len(whole) == 2
    nobody = users.where("false")
    first = held_events(NAME, given, nobody, courses, "B1", AS_OF)
    held = [held_events(NAME, given, nobody, courses, "B1", AS_OF, part=part) for part in slices(n)]
    assert sorted(map(str, sum(map(rows_of, held), []))) == sorted(map(str, rows_of(first)))
    # a later batch with the users admits the held rows, slice by slice too
    nothing = {code: {name: df.where("false") for name, df in tables.items()} for code, tables in given.items()}
    late = rows_of(build_events(NAME, nothing, users, courses, AS_OF, first))
    again = [build_events(NAME, nothing, users, courses, AS_OF, first, part=part) for part in slices(n)]
    assert sorted(sum(map(rows_of, again), [])) == sorted(late) == sorted(whole)
    held = [held_events(NAME, nothing, nobody, courses, "B2", AS_OF, first, part) for part in slices(n)]
    want = rows_of(held_events(NAME, nothing, nobody, courses, "B2", AS_OF, first))
    assert sorted(map(str, sum(map(rows_of, held), []))) == sorted(map(str, want)) and {row[-1] for row in want} == {"B1"}


def test_a_table_in_parts_is_written_with_one_commit(spark, folder):
    store = ParquetStore(spark, folder)
    store.write("t", spark.range(3))
    before = shuffle_files(spark)
    parts = (spark.range(low, low + 5).distinct() for low in (10, 20))
    assert rows_of(store.write_parts("t", parts)) == [(n,) for n in (*range(10, 15), *range(20, 25))]
    assert shuffle_files(spark) <= before and rows_of(store.read("t"))[0] == (10,)

    def broken():
        yield spark.range(1)
        raise OSError("lost")

    with pytest.raises(OSError):
        store.write_parts("t", broken())
    assert store.read("t").count() == 10


@pytest.mark.parametrize(
    "name, written",
    [
        ("staging_olah_hasil_latihan", {NAME}),
        ("fakta_hasil_latihan", {NAME}),
        ("fakta_aktivitas_belajar_looked_up", {"olah_aktivitas_belajar", "looked_up/fakta_aktivitas_belajar"}),
        ("quarantine_replay", {"held", "first", "late"}),
    ],
)
def test_large_queries_write_their_events_in_slices(spark, folder, monkeypatch, name, written):
    monkeypatch.setattr(star, "derived_sources", lambda spark, sf_dir: sources(spark, **GIVEN))
    whole, parts = rows_of(QUERIES[name](spark, folder)), {}

    class Store(ParquetStore):
        def write_parts(self, table, frames):
            frames = list(frames)
            parts[table] = len(frames)
            return super().write_parts(table, frames)

    monkeypatch.setattr(star, "ParquetStore", Store)
    monkeypatch.setattr(star, "_event_slices", lambda spark, sf_dir: slices(2))
    assert rows_of(QUERIES[name](spark, folder)) == whole
    assert {table for table, n in parts.items() if n == 2} >= written
