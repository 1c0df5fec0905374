from collections import defaultdict

import pytest

from llm.conftest import words_of
from lumbung.llm import mixing
from lumbung.llm.mixing import CURRICULUM, Schedule, in_training_order, mixed, mixed_documents


def level_by_hand(sizes):
    """Targets of (source, size) by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, free = {}, sum(sizes.values()), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free -= full
    return target


@pytest.mark.parametrize("digits", [0, 2])
def test_targets_and_takes(spark, hard_documents, monkeypatch, digits):
    monkeypatch.setattr(mixing, "range_digits", lambda n: digits)
    rows = mixed(hard_documents).collect()
    given = hard_documents.collect()
    assert len(rows) == len(given)
    sizes, took = defaultdict(int), defaultdict(int)
    for row in given:
        sizes[row.source] += len(words_of(row.text))
    targets = level_by_hand(sizes)
    for row in rows:
        assert row.source_size == sizes[row.source] and abs(row.target - targets[row.source]) < 1e-6
        assert 0 <= row.taken <= 3 * row.size and (row.taken > 0) == (len(row.positions) > 0)
        assert all(0 <= t <= 1 for t in row.positions) and list(row.positions) == sorted(row.positions)
        took[row.source] += row.taken
    for source, words in took.items():
        assert abs(words - targets[source]) <= 0.5
    again = mixed(hard_documents.repartition(7)).collect()
    key = lambda r: str((r.doc_id, r.source, r.size, r.taken, r.positions))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_positions_follow_the_weight_schedules(spark):
    rows = [(n, " ".join(["w"] * 10), f"s{n % 3}") for n in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = in_training_order(mixed(docs)).collect()
    assert [r.position for r in found] == sorted(r.position for r in found)
    for k, schedule in enumerate(CURRICULUM):
        times = [r.position for r in found if r.source == f"s{k}"]
        for at in (0.1, 0.25, 0.5, 0.75, 0.9):
            (_, v), (_, w) = schedule.points
            integral = v * at + (w - v) * at * at / 2
            assert abs(sum(t <= at for t in times) / len(times) - integral) < 0.01


def test_a_schedule_of_several_lines_is_inverted(spark):
    schedule = Schedule(((0.0, 0.0 + 1e-9), (0.3, 2.0), (0.6, 0.5), (1.0, 0.5)))
    shares = [k / 50 for k in range(51)]
    df = spark.createDataFrame([(s,) for s in shares], "u double")
    times = [row[0] for row in df.select(schedule.time_of(df.u)).collect()]

    def integral(t):
        total = 0.0
        for (a, v), (b, w) in zip(schedule.points, schedule.points[1:]):
            end = min(max(t, a), b)
            total += (end - a) * (v + v + (w - v) / (b - a) * (end - a)) / 2
        return total

    assert all(abs(integral(t) / integral(1.0) - s) < 1e-6 for s, t in zip(shares, times))


def test_whole_documents_keep_columns_and_count_copies(spark, hard_documents):
    kept = mixed_documents(hard_documents)
    assert kept.columns == hard_documents.columns
    wanted = defaultdict(int)
    for row in mixed(hard_documents, whole_documents=True).collect():
        assert row.taken % max(1, row.size) == 0
        wanted[(row.doc_id, row.size)] += len(row.positions)
    found = defaultdict(int)
    for row in kept.collect():
        found[(row.doc_id, len(words_of(row.text)))] += 1
    assert dict(found) == {k: n for k, n in wanted.items() if n}


def test_nothing_to_mix(no_documents):
    assert mixed(no_documents).collect() == [] and mixed_documents(no_documents).collect() == []


def test_the_main_path_has_no_python(documents):
    plan = mixed(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_many_sources_are_ranked_in_ranges(spark):
    sizes = {f"s{n:04d}": (n * 7919) % 997 for n in range(900)} | {None: 12}
    rows = [("-" if s is None else f"+{s}", size) for s, size in sizes.items()]
    found = mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    want = level_by_hand(sizes)
    assert len(found) == len(rows)
    for place, row in enumerate(sorted(found, key=lambda row: (row.source == "-", row.source)), 1):
        assert row.place == place
        assert row.target == pytest.approx(want[None if row.source == "-" else row.source[1:]], abs=1e-6)
    part = spark.range(1000).selectExpr("id % 211 * 10000 + id AS k", "id AS v")
    sums = mixing.running(part, ["k"], {"before": "v"}, 1000).orderBy("k").collect()
    assert [row.before for row in sums] == [sum(r.v for r in sums[:n]) for n in range(len(sums))]


def test_copies_follow_their_training_positions(spark):
    docs = spark.createDataFrame([(n, " ".join(["w"] * 10), f"s{n % 3}") for n in range(300)], "doc_id long, text string, source string")
    order = in_training_order(mixed(docs, whole_documents=True)).collect()
    wanted = [row.doc_id for row in sorted(order, key=lambda row: (row.position, row["at"]))]
    assert [row.doc_id for row in mixed_documents(docs).collect()] == wanted
