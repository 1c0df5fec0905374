import random

import pytest
from helpers import frame, plan_of, rows_of
from pyspark.sql import functions as F

from lumbung.operators import profile
from lumbung.operators import report_state as kept
from lumbung.sources.report_states import ReportStates

SCHEMA = "source string, user_id int, day date, label string, score double"


def events(spark, seed, n):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["a", "a", "b", None]),
            rng.choice([None, *range(9)]),
            f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}",
            rng.choice(["free", "gold", None]),
            rng.choice([None, 0.0, 0.1, 53.3, rng.randrange(10**6) / 1000]),
        )
        for _ in range(n)
    ]
    return frame(spark, SCHEMA.replace("date", "string"), *rows).withColumn("day", F.col("day").cast("date"))


@pytest.fixture(scope="module")
def batches(spark):
    return {"B1": events(spark, 1, 200), "B2": events(spark, 2, 1), "B3": events(spark, 3, 301), "B4": events(spark, 4, 0)}


@pytest.fixture(scope="module")
def everything(batches):
    frames = list(batches.values())
    return frames[0].union(frames[1]).union(frames[2]).cache()


def stored(spark, folder, batches, keys, measure=None):
    states = ReportStates(spark, folder, keys, measure)
    for name, rows in batches.items():
        states.add(name, rows)
    return states


def test_counts_of_merged_states_are_those_of_all_rows(spark, folder, batches, everything):
    state = stored(spark, folder, batches, ["source", "day", "label"]).merged()
    by = ["source"]
    same = [
        (kept.state_counts(state, "label", by), profile.value_counts(everything, "label", by)),
        (kept.state_top(state, "label", 2, by), profile.top_values(everything, "label", 2, by)),
        (kept.state_timeline(state, "day", by), profile.timeline(everything, "day", by)),
        (kept.state_months(state, "day", by), profile.month_profile(everything, "day", by)),
        (kept.state_patterns(state, "label", "^g", by), profile.pattern_share(everything, "label", "^g", by)),
        (kept.state_range(state, "day", by), profile.value_range(everything, "day", by)),
    ]
    for got, want in same:
        assert rows_of(got) == rows_of(want) != []


def test_scores_and_users_of_merged_states(spark, tmp_path, batches, everything):
    by = ["source"]
    state = stored(spark, str(tmp_path / "s"), batches, ["source", "label", "score"], "score").merged()
    assert rows_of(kept.state_stats(state, "score", by)) == rows_of(profile.score_stats(everything, "score", by))
    assert rows_of(kept.state_conversion(state, "label", ["free"], "score", by)) == rows_of(
        profile.conversion(everything, "label", ["free"], "score", by)
    )
    named = everything.where("source IS NOT NULL")  # a histogram by events leaves the NULL group out
    got = kept.state_histogram(state.where("source IS NOT NULL"), "score", 7, by)
    assert rows_of(got) == rows_of(profile.histogram(named, "score", 7, by))
    state = stored(spark, str(tmp_path / "u"), batches, ["source", "user_id"], "score").merged()
    assert rows_of(kept.state_activity(state, "user_id", by, 5, 300)) == rows_of(
        profile.activity_stats(everything, "score", "user_id", by, 5, 300)
    )


@pytest.mark.parametrize("seed", range(4))
def test_weighted_median(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(kept, "MEDIAN_RANGES", rng.choice([2, 5, 256]))
    rows = [(g, rng.choice([None, rng.randrange(40) / 8]), rng.choice([1, 1, 2, 10**6])) for g in (None, "a", "b") for _ in range(30)]
    rows += [("one", 3.5, 1), ("two", 1.0, 4), ("two", 2.0, 4), ("none", None, 5)]
    got = dict(kept.weighted_median(frame(spark, "g string, v double, n long", *rows), "v", "n", ["g"]).collect())
    want = {}
    for group in {g for g, v, _ in rows if v is not None}:
        values = sorted((v, n) for g, v, n in rows if g == group and v is not None)

        def at(rank):
            for v, n in values:
                rank -= n
                if rank <= 0:
                    return v

        total = sum(n for _, n in values)
        want[group] = (at((total + 1) // 2) + at(total // 2 + 1)) / 2
    assert got == want


def test_a_batch_added_again_counts_once_and_a_report_reads_no_event(spark, folder, batches, everything):
    states = stored(spark, folder, batches, ["source", "label"])
    states.add("B1", batches["B3"])  # a wrong delivery ...
    states.add("B1", batches["B1"])  # ... corrected
    report = kept.state_counts(states.merged(), "label", ["source"])
    assert rows_of(report) == rows_of(profile.value_counts(everything, "label", ["source"]))
    plan = plan_of(kept.state_counts(states.merged(), "label", ["source"]))
    assert plan.count("FileScan") == 1 and "ExistingRDD" not in plan


def test_compacting_keeps_the_report_and_refuses_merged_batches(spark, folder, batches, everything):
    states = stored(spark, folder, batches, ["source", "label"], "score")
    reader = states.merged()
    states.compact(keep=["B3"])
    states.compact(keep=["B3"])
    want = rows_of(kept.partial_state(everything, ["source", "label"], "score"))
    assert rows_of(states.merged()) == want
    assert rows_of(reader) == want  # began before
    folders = {path.rsplit("/", 2)[1] for path in states.merged().inputFiles()}
    assert len(folders) == 2
    assert states.batch_ids() == ["B1", "B2", "B3", "B4"]
    states.add("B3", batches["B3"])
    assert rows_of(states.merged()) == want
    with pytest.raises(ValueError, match="cannot be replaced"):
        states.add("B1", batches["B1"])


def test_a_failed_batch_leaves_the_states(spark, folder, batches):
    states = stored(spark, folder, {"B1": batches["B1"]}, ["label"])
    before = rows_of(states.merged())
    with pytest.raises(Exception, match="planned"):
        states.add("B2", batches["B3"].withColumn("label", F.raise_error(F.lit("planned")).cast("string")))
    assert states.batch_ids() == ["B1"] and rows_of(states.merged()) == before
    assert ReportStates(spark, folder + "/none", ["label"]).merged() is None
