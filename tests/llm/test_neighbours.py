import math

import numpy as np
from pyspark.sql import functions as F

from llm.conftest import SF
from lumbung.llm.neighbours import (
    SearchPlan,
    chi_square_limit,
    chi_square_share,
    nearest,
)


def brute_force(rows, k, is_query):
    good = {
        i: np.array(v, float)
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q, v in good.items():
        if is_query(q):
            scores = sorted((-float(np.cumsum(v * x)[-1]), i) for i, x in good.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def lists(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert len(found[row.query_id]) == row.rank
    return found


def test_chi_square():
    assert abs(chi_square_share(2 * math.log(2), 2) - 0.5) < 1e-12
    assert abs(chi_square_limit(0.95, 8) - 15.507) < 1e-3


def test_recall_and_exact_scores_over_many_blocks(spark):
    given = spark.read.parquet(f"{SF[:-5]}0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.collect()]
    plan = SearchPlan(k=10, block_rows=32, query_rows=8, leaf_rows=8)
    found = lists(nearest(given, F.col("vec_id") % 20 == 0, plan))
    wanted = brute_force(rows, 10, lambda i: i % 20 == 0)
    assert found.keys() == wanted.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 10 * len(wanted)
    score = {(q, i): s for q, v in wanted.items() for i, s in v}
    for q, v in found.items():
        assert all(abs(s - score.get((q, i), s)) < 1e-12 for i, s in v)
        assert [s for _, s in v] == sorted((s for _, s in v), reverse=True)


def test_copies_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    copies = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400)]  # far more than one block or result holds
    rows = copies + copies[:3] + [
        (400, [1.0, 2.0, 3.0]), (401, [3.0, 2.0, 1.0]), (402, [-1.0, 0.0, 0.5]), (403, [9.0, 9.0, 9.0]),
        (404, None), (405, []), (406, [0.0, 0.0, 0.0]), (407, [1.0, None, 1.0]), (408, [nan, 1.0, 1.0]),
        (409, [inf, 1.0, 1.0]), (410, [1.0, 1.0]), (None, [5.0, 5.0, 5.0]), (420, [0.5, 0.5, 0.5]),
    ]
    df = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "vec_id long, embedding array<float>, rank long, score string")
    plan = SearchPlan(k=5, block_rows=16, query_rows=4, leaf_rows=4)
    found = lists(nearest(df, F.col("vec_id") % 20 == 0, plan))
    wanted = brute_force([r for r in rows if r[0] != 410], 5, lambda i: i % 20 == 0)
    assert found == wanted  # so few directions that nothing is missed


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (20, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert lists(nearest(df, F.col("vec_id") % 20 == 0)) == {0: [(1, 1.0), (20, 0.0)], 20: [(1, 1.0), (0, 0.0)]}
    assert nearest(df.where("false"), F.lit(True)).collect() == []
    assert nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []
