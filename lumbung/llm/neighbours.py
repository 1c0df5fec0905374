"""Nearest neighbours by inner product: stable projections, kd-trees and a chi-square stopping test.

Inner product becomes distance: every vector x gets a coordinate sqrt(M^2 - |x|^2),
M being the largest norm, and a query gets 0 there, so that the squared distance is
|q|^2 + M^2 - 2 q.x.  All are projected onto a few Gaussian directions.  Projection is
2-stable: the squared projected distance over the squared distance follows a
chi-square law, so once every row within projected distance r has been verified, a
row nearer than the current k-th neighbour at distance d was missed with
probability below 1 - P(chi2 <= r^2 / d^2).  A search verifies its projected
neighbours from near to far and stops when that probability is small enough.

The index covers every row.  The top of the kd-tree, fitted on a bounded sample,
deals rows into at most ``MOST_CELLS`` cells; a cell is a number of blocks of about
``block_rows`` rows, each a kd-tree of its own whose leaves carry projected bounds.
A query searches the blocks of its own cell first and then those cells whose bounds
pass the test for the distance it has by then.  Blocks meet queries in groups of at
most ``query_rows``, so no task holds an unbounded group.  Copies of a vector keep
the ids that can be in a result, the ``k + 1`` least ones, in each block, and equal
query vectors are searched once.

Defined cases: rows whose id is NULL or whose vector is NULL, empty, zero or holds
NULL or non-finite components take no part, neither do vectors of another length
than the most frequent one; equal scores go by id; equal rows count once; fewer
candidates than ``k`` give a shorter list; only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.cluster import cut

MOST_CELLS = 4096
SLOTS = 1 << 20


@dataclass(frozen=True)
class SearchPlan:
    k: int = 20
    directions: int = 8  # even, for the closed form of the chi-square law
    certainty: float = 0.98
    block_rows: int = 8192
    query_rows: int = 2048
    leaf_rows: int = 64
    sample_rows: int = 20_000
    seed: int = 17


def chi_square_share(value: float, degrees: int) -> float:
    """P(chi2 <= value) for an even number of degrees."""
    half = value / 2
    return 1.0 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def chi_square_limit(share: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_share(high, degrees) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, degrees) < share else (low, middle)
    return high


@dataclass(frozen=True)
class Projection:
    """Gaussian directions over the components and the added coordinate, and the cells."""

    directions: np.ndarray
    norm: float  # the largest
    splits: tuple[tuple[int, float], ...]  # of a complete binary tree in breadth-first order

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors * vectors).sum(axis=1), 0.0))
        return vectors @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.directions[:-1]

    def cells(self, projected: np.ndarray) -> np.ndarray:
        if not self.splits:
            return np.zeros(len(projected), np.int32)
        axis = np.array([a for a, _ in self.splits])
        value = np.array([v for _, v in self.splits])
        node = np.zeros(len(projected), np.int64)
        while node.min(initial=len(self.splits)) < len(self.splits):
            right = projected[np.arange(len(node)), axis[node]] > value[node]
            node = 2 * node + 1 + right
        return (node - len(self.splits)).astype(np.int32)


def fit_splits(projected: np.ndarray, cells: int) -> tuple[tuple[int, float], ...]:
    """Median splits along the widest axis, level by level."""
    splits: list[tuple[int, float]] = []
    level = [projected]
    while len(level) < cells:
        below = []
        for rows in level:
            spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(projected.shape[1])
            axis = int(spread.argmax())
            value = float(np.median(rows[:, axis])) if len(rows) else 0.0
            splits.append((axis, value))
            right = rows[:, axis] > value
            below += [rows[~right], rows[right]]
        level = below
    return tuple(splits)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, norm2) of the rows that take part, components as doubles."""
    component = F.col("embedding").cast("array<double>")
    finite = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
        .select("vec_id", component.alias("embedding"))
        .withColumn("norm2", F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
        .where("norm2 > 0")
    )


class _Block:
    """Rows of one block in leaf order, with projected bounds of each leaf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection, leaf_rows: int):
        leaves: list[np.ndarray] = []
        projected = projection.rows(vectors)

        def part(rows: np.ndarray) -> None:
            if len(rows) <= leaf_rows:
                leaves.append(rows)
                return
            axis = int(np.ptp(projected[rows], axis=0).argmax())
            order = rows[np.argsort(projected[rows, axis], kind="stable")]
            part(order[: len(order) // 2])
            part(order[len(order) // 2 :])

        part(np.arange(len(ids)))
        order = np.concatenate(leaves)
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        ends = np.cumsum([len(leaf) for leaf in leaves])
        self.bounds = list(zip((ends - [len(leaf) for leaf in leaves]).tolist(), ends.tolist()))
        self.low = np.array([projected[leaf].min(axis=0) for leaf in leaves])
        self.high = np.array([projected[leaf].max(axis=0) for leaf in leaves])

    def search(self, queries: np.ndarray, known: np.ndarray, projection: Projection, plan: SearchPlan, scale: float):
        """(query, id, score) of at most k + 1 rows for each query; ``known`` is a score it has already."""
        most = plan.k + 1
        limit = chi_square_limit(plan.certainty, plan.directions)
        slack = 1e-9 * scale * np.sqrt((queries * queries).sum(axis=1))
        projected = projection.queries(queries)
        away = _away(projected, self.low, self.high)
        order = np.argsort(away, axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
        top = np.full((len(queries), most), -np.inf)
        base = (queries * queries).sum(axis=1) + projection.norm**2
        found: list[tuple[np.ndarray, np.ndarray]] = []
        first = 0
        while first < len(self.bounds):
            last = min(len(self.bounds), 2 * first + 1)
            for leaf, (begin, end) in enumerate(self.bounds):
                score = np.maximum(top[:, 0], known)
                reach = np.where(np.isfinite(score), limit * np.maximum(base - 2 * score + slack, 0.0), np.inf)
                mine = np.flatnonzero((rank[:, leaf] >= first) & (rank[:, leaf] < last) & (away[:, leaf] <= reach))
                if not len(mine):
                    continue
                scores = queries[mine] @ self.vectors[begin:end].T
                least = np.maximum(top[mine, 0], known[mine]) - slack[mine]
                q, r = np.nonzero(scores >= least[:, None])
                found.append((mine[q], begin + r))
                both = np.concatenate([top[mine], scores], axis=1)
                top[mine] = np.sort(np.partition(both, both.shape[1] - most, axis=1)[:, -most:], axis=1)
            first = last
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, row = (np.concatenate(x) for x in zip(*found))
        # scores once more, summed in one fixed order, so that equal vectors have equal scores
        exact = np.cumsum(queries[query] * self.vectors[row], axis=1)[:, -1]
        order = np.lexsort((self.ids[row], -exact, query))
        query, row, exact = query[order], row[order], exact[order]
        begins = np.searchsorted(query, query)
        keep = np.arange(len(query)) - begins < most
        return query[keep], self.ids[row[keep]], exact[keep]


def _away(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point from each box."""
    total = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        p = points[:, axis][:, None]
        gap = np.maximum(np.maximum(low[:, axis] - p, p - high[:, axis]), 0.0)
        total += gap * gap
    return total


def _first_ids(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Rows that can be in a result: of equal vectors the ``most`` least ids, each once."""
    rows = np.ascontiguousarray(vectors + 0.0).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1])))
    _, group = np.unique(rows.ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (group[order][1:] != group[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[fresh]
    begins = np.searchsorted(group[order], group[order])
    return np.sort(order[np.arange(len(order)) - begins < most])


def nearest(vectors: DataFrame, is_query: Column, plan: SearchPlan = SearchPlan()) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` rows of largest inner product for each query row."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c"), F.max("norm2").alias("m"))
    common = lengths.orderBy(F.desc("c"), "n").first()
    result = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("embedding") == common["n"])
    count, norm = common["c"], math.sqrt(common["m"])

    cells = 1
    while cells < MOST_CELLS and cells * plan.block_rows < count:
        cells *= 2
    share = min(1.0, plan.sample_rows / count)
    chosen = F.pmod(F.xxhash64("vec_id"), F.lit(SLOTS)) < F.lit(int(share * SLOTS) + 1)
    sample = rows.where(chosen).select("embedding").limit(2 * plan.sample_rows).toArrow()
    directions = np.random.default_rng(plan.seed).normal(size=(common["n"] + 1, plan.directions))
    bare = Projection(directions, norm, ())
    fitted = bare.rows(_matrix(sample.column(0).combine_chunks())) if sample.num_rows else np.zeros((0, plan.directions))
    projection = Projection(directions, norm, fit_splits(fitted, cells) if len(fitted) else ())
    shared = spark.sparkContext.broadcast(projection)  # bounded by MOST_CELLS

    @F.arrow_udf("struct<cell: int, low: array<double>>")
    def placed(embeddings: pa.Array) -> pa.Array:
        return _placement(shared.value, shared.value.rows(_matrix(embeddings)))

    @F.arrow_udf("struct<cell: int, low: array<double>>")
    def asked(embeddings: pa.Array) -> pa.Array:
        return _placement(shared.value, shared.value.queries(_matrix(embeddings)))

    in_cells = rows.select("vec_id", "embedding", placed("embedding").alias("at"))
    axes = range(plan.directions)
    bounds = (
        in_cells.groupBy("at.cell")
        .agg(
            F.count("*").alias("n"),
            F.array(*(F.min(F.col("at.low")[a]) for a in axes)).alias("low"),
            F.array(*(F.max(F.col("at.low")[a]) for a in axes)).alias("high"),
        )
        .collect()  # at most MOST_CELLS rows
    )
    salts = {row["cell"]: -(-row["n"] // (2 * plan.block_rows)) for row in bounds}
    salt_of = F.element_at(F.lit([salts.get(cell, 1) for cell in range(cells)]), F.col("at.cell") + 1)
    dealt = in_cells.select(
        "vec_id",
        "embedding",
        F.col("at.cell").alias("cell"),
        F.pmod(F.xxhash64("vec_id"), salt_of).cast("int").alias("salt"),
    )
    blocks = cut(_packed_blocks(dealt, plan))

    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding")
    asks = cut(
        queries.groupBy("embedding")
        .agg(F.min("query_id").alias("ask"))
        .withColumn("at", asked("embedding"))
        .select("ask", "embedding", F.col("at.cell").alias("cell"))
    )
    home = cut(_search(asks.withColumn("known", F.lit(None).cast("double")), blocks, shared, plan))
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    best = home.withColumn("n", F.row_number().over(order)).where(F.col("n") <= plan.k + 1)
    reached = best.groupBy("ask").agg(F.min(F.when(F.col("n") == plan.k + 1, F.col("score"))).alias("known"))
    numbers = np.array([row["cell"] for row in bounds])
    boxes = spark.sparkContext.broadcast(
        (numbers, np.array([row["low"] for row in bounds]), np.array([row["high"] for row in bounds]))
    )
    limit = chi_square_limit(plan.certainty, plan.directions)

    @F.arrow_udf("array<int>")
    def other_cells(embeddings: pa.Array, home_cells: pa.Array, known: pa.Array) -> pa.Array:
        matrix, own = _matrix(embeddings), home_cells.to_numpy(zero_copy_only=False)
        score = known.to_numpy(zero_copy_only=False).astype(np.float64)
        cell, low, high = boxes.value
        away = _away(shared.value.queries(matrix), low, high)
        reach = limit * np.maximum((matrix * matrix).sum(axis=1) + norm**2 - 2 * score, 0.0) * (1 + 1e-9)
        visit = (away <= np.where(np.isnan(reach), np.inf, reach)[:, None]) & (cell[None, :] != own[:, None])
        return pa.array([cell[v].tolist() for v in visit], pa.list_(pa.int32()))

    onward = asks.join(reached, "ask", "left").withColumn("cell", F.explode(other_cells("embedding", "cell", "known")))
    away = _search(onward.select("ask", "embedding", "cell", "known"), blocks, shared, plan)
    merged = (
        home.unionByName(away).withColumn("n", F.row_number().over(order)).where(F.col("n") <= plan.k + 1)
    )
    of_query = queries.join(asks.select("ask", "embedding"), "embedding").select("query_id", "ask").distinct()
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        of_query.join(merged, "ask")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= plan.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _placement(projection: Projection, projected: np.ndarray) -> pa.Array:
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(projected) + 1) * projected.shape[1], pa.int32()), pa.array(projected.ravel())
    )
    return pa.StructArray.from_arrays([pa.array(projection.cells(projected)), lists], ["cell", "low"])


def _packed_blocks(dealt: DataFrame, plan: SearchPlan) -> DataFrame:
    """(cell, salt, ids, vectors): the rows of each block as two byte strings."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("embedding").combine_chunks())
        keep = _first_ids(ids, vectors, plan.k + 1)
        return pa.table(
            {
                "cell": pa.array([key[0].as_py()], pa.int32()),
                "salt": pa.array([key[1].as_py()], pa.int32()),
                "ids": pa.array([ids[keep].astype(np.int64).tobytes()], pa.binary()),
                "vectors": pa.array([vectors[keep].tobytes()], pa.binary()),
            }
        )

    return dealt.groupBy("cell", "salt").applyInArrow(pack, "cell int, salt int, ids binary, vectors binary")


def _search(asks: DataFrame, blocks: DataFrame, shared, plan: SearchPlan) -> DataFrame:
    """(ask, vec_id, score) of ``asks`` (ask, embedding, cell, known) in all blocks of their cells."""
    crowd = asks.groupBy("cell").agg(F.ceil(F.count("*") / plan.query_rows).cast("int").alias("groups"))
    salts = blocks.select("cell", F.col("salt").alias("to_salt"))
    left = (
        asks.join(crowd, "cell")
        .withColumn("part", F.pmod(F.xxhash64("ask"), F.col("groups")).cast("int"))
        .join(salts, "cell")
        .select(F.col("cell").alias("to_cell"), "to_salt", F.col("part").alias("to_part"), "ask", "embedding", "known")
    )
    right = blocks.join(crowd, "cell").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    ).select("cell", "salt", "part", "ids", "vectors")

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        query, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if asked.num_rows and held.num_rows:
            ids = np.frombuffer(held.column("ids")[0].as_py(), np.int64)
            vectors = np.frombuffer(held.column("vectors")[0].as_py(), np.float64).reshape(len(ids), -1)
            projection = shared.value
            block = _Block(ids, vectors, projection, plan.leaf_rows)
            known = asked.column("known").to_numpy().astype(np.float64)
            matrix = _matrix(asked.column("embedding").combine_chunks())
            query, found, score = block.search(
                matrix, np.where(np.isnan(known), -np.inf, known), projection, plan, projection.norm
            )
            query = asked.column("ask").to_numpy()[query]
        return pa.table({"ask": pa.array(query, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": score})

    return (
        left.groupBy("to_cell", "to_salt", "to_part")
        .cogroup(right.groupBy("cell", "salt", "part"))
        .applyInArrow(search, "ask long, vec_id long, score double")
    )
