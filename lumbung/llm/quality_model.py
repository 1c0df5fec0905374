"""Quality classifier: a linear support vector machine on naive Bayes scaled n-gram indicators.

A text becomes the set of its n-grams, each present or absent: byte bigrams and
trigrams of the whole text, words and word pairs, and one to three consecutive
word shapes (case, digits, symbols, punctuation, length, same as the word
before).  Sets are hashed into ``FEATURES`` columns.  A column is scaled by its
class log-count ratio, every text is brought to unit length, and a hinge-loss
model is fitted by dual coordinate descent, with each class's cost inverse to
its share.  A logistic curve fitted on sampled rows that the machine did not see
turns margins into scores.

The fit reads at most ``FitBounds.per_class`` documents of each class.  Of a text with
more than ``FitBounds.columns`` distinct columns, the driver gets that many for the descent,
the least by a hash; executors count all of its columns for the ratios, so the ratios
are those of whole texts.  Scoring covers every whole text.  Defined cases: NULL and empty texts have one feature of
their own and a score; without two classes among the labels every score is the
share of class 1 (0.5 without any label).  ``quality_score`` returns a column, so
no input column can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.cluster import cut
from lumbung.llm.labelled import sampled_texts
from lumbung.llm.spans import Run, column_bytes, mix, slices, span_hashes

SHAPES = 1 << 12
#: first column of each family: byte pairs, byte triples, words, word pairs, shapes, shape pairs, shape triples
PAIR, TRIPLE, WORD, WORDS, SHAPE, SHAPE2, SHAPE3, EMPTY = (
    int(x) for x in np.cumsum([0, 1 << 16, 1 << 17, 1 << 17, 1 << 17, SHAPES, 1 << 16, 1 << 16])
)
FEATURES = EMPTY + 1


def _class_of(*characters: str) -> np.ndarray:
    table = np.zeros(256, np.int8)
    table[[b for part in characters for b in part.encode()]] = 1
    return table


UPPER = _class_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = _class_of("0123456789")
SYMBOL = _class_of("#*$%&|<>")
MARK = _class_of("!\"'()+,-./:;=?@[]^_`{}~\\")
LOWER = np.ones(256, np.int8) - UPPER - DIGIT - SYMBOL - MARK
LOWER[:0x21] = 0


@dataclass(frozen=True)
class FitBounds:
    """What the fit reads, whatever the size of the corpus."""

    per_class: int = 1500
    columns: int = 1 << 14  # of one text on the driver: 64 KB, so 200 MB for all texts at most
    smoothing: float = 1.0
    cost: float = 1.0
    rounds: int = 12
    seed: int = 5


@dataclass(frozen=True)
class QualityModel:
    ratios: np.ndarray  # log-count ratio of each column
    weights: np.ndarray  # hinge-loss weight of each scaled column
    bias: float
    slope: float
    offset: float

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def _hashed(values: np.ndarray, size: int, base: int) -> np.ndarray:
    return (mix(values) & np.uint64(size - 1)).astype(np.int32) + np.int32(base)


class _Indicators:
    """The distinct feature columns of one text after the other."""

    def __init__(self):
        self.last = np.zeros(FEATURES, np.int32)

    def each(self, data, starts, ends):
        for i, j in slices(starts, ends):
            run = Run(data, starts[i:j], ends[i:j])
            text = run.text.astype(np.int32)
            pair, triple = np.zeros(len(text), np.int32), np.zeros(len(text), np.int32)
            pair[1:] = (text[:-1] << 8 | text[1:]) + PAIR
            if len(text) > 2:
                triple[2:] = ((text[:-2] * 40503 + text[1:-1] * 10007 + text[2:] * 257) & 0x1FFFF) + TRIPLE
            first, last, counts = run.words()
            prefix = run.prefix()
            word = span_hashes(prefix, first, last)
            shape = _shapes(run, first, last, word)
            word_pair, shape2, shape3 = (np.zeros(len(word), np.uint64) for _ in range(3))
            word_pair[1:] = word[:-1] * np.uint64(3) + word[1:]
            shape2[1:] = shape[:-1] << np.uint64(12) | shape[1:]
            shape3[2:] = shape[:-2] << np.uint64(24) | shape[1:-1] << np.uint64(12) | shape[2:]
            families = (
                (_hashed(word, 1 << 17, WORD), 0),
                (_hashed(word_pair, 1 << 17, WORDS), 1),
                (shape.astype(np.int32) + np.int32(SHAPE), 0),
                (_hashed(shape2, 1 << 16, SHAPE2), 1),
                (_hashed(shape3, 1 << 16, SHAPE3), 2),
            )
            stop = np.cumsum(counts)
            for a, b, u, v in zip(run.starts.tolist(), run.ends.tolist(), (stop - counts).tolist(), stop.tolist()):
                if a >= b or u == v:
                    yield np.array([EMPTY], np.int32)
                    continue
                columns = np.concatenate([pair[a + 1 : b], triple[a + 2 : b], *(f[u + k : v] for f, k in families)])
                at = np.arange(len(columns), dtype=np.int32)
                self.last[columns] = at  # of equal columns one place stays
                yield columns[self.last[columns] == at]


def _shapes(run: Run, first: np.ndarray, last: np.ndarray, word: np.ndarray) -> np.ndarray:
    def count(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(run.text) + 1, np.int32)
        np.cumsum(table[run.text], out=sums[1:])
        return sums[last] - sums[first]

    upper, symbol, mark = count(UPPER), count(SYMBOL), count(MARK)
    code = np.minimum(symbol, 3) | np.minimum(mark, 3) << 2 | (upper > 1).astype(np.int32) << 4
    code |= UPPER[run.text[first]].astype(np.int32) << 5 | (count(LOWER) > 0).astype(np.int32) << 6
    code |= (count(DIGIT) > 0).astype(np.int32) << 7
    code |= np.minimum(np.searchsorted([2, 4, 8, 16], last - first, side="right"), 4).astype(np.int32) << 8
    code[1:] |= (word[1:] == word[:-1]).astype(np.int32) << 11
    return code.astype(np.uint64)


def indicators(texts: pa.Array):
    data, starts, ends = column_bytes(texts)
    return _Indicators().each(data, starts, ends)


def fit_quality_model(docs: DataFrame, labels: DataFrame, bounds: FitBounds = FitBounds()) -> QualityModel:
    """Learn from ``labels`` (doc_id, quality); the caller leaves out the rows that may not be learned."""

    @F.arrow_udf("array<int>")
    def columns(texts: pa.Array) -> pa.Array:
        found = list(indicators(texts))
        stops = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(stops, np.concatenate([np.zeros(0, np.int32), *found]))

    sample = cut(sampled_texts(docs, labels, "quality", bounds.per_class).select("doc_id", "label", columns("text").alias("columns")))
    rows = _collected(sample, bounds.columns)
    texts = [row[1] for row in rows]
    truth = np.array([row[2] for row in rows], int)
    if len(set(truth.tolist())) < 2:
        share = float(truth.mean()) if len(truth) else 0.5
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        none = np.zeros(FEATURES, np.float32)
        return QualityModel(none, none, 0.0, 0.0, float(odds))
    random = np.random.default_rng(bounds.seed)
    seen = random.random(len(truth)) < 0.75
    for value in (0, 1):  # each class on either side
        mine = np.flatnonzero(truth == value)
        seen[mine[0]] = True
        seen[mine[-1]] = len(mine) == 1
    short = np.array([row[3] for row in rows])
    counts = _class_counts(texts, truth, seen & short)
    counts += _counted_on_executors(sample, [row[4] for row, use in zip(rows, seen & ~short) if use])
    ratios = _log_count_ratios(counts, bounds.smoothing)
    weights, bias, _ = _dual_descent(texts, truth, seen, ratios, bounds, random)
    margins = np.array([_margin(columns, ratios, weights, bias) for columns in texts])
    unseen = ~seen if len(set(truth[~seen].tolist())) == 2 else seen
    slope, offset = _logistic(margins[unseen], truth[unseen], truth.mean())
    return QualityModel(ratios.astype(np.float32), weights.astype(np.float32), bias, slope, offset)


def _collected(sample: DataFrame, most: int) -> list[tuple]:
    """(doc_id, at most ``most`` columns, label, whether these are all, hash of all) in a fixed order."""
    by_hash = F.array_sort(F.transform("columns", lambda c: F.struct(F.xxhash64(c).alias("h"), c.alias("c"))))
    all_ = F.size("columns") <= most
    table = sample.select(
        "doc_id",
        F.when(all_, F.col("columns")).otherwise(F.transform(F.slice(by_hash, 1, most), lambda pair: pair["c"])).alias("columns"),
        "label",
        all_.alias("all"),
        F.xxhash64("doc_id", "columns").alias("key"),
    ).toArrow()
    lists = [x for chunk in table["columns"].chunks for x in _split(chunk)]
    rest = (table[name].to_pylist() for name in ("label", "all", "key"))
    rows = zip(table["doc_id"].to_pylist(), lists, *rest)
    return sorted(rows, key=lambda row: (row[0], row[1].tobytes()))


def _split(lists: pa.ListArray) -> list[np.ndarray]:
    stops = lists.offsets.to_numpy()
    return np.split(lists.values.to_numpy()[: stops[-1]], stops[:-1])[1:] if len(lists) else []


def _counted_on_executors(sample: DataFrame, keys: list[int]) -> np.ndarray:
    """How many of the texts with these keys have each column, by class; FEATURES numbers a class."""
    counts = np.zeros((2, FEATURES))
    if keys:
        own = sample.where(F.xxhash64("doc_id", "columns").isin(*keys))
        found = own.select("label", F.explode("columns").alias("c")).groupBy("label", "c").agg(F.count("*").alias("n")).toArrow()
        counts[found["label"].to_numpy(), found["c"].to_numpy()] = found["n"].to_numpy()
    return counts


def _class_counts(texts, truth, use) -> np.ndarray:
    counts = np.zeros((2, FEATURES))
    for k in np.flatnonzero(use):
        counts[truth[k]][texts[k]] += 1
    return counts


def _log_count_ratios(counts: np.ndarray, smoothing: float) -> np.ndarray:
    counts = counts + smoothing
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def _margin(columns, ratios, weights, bias) -> float:
    values = ratios[columns]
    length = float(np.sqrt((values * values).sum()))
    return float((weights[columns] * values).sum() / length + bias) if length > 0 else float(bias)


def _dual_descent(texts, truth, seen, ratios, bounds, random):
    """Hinge loss: one dual variable for each text between 0 and its class's cost."""
    use = np.flatnonzero(seen)
    sign = np.where(truth == 1, 1.0, -1.0)
    cost = {value: bounds.cost * len(use) / (2 * max(1, int((truth[use] == value).sum()))) for value in (0, 1)}
    values = {}
    for k in use:
        scaled = ratios[texts[k]]
        length = np.sqrt((scaled * scaled).sum())
        values[k] = scaled / length if length > 0 else scaled
    weights, bias, dual = np.zeros(FEATURES), 0.0, np.zeros(len(truth))
    for _ in range(bounds.rounds):
        for k in random.permutation(use):
            columns, scaled = texts[k], values[k]
            gradient = sign[k] * (weights[columns] @ scaled + bias) - 1.0
            new = min(max(dual[k] - gradient / (scaled @ scaled + 1.0), 0.0), cost[int(truth[k])])
            step = (new - dual[k]) * sign[k]
            if step:
                weights[columns] += step * scaled
                bias += step
                dual[k] = new
    return weights, float(bias), dual


def _logistic(margins, truth, share, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset by Newton steps on smoothed targets, each class with half of the weight."""
    positive, negative = int((truth == 1).sum()), int((truth == 0).sum())
    target = np.where(truth == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weight = np.where(truth == 1, 0.5 / positive, 0.5 / negative) * len(truth)
    slope, offset = 1.0, 0.0
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        gradient = design.T @ (weight * (chance - target)) + 1e-3 * np.array([slope, offset])
        curve = (design * (weight * chance * (1 - chance))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        slope, offset = slope - float(step[0]), offset - float(step[1])
    return max(slope, 0.0), offset


def quality_score(spark: SparkSession, model: QualityModel, text: str = "text") -> Column:
    """A column between 0 and 1, higher for texts that class 1 is likelier for."""
    shared = spark.sparkContext.broadcast(model)  # FEATURES columns, some MB

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(shared.value, texts))

    return score.asNondeterministic()(F.coalesce(F.col(text), F.lit("")))


def score_texts(model: QualityModel, texts: pa.Array) -> np.ndarray:
    scaled = (model.weights * model.ratios).astype(np.float64)
    square = (model.ratios * model.ratios).astype(np.float64)
    both = np.stack([scaled, square], axis=1)
    margins = np.empty(len(texts))
    for k, columns in enumerate(indicators(texts)):
        total, length = both[columns].sum(axis=0)
        margins[k] = total / np.sqrt(length) + model.bias if length > 0 else model.bias
    return model.score(margins)
