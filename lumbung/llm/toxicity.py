"""Toxicity by compression distance: two zstandard dictionaries, and windows that one of them compresses better.

Training, on a bounded sample of labelled documents, two thirds of it for the
dictionaries and the rest for the calibration:

1. Byte sequences of ``GRAM`` bytes that clearly more toxic than ordinary documents
   hold are the toxic sequences; the words around them are the toxic passages.
2. The ordinary dictionary is trained on windows of ordinary documents, less the
   toxic sequences in them, which are thus dear to write with it.
3. The toxic dictionary is trained on the toxic passages.  Its content stands where
   the least useful part of the ordinary one does, and the rest is shared, so that
   a window without a toxic sequence takes the same bytes with both of them.
4. On the calibration part, two percentiles of the ordinary windows' distances are
   the thresholds, and a logistic curve over what exceeds them gives the score, each
   class with its share of all labels.

A document is lower-cased, its white space runs become one blank, and it is cut into
overlapping windows of ``WINDOW`` bytes.  A window's distance is its compressed length
with the ordinary dictionary less that with the toxic one.  Scoring covers every
window of every whole text, however long.

Defined cases: NULL and empty texts are one window of two blanks and have a score;
a text shorter than a window is one window; without two classes among the labels
every score is the share of class 1 (0.5 without any label).  ``toxicity_score``
returns a column and reads no other, so no input column can clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.labelled import sampled_texts

WINDOW, STRIDE = 64, 40  # bytes
LEVEL = 6  # zstandard's lazy strategies look for the longest match, which keeps the distance free of noise
GRAM = 6  # bytes of a sequence that is counted
MOST_WINDOWS = 1 << 16  # windows that are compressed in one call
MOST_WORD = 24  # bytes of a word that go into a dictionary


@dataclass(frozen=True)
class ToxicityBounds:
    """What the fit reads, whatever the size of the corpus, and how large the dictionaries are."""

    per_class: int = 2000  # documents of each class
    spans: int = 6  # a longer text than ``spans * span`` characters gives so many spread parts
    span: int = 2000
    windows: int = 30_000  # ordinary windows for the dictionary
    dictionary: int = 26_624  # bytes
    toxic: int = 2048  # bytes of the toxic dictionary that are its own
    times: float = 4.0  # how much commoner a toxic sequence is in toxic documents
    deviations: float = 3.0  # and by how many standard deviations
    low: float = 0.98  # percentiles of the ordinary windows' distances
    high: float = 0.998
    seed: int = 12


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    low: float
    high: float
    weights: np.ndarray  # of the scaled measures, and the offset
    centre: np.ndarray
    scale: np.ndarray

    def score(self, measures: np.ndarray) -> np.ndarray:
        scaled = (measures - self.centre) / self.scale
        return 1.0 / (1.0 + np.exp(-np.clip((scaled * self.weights[:-1]).sum(axis=1) + self.weights[-1], -40, 40)))


MEASURES = 6
FLAT = (np.zeros(MEASURES), np.ones(MEASURES))


def plain_bytes(text: str | None) -> bytes:
    return f" {' '.join((text or '').lower().split())} ".encode()


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segments, owner): offset and length of every window of texts that stand one after the other."""
    counts = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(sizes)), counts)
    within = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    begins = np.repeat(np.cumsum(sizes) - sizes, counts)
    return np.stack([begins + within, np.minimum(WINDOW, sizes[owner] - within)], axis=1).astype(np.uint64), owner


class Distances:
    """Compressed length with the ordinary dictionary less that with the toxic one."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compressors = [self._compressor(content) for content in (ordinary, toxic)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def of(self, data: bytes, segments: np.ndarray) -> np.ndarray:
        out = np.empty(len(segments), np.int64)
        for at in range(0, len(segments), MOST_WINDOWS):
            part = zstandard.BufferWithSegments(data, np.ascontiguousarray(segments[at : at + MOST_WINDOWS]).tobytes())
            ordinary, toxic = (
                np.array([len(x) for x in compressor.multi_compress_to_buffer(part, threads=1)], np.int64)
                for compressor in self.compressors
            )
            out[at : at + MOST_WINDOWS] = ordinary - toxic
        return out


def measured(distances: Distances, texts: list[bytes], low: float, high: float) -> np.ndarray:
    """One row of MEASURES for each text, from all of its windows."""
    sizes = np.array([len(text) for text in texts], np.int64)
    segments, owner = windows_of(sizes)
    return measures_of(distances.of(b"".join(texts), segments), owner, len(texts), low, high)


def measures_of(distance: np.ndarray, owner: np.ndarray, n: int, low: float, high: float) -> np.ndarray:
    most = np.full(n, -WINDOW)
    np.maximum.at(most, owner, distance)
    count = np.bincount(owner, minlength=n)
    above = [np.bincount(owner, np.maximum(distance - limit, 0.0), minlength=n) for limit in (low, high)]
    mean = np.bincount(owner, distance, minlength=n) / count
    return np.stack([most, mean, above[0] / count, above[1] / count, np.log1p(above[0]), np.log1p(count)], axis=1)


def fit_toxicity_model(
    docs: DataFrame, labels: DataFrame, bounds: ToxicityBounds = ToxicityBounds()
) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic); the caller leaves out the rows that may not be learned."""
    size, step = F.length("text"), bounds.spans - 1
    spread = F.concat_ws(
        " ",
        *(
            F.substring(F.col("text"), F.lit(1) + F.floor((size - bounds.span) * k / step).cast("int"), F.lit(bounds.span))
            for k in range(bounds.spans)
        ),
    )
    part = F.when(size <= bounds.spans * bounds.span, F.col("text")).otherwise(spread)
    rows = sampled_texts(docs, labels, "toxic", bounds.per_class).select("label", part.alias("text")).collect()
    usable = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("toxic").cast("int").alias("toxic")).count()
    counts = dict(tuple(row) for row in usable.collect())  # two rows
    sample = sorted((plain_bytes(row["text"]), row["label"]) for row in rows)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit_to_sample([text for text, _ in sample], np.array([label for _, label in sample], int), share, bounds)


def fit_to_sample(texts: list[bytes], truth: np.ndarray, share: float, bounds: ToxicityBounds) -> ToxicityModel:
    """``share`` is that of class 1 among all labels."""
    if len(set(truth.tolist())) < 2:
        share = float(truth.mean()) if len(truth) else 0.5
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return ToxicityModel(b" " * 8, b" " * 8, 0.0, 0.0, np.append(np.zeros(MEASURES), odds), *FLAT)
    first = np.array([zlib.crc32(text) % 100 < 66 for text in texts])  # equal texts on one side
    if len(set(truth[first].tolist())) < 2 or len(set(truth[~first].tolist())) < 2:
        first[:] = True
    learned = [[text for text, use, label in zip(texts, first, truth) if use and label == c] for c in (0, 1)]
    ordinary, toxic = train_dictionaries(*learned, bounds)
    distances = Distances(ordinary, toxic)
    rest = ~first if not first.all() else first
    held, label = [text for text, use in zip(texts, rest) if use], truth[rest]
    segments, owner = windows_of(np.array([len(text) for text in held], np.int64))
    distance = distances.of(b"".join(held), segments)
    low, high = (
        max(0.0, float(np.quantile(distance[label[owner] == 0], q, method="higher"))) for q in (bounds.low, bounds.high)
    )
    measures = measures_of(distance, owner, len(held), low, high)
    centre, scale = measures.mean(axis=0), measures.std(axis=0) + 1e-9
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean()))
    weights = _logistic((measures - centre) / scale, label, weight)
    return ToxicityModel(ordinary, toxic, low, high, weights, centre, scale)


def train_dictionaries(ordinary: list[bytes], toxic: list[bytes], bounds: ToxicityBounds) -> tuple[bytes, bytes]:
    """The contents of the two dictionaries, of one length."""
    marks = toxic_sequences(ordinary, toxic, bounds)
    segments, _ = windows_of(np.array([len(text) for text in ordinary], np.int64))
    chosen = np.random.default_rng(bounds.seed).permutation(len(segments))[: bounds.windows]
    data = b"".join(ordinary)
    windows = [data[a : a + n] for a, n in segments[chosen].astype(np.int64).tolist()]
    common = _trained([part for window in windows for part in _between(window, marks)], bounds.dictionary)
    passages = [_words_around(text, marks) for text in toxic]
    own = _trained([b" " + b" ".join(words) + b" " for words in passages if words], bounds.toxic)
    return common, own + common[len(own) :]


def toxic_sequences(ordinary: list[bytes], toxic: list[bytes], bounds: ToxicityBounds) -> np.ndarray:
    """The sequences, as sorted numbers, that clearly more toxic documents hold."""
    sequences, held = _document_counts(toxic)
    others, other_held = _document_counts(ordinary)
    if not len(sequences):
        return sequences
    there = np.zeros(len(sequences))
    if len(others):
        place = np.minimum(np.searchsorted(others, sequences), len(others) - 1)
        there = np.where(others[place] == sequences, other_held[place], 0)
    a, b = (held + 0.5) / (len(toxic) + 1), (there + 0.5) / (len(ordinary) + 1)
    spread = np.sqrt(a * (1 - a) / len(toxic) + b * (1 - b) / len(ordinary))
    clear = (a > bounds.times * b) & (a - b > bounds.deviations * spread) & (held >= max(3, 0.01 * len(toxic)))
    return sequences[clear]


def _sequences(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(data) - GRAM + 1)
    value = np.zeros(n, np.uint64)
    for k in range(GRAM):
        value = value << np.uint64(8) | data[k : k + n]
    return value


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    each = [np.unique(_sequences(text)) for text in texts]
    return np.unique(np.concatenate(each or [np.zeros(0, np.uint64)]), return_counts=True)


def _covered(text: bytes, marks: np.ndarray) -> np.ndarray:
    """Which bytes belong to a marked sequence."""
    begin = np.flatnonzero(np.isin(_sequences(text), marks))
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + GRAM, -1)
    return np.cumsum(edge)[:-1] > 0


def _between(text: bytes, marks: np.ndarray) -> Iterator[bytes]:
    """What is left of a text without the marked sequences, in parts of 8 bytes or more."""
    free = np.concatenate([[False], ~_covered(text, marks), [False]]).astype(np.int8)
    turn = np.flatnonzero(np.diff(free))
    for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()):
        if b - a >= 8:
            yield text[a:b]


def _words_around(text: bytes, marks: np.ndarray) -> list[bytes]:
    """The words of which three bytes or more, or all, are marked."""
    blank = np.frombuffer(text, np.uint8) == 0x20
    words = text.split(b" ")
    inside = np.bincount(np.cumsum(blank), _covered(text, marks) & ~blank, minlength=len(words))
    return [word[:MOST_WORD] for word, n in zip(words, inside.tolist()) if n and n >= min(3, len(word))]


def _trained(samples: list[bytes], size: int) -> bytes:
    """At most ``size`` bytes of a dictionary's content; the most useful part of it stands last.

    Where there are too few samples for zstandard's trainer, the most frequent ones are the content.
    """
    if samples:
        try:
            trained = zstandard.train_dictionary(size + 1536, samples * max(1, -(-64 // len(samples))), k=24, d=6)
            return trained.as_bytes()[-size:]  # what precedes the content are tables, which raw content does not use
        except zstandard.ZstdError:
            pass
    often = sorted(Counter(samples).items(), key=lambda item: (item[1], item[0]))
    return b"".join(sample for sample, _ in often)[-size:].rjust(min(size, 8), b" ")


def _logistic(design: np.ndarray, truth: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights and offset by Newton steps, with a small penalty on the weights."""
    design = np.hstack([design, np.ones((len(design), 1))])
    penalty = np.append(np.ones(design.shape[1] - 1), 1e-3)
    weights = np.zeros(design.shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (weight * (chance - truth)) + penalty * weights
        curve = (design * (weight * chance * (1 - chance))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights -= step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return weights


def toxicity_score(spark: SparkSession, model: ToxicityModel, text: str = "text") -> Column:
    """A column between 0 and 1, higher for texts that are likelier toxic."""
    shared = spark.sparkContext.broadcast(model)  # two dictionaries, some 50 kB

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        distances = Distances(shared.value.ordinary, shared.value.toxic)
        for texts in batches:
            yield pa.array(score_texts(shared.value, distances, texts), pa.float64())

    return score.asNondeterministic()(F.coalesce(F.col(text), F.lit("")))


def score_texts(model: ToxicityModel, distances: Distances, texts: pa.Array) -> np.ndarray:
    scores, run, size = [np.zeros(0)], [], 0
    for k, text in enumerate(texts):
        run.append(plain_bytes(text.as_py()))
        size += len(run[-1])
        if size > 1 << 20 or k == len(texts) - 1:
            scores.append(model.score(measured(distances, run, model.low, model.high)))
            run, size = [], 0
    return np.concatenate(scores)
