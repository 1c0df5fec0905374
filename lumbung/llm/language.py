"""Language identification by a linear-chain conditional random field over words.

Every word of a text is a position of the chain and every learned language a
state.  A word's score for a language adds the weights of its affixes (one to
three bytes at either end), its byte bigrams and trigrams, and its lexicon entry
if it is a frequent word of the training texts; learned transitions say how
likely the next word stays in the language.  Forward-backward gives each word's
distribution, and a text's language is the one with the most words in
expectation, so a text that switches languages is weighed word by word.

Every label is learned.  Training is bounded by ``TrainingBounds`` (documents,
segments, words) and does not grow with the corpus; prediction covers every word
of every text.  A column with more than ``MOST_LABELS`` labels is refused with an
error, since the model holds ``TABLE`` rows for each of them.  The
training sequences join segments of different languages, from which the
transitions are learned.

Whether a text is in any learned language is another question, since some language
always fits best: ``Evidence`` compares a byte trigram model of all training words
with the frequencies of their bytes alone.  A text's evidence is the mean of its
words', so a text that switches languages has as much as others; its level is
learned on training documents that the compared model has not seen.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; with
no labelled row every text is ``und``; ties go to the smaller label; labels are
only read by ``fit_language_model``.  Columns of the input keep their values, and
``predict_language`` returns a column, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.labelled import sampled_rows
from lumbung.llm.spans import Run, column_bytes, mix, slices, span_hashes

UNDETERMINED = "und"
TABLE = 1 << 16  # rows of each hashed feature family
BLOCK = 256  # words of a chain that one matrix product covers
MOST_LABELS = 1000  # more raise an error

#: letters and all bytes of longer UTF-8 sequences make words; texts are lower case by then
APART = np.ones(256, bool)
APART[list(range(ord("a"), ord("z") + 1))] = False
APART[0x80:] = False


@dataclass(frozen=True)
class TrainingBounds:
    """What is read for training, whatever the size of the corpus."""

    languages: int = 64  # with so many whole samples; more languages, all learned, share as many documents
    documents: int = 160  # of each language
    segments: int = 8  # of each document, evenly spread over the whole text
    words: int = 16  # of each segment
    lexicon: int = 400  # most frequent words of each language
    rounds: int = 40
    seed: int = 11


@dataclass(frozen=True)
class Evidence:
    """Log-likelihood ratio of a word's bytes, given the two before each, to their frequencies.

    The ratio of a byte is a term of its context and, if training has the trigram, one of
    that: bytes in unknown contexts tell nothing, unknown bytes in known contexts speak against.
    """

    context: np.ndarray  # term of each pair of bytes
    trigrams: np.ndarray  # sorted
    gains: np.ndarray  # their terms
    low: float = -np.inf  # halfway between words of mixed up letters and words of the hardest language
    spread: float = 0.0  # standard deviation of the words' evidence

    def known(self, mean: np.ndarray, words: np.ndarray) -> np.ndarray:
        """False where the mean of so many words is below the level by more than chance."""
        return mean + 3 * self.spread / np.sqrt(np.maximum(words, 1)) >= self.low


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    weights: np.ndarray  # hashed features by language
    lexicon: np.ndarray  # sorted word hashes
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    evidence: Evidence


def labelled_sample(docs: DataFrame, bounds: TrainingBounds) -> list[tuple[str, list[str]]]:
    """(label, segments) of a bounded sample of each label; the first step lists the labels only."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"[a-zA-Z]|[^\x00-\x7f]"))
    labels = labelled.select("lang").distinct().limit(MOST_LABELS + 1).count()
    if labels > MOST_LABELS:
        raise ValueError(f"lang has more than {MOST_LABELS} labels; a model of them does not fit the driver")
    each = max(1, min(bounds.documents, bounds.languages * bounds.documents // max(1, labels)))

    @F.arrow_udf("array<string>")
    def segments(texts: pa.Array) -> pa.Array:
        return pa.array([_segments(text, bounds) for text in texts.to_pylist()], pa.list_(pa.string()))

    rows = labelled.select("lang", "doc_id", "text")
    rows = sampled_rows(rows, "lang", each).select("lang", segments(F.lower("text")).alias("parts")).collect()
    return sorted((row["lang"], list(row["parts"])) for row in rows if row["parts"])


def _segments(text: str | None, bounds: TrainingBounds) -> list[str]:
    column = pa.array([text or ""])
    run = Run(*column_bytes(column))
    first, last, _ = run.words(APART)
    if len(first) == 0:
        return []
    n = min(bounds.segments, -(-len(first) // bounds.words))
    begins = np.unique(np.linspace(0, max(0, len(first) - bounds.words), n).astype(int))
    text_bytes = run.text.tobytes()
    out = []
    for i in begins:
        j = min(len(first), i + bounds.words)
        out.append(b" ".join(text_bytes[a:b] for a, b in zip(first[i:j], last[i:j])).decode("utf-8", "ignore"))
    return out


def word_features(run: Run, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows: bigram and trigram of each byte, affixes and hash of each word.

    Row ``4 * TABLE`` has no weight; bytes that end no bigram or trigram inside a word get it.
    """
    text = run.text.astype(np.int64)
    inside = ~APART[run.text]
    two = inside.copy()
    two[first] = False
    three = two.copy()
    after = first + 1
    three[after[after < last]] = False
    bigram = np.full(len(text), 4 * TABLE, np.int64)
    bigram[1:] = np.where(two[1:], text[:-1] << 8 | text[1:], 4 * TABLE)
    trigram = np.full(len(text), 4 * TABLE, np.int64)
    if len(text) > 2:
        rows = (text[:-2] * 40503 + text[1:-1] * 10007 + text[2:] * 257) & (TABLE - 1)
        trigram[2:] = np.where(three[2:], rows + TABLE, 4 * TABLE)
    prefix = run.prefix()
    affixes = np.empty((len(first), 6), np.int64)
    for k in (1, 2, 3):
        head = span_hashes(prefix, first, np.minimum(first + k, last)) + np.uint64(k)
        tail = span_hashes(prefix, np.maximum(last - k, first), last) + np.uint64(k)
        affixes[:, k - 1] = (mix(head) & np.uint64(TABLE - 1)).astype(np.int64) + 2 * TABLE
        affixes[:, k + 2] = (mix(tail) & np.uint64(TABLE - 1)).astype(np.int64) + 3 * TABLE
    return bigram, trigram, affixes, span_hashes(prefix, first, last)


def _distinct_words(run: Run, first: np.ndarray, last: np.ndarray) -> tuple[Run, np.ndarray, np.ndarray, np.ndarray]:
    """(run, begins, ends) of the distinct words, and the number of each word's."""
    _, at, again = np.unique(span_hashes(run.prefix(), first, last), return_index=True, return_inverse=True)
    size = last[at] - first[at]
    ends = np.cumsum(size)
    begins = ends - size
    words = Run(run.text[np.repeat(first[at] - begins, size) + np.arange(ends[-1])], begins, ends)
    return words, begins, ends, again


def word_scores(model: LanguageModel, run: Run, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Score of each word for each language; a word that comes again is scored once."""
    words, begins, ends, again = _distinct_words(run, first, last)
    bigram, trigram, affixes, hashes = word_features(words, begins, ends)
    by_byte = model.weights[bigram]
    by_byte += model.weights[trigram]
    scores = np.add.reduceat(by_byte, begins, axis=0)
    for k in range(affixes.shape[1]):
        scores += model.weights[affixes[:, k]]
    if len(model.lexicon):
        near = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
        known = model.lexicon[near] == hashes
        scores[known] += model.lexicon_weights[near[known]]
    return scores[again]


def expected_words(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over one chain for each text: the expected words of each language.

    A chain is cut into blocks; the product of a block's transition matrices
    carries the forward and backward vectors over it, so thousands of blocks take
    each step together and the result is that of the whole chain.
    """
    states = scores.shape[1]
    out = np.zeros((len(counts), states))
    blocks = -(-counts // BLOCK)
    n = int(blocks.sum())
    if n == 0:
        return out
    move = np.exp(transitions)
    owner = np.repeat(np.arange(len(counts)), blocks)
    head = np.cumsum(blocks) - blocks  # first block of each text
    rank = np.arange(n) - head[owner]
    begin = (np.cumsum(counts) - counts)[owner] + rank * BLOCK
    length = np.minimum(counts[owner] - rank * BLOCK, BLOCK)
    order = np.argsort(-length, kind="stable")  # the blocks that still have a k-th word come first
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    begin, length = begin[order], length[order]
    alive = [int(np.searchsorted(-length, -k)) for k in range(int(length[0]) + 1)]
    steps = len(alive) - 1
    chance = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)

    start = np.full((n, states), 1.0 / states)
    stop = np.ones((n, states))
    if (blocks > 1).any():
        product = np.tile(np.eye(states), (n, 1, 1))
        for k in range(steps):
            m = alive[k]
            now = (product[:m].reshape(-1, states) @ move).reshape(m, states, states)
            now *= chance[begin[:m] + k][:, None, :]
            now /= now.max(axis=(1, 2), keepdims=True)
            product[:m] = now
        for r in range(int(blocks.max()) - 1):
            texts = np.flatnonzero(blocks > r + 1)
            here, there = place[head[texts] + r], place[head[texts] + r + 1]
            vector = np.einsum("ns,nst->nt", start[here], product[here])
            start[there] = vector / vector.sum(axis=1, keepdims=True)
        for r in range(int(blocks.max()) - 2, -1, -1):
            texts = np.flatnonzero(blocks > r + 1)
            here, there = place[head[texts] + r], place[head[texts] + r + 1]
            vector = np.einsum("nst,nt->ns", product[there], stop[there])
            stop[here] = vector / vector.sum(axis=1, keepdims=True)

    forward = np.empty((steps, n, states))
    vector = start
    for k in range(steps):
        m = alive[k]
        vector = (vector[:m] @ move) * chance[begin[:m] + k]
        vector /= vector.sum(axis=1, keepdims=True)
        forward[k, :m] = vector
    total = np.zeros((n, states))
    for k in range(steps - 1, -1, -1):
        m = alive[k]
        share = forward[k, :m] * stop[:m]
        total[:m] += share / share.sum(axis=1, keepdims=True)
        back = (stop[:m] * chance[begin[:m] + k]) @ move.T
        stop[:m] = back / back.sum(axis=1, keepdims=True)
    np.add.at(out, owner[order], total)
    return out


def _trigrams(run: Run, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams that end at each byte of the words and at the blank after, and each word's first one."""
    size = last - first + 1
    begins = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(first - begins, size)
    low, high = np.repeat(first, size), np.repeat(last, size)
    text = np.append(run.text, 0x20).astype(np.int64)

    def byte(k: int) -> np.ndarray:
        place = at - k
        return np.where((place >= low) & (place < high), text[np.maximum(place, 0)], 0x20)

    return byte(2) << 16 | byte(1) << 8 | byte(0), begins


def word_evidence(evidence: Evidence, run: Run, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Mean over the bytes of each word; a word that comes again is compared once."""
    if not len(first):
        return np.zeros(0)
    words, begins, ends, again = _distinct_words(run, first, last)
    trigrams, heads = _trigrams(words, begins, ends)
    terms = evidence.context[trigrams >> 8]
    if len(evidence.trigrams):
        at = np.minimum(np.searchsorted(evidence.trigrams, trigrams), len(evidence.trigrams) - 1)
        terms = terms + np.where(evidence.trigrams[at] == trigrams, evidence.gains[at], 0.0)
    return (np.add.reduceat(terms, heads) / (ends - begins + 1))[again]


def _words_run(parts: list[str]) -> tuple[Run, np.ndarray, np.ndarray]:
    run = Run(*column_bytes(pa.array(parts, pa.string())))
    first, last, _ = run.words(APART)
    return run, first, last


def _ratios(parts: list[str], prior: float = 2.0) -> Evidence:
    """Terms from counts; a context's counts are joined by ``prior`` bytes as frequent as in all words."""
    trigrams, _ = _trigrams(*_words_run(parts))
    codes, counts = np.unique(trigrams, return_counts=True)
    contexts = np.bincount(codes >> 8, counts, 1 << 16)
    shares = np.bincount(codes & 0xFF, counts, 256) / max(1, counts.sum())
    gains = np.log1p(counts / (prior * shares[codes & 0xFF]))
    return Evidence(np.log(prior / (prior + contexts)), codes, gains)


def fit_evidence(sample: list[tuple[str, list[str]]], seed: int) -> Evidence:
    """The ratios of all segments; the level is that of every other document by those between them.

    Without two documents of a language, or where mixing up the letters makes no
    difference, there is no level and every text is known.
    """
    random = np.random.default_rng(seed)
    by_label: dict[str, list[list[str]]] = {}
    for label, parts in sample:
        by_label.setdefault(label, []).append(parts)
    learned = [part for texts in by_label.values() for parts in texts[::2] for part in parts]
    half, whole = _ratios(learned), _ratios([part for _, parts in sample for part in parts])
    found = [
        word_evidence(half, *_words_run([part for parts in texts[1::2] for part in parts]))
        for texts in by_label.values()
        if len(texts) > 1
    ]
    if not found:
        return whole
    letters = ["".join(random.permutation(list(word))) for part in learned for word in part.split(" ")]
    mixed_up = word_evidence(half, *_words_run([" ".join(letters)])).mean()
    hardest = min(values.mean() for values in found)
    if hardest <= mixed_up:
        return whole
    spread = max(float(values.std()) for values in found)
    return replace(whole, low=float(mixed_up + hardest) / 2, spread=spread)


def fit_language_model(docs: DataFrame, bounds: TrainingBounds = TrainingBounds()) -> LanguageModel | None:
    """Learn from the non-NULL ``lang`` of ``docs`` (doc_id, text, lang); None without any."""
    sample = labelled_sample(docs, bounds)
    labels = sorted({label for label, _ in sample})
    if not labels:
        return None
    number = {label: k for k, label in enumerate(labels)}
    parts = [(number[label], part.split(" ")) for label, texts in sample for part in texts]
    sequences, states = _switching_sequences(parts, len(labels), bounds)
    lexicon, known = _lexicon(parts, len(labels), bounds)
    run = Run(*column_bytes(pa.array([" ".join(words) for words in sequences])))
    first, last, counts = run.words(APART)
    bigram, trigram, affixes, hashes = word_features(run, first, last)
    # one row of features for each word; rows of no weight pad the shorter ones
    word_of = np.repeat(np.arange(len(first)), last - first)
    bytes_of = np.concatenate([np.arange(a, b) for a, b in zip(first, last)]) if len(first) else np.zeros(0, int)
    at = np.minimum(np.searchsorted(lexicon, hashes), max(0, len(lexicon) - 1))
    found = (lexicon[at] == hashes) if len(lexicon) else np.zeros(len(hashes), bool)
    nothing = 4 * TABLE
    rows = np.concatenate(
        [bigram[bytes_of], trigram[bytes_of], affixes.T.ravel(), np.where(found, nothing + 1 + at, nothing)]
    )
    words = np.concatenate([word_of, word_of, np.tile(np.arange(len(first)), 6), np.arange(len(first))])
    keep = rows != nothing
    seen, rows = np.unique(rows[keep], return_inverse=True)
    learned, transitions = _train(rows, words[keep], counts, np.concatenate(states), len(labels), len(seen), bounds)
    weights = np.zeros((nothing + 1 + len(lexicon), len(labels)))
    weights[seen] = learned
    return LanguageModel(
        labels,
        weights[: nothing + 1].astype(np.float32),
        lexicon,
        weights[nothing + 1 :].astype(np.float32),
        transitions,
        fit_evidence(sample, bounds.seed),
    )


def _switching_sequences(parts, languages: int, bounds: TrainingBounds):
    """Half of the sequences stay in one language, half go on in another after some words."""
    random = np.random.default_rng(bounds.seed)
    by_language = [[words for label, words in parts if label == k] for k in range(languages)]
    sequences, states = [], []
    for label, words in parts:
        other = int(random.integers(languages))
        if other != label and random.random() < 0.5 and by_language[other]:
            more = by_language[other][int(random.integers(len(by_language[other])))]
            cut, skip = int(random.integers(1, len(words) + 1)), int(random.integers(len(more)))
            sequences.append(words[:cut] + more[skip:])
            states.append(np.array([label] * cut + [other] * (len(more) - skip)))
        else:
            sequences.append(words)
            states.append(np.array([label] * len(words)))
    return sequences, states


def _lexicon(parts, languages: int, bounds: TrainingBounds) -> tuple[np.ndarray, list[str]]:
    chosen: set[str] = set()
    for k in range(languages):
        seen: dict[str, int] = {}
        for label, words in parts:
            if label == k:
                for word in words:
                    seen[word] = seen.get(word, 0) + 1
        chosen.update(sorted((w for w in seen if seen[w] > 2), key=lambda w: (-seen[w], w))[: bounds.lexicon])
    words = sorted(chosen)
    if not words:
        return np.zeros(0, np.uint64), []
    run = Run(*column_bytes(pa.array(words)))
    return np.unique(span_hashes(run.prefix(), run.starts, run.ends)), words


def _train(rows, words, counts, truth, languages, size, bounds):
    """Adam on the mean log-likelihood of whole sequences, with a small quadratic penalty."""
    order = np.argsort(words, kind="stable")
    rows, words = rows[order], words[order]
    begins = np.searchsorted(words, np.arange(len(truth)))
    weights, transitions = np.zeros((size, languages)), np.zeros((languages, languages))
    longest = int(counts.max())
    head = np.cumsum(counts) - counts
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(transitions), np.zeros_like(transitions)]
    one_hot = np.eye(languages)[truth]
    pairs = np.zeros((languages, languages))
    inner = np.ones(len(truth), bool)
    inner[head[counts > 0]] = False
    later = np.flatnonzero(inner)
    np.add.at(pairs, (truth[later - 1], truth[later]), 1)
    for turn in range(1, bounds.rounds + 1):
        scores = np.stack([np.add.reduceat(weights[rows, k], begins) for k in range(languages)], axis=1)
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        move = np.exp(transitions)
        forward, back = np.zeros((len(truth), languages)), np.ones((len(truth), languages))
        for k in range(longest):
            at = (head + k)[counts > k]
            before = forward[at - 1] if k else np.full((len(at), languages), 1.0 / languages)
            vector = (before @ move) * chance[at]
            forward[at] = vector / vector.sum(axis=1, keepdims=True)
        for k in range(longest - 2, -1, -1):
            at = (head + k)[counts > k + 1]
            vector = (back[at + 1] * chance[at + 1]) @ move.T
            back[at] = vector / vector.sum(axis=1, keepdims=True)
        share = forward * back
        share /= share.sum(axis=1, keepdims=True)
        start, stop = forward[later - 1], back[later] * chance[later]
        start = start / ((start @ move) * stop).sum(axis=1, keepdims=True)
        both = (start.T @ stop) * move  # summed over the words, which would need a matrix each
        wrong = share - one_hot
        slope = np.stack([np.bincount(rows, wrong[words, k], size) for k in range(languages)], axis=1)
        for parameter, gradient, m, v in (
            (weights, slope / len(truth) + 1e-6 * weights, moments[0], moments[1]),
            (transitions, (both - pairs) / len(truth) + 1e-6 * transitions, moments[2], moments[3]),
        ):
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            parameter -= 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return weights, transitions


def predict_language(
    spark: SparkSession, model: LanguageModel | None, text: str = "text", known: bool = False
) -> Column:
    """A column struct<lang_pred, score> of the whole text.

    With ``known`` a third field says whether its words look like those of the learned languages.
    """
    none = [F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")]
    none = F.struct(*none, *[F.lit(False).alias("known")] * known)
    if model is None:
        return none
    shared = spark.sparkContext.broadcast(model)  # bounded by TrainingBounds, some MB

    @F.arrow_udf(f"struct<lang_pred: string, score: double{', known: boolean' * known}>")
    def predicted(texts: pa.Array) -> pa.Array:
        return _predict(shared.value, texts, known)

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = predicted.asNondeterministic()(F.when(letter, F.lower(text)))  # else planned once for each use
    return F.when(letter, found).otherwise(none)


def _predict(model: LanguageModel, texts: pa.Array, with_known: bool) -> pa.Array:
    data, starts, ends = column_bytes(texts)
    best, score, known = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts), bool)
    for i, j in slices(starts, ends, (4 << 20) * 4 // max(4, len(model.labels))):
        run = Run(data, starts[i:j], ends[i:j])
        first, last, counts = run.words(APART)
        if len(first) == 0:
            continue
        share = expected_words(word_scores(model, run, first, last), counts, model.transitions)
        best[i:j] = share.argmax(axis=1)
        score[i:j] = np.clip(share.max(axis=1) / np.maximum(counts, 1), 0.0, 1.0)
        if with_known:
            known[i:j] = _known(model.evidence, run, first, last, counts)
    fields = {"lang_pred": pa.array(model.labels, pa.string()).take(pa.array(best)), "score": pa.array(score)}
    if with_known:
        fields["known"] = pa.array(known)
    return pa.StructArray.from_arrays(list(fields.values()), list(fields))


def _known(evidence: Evidence, run: Run, first: np.ndarray, last: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text; letters beside a digit are of a code or number, which belongs to no language."""
    owner = np.repeat(np.arange(len(counts)), counts)
    digit = (run.text >= 0x30) & (run.text <= 0x39)
    before = (first > run.starts[owner]) & digit[np.maximum(first - 1, 0)]
    after = (last < run.ends[owner]) & digit[np.minimum(last, len(digit) - 1)]
    plain = ~(before | after)
    total = np.bincount(owner[plain], word_evidence(evidence, run, first[plain], last[plain]), len(counts))
    words = np.bincount(owner[plain], minlength=len(counts))
    return evidence.known(total / np.maximum(words, 1), words)
