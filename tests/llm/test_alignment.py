import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumbung.llm.alignment import (
    BYTE_BPE,
    EMPTY,
    PIECE_BPE,
    Aligner,
    Fragment,
    Ranges,
    Vocabularies,
    aligned,
    closed_groups,
    collected_counts,
    compose,
    composed,
    digests,
    group_lists,
    interleaved,
    link_counts,
    most_links,
)


@pytest.fixture(scope="module")
def vocabularies():
    return Vocabularies.read()


class Plain:
    """Both tokenizers on whole texts, and the alignment by a walk over byte offsets."""

    def __init__(self, vocabularies):
        self.a = Tokenizer.from_file(BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
        self.of_a, self.of_b = vocabularies.token_bytes()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        want = (" " + text).encode()
        for ids, table in ((a, self.of_a), (b, self.of_b)):
            if b"".join(table[k] or b"" for k in ids) != want:
                return [], []
        return a, b

    def groups(self, text):
        a, b = self.tokens(text)
        ends_b, at = {}, 0
        for n, k in enumerate(b):
            at += len(self.of_b[k])
            ends_b[at] = n
        out, at, low_a, low_b = [], 0, 0, 0
        for n, k in enumerate(a):
            at += len(self.of_a[k])
            if at in ends_b:
                out.append((a[low_a : n + 1], b[low_b : ends_b[at] + 1]))
                low_a, low_b = n + 1, ends_b[at] + 1
        return out

    def corpus(self, rows):
        """The contract's row of every (doc_id, text)."""
        each = [(doc_id, self.groups(text)) for doc_id, text in rows]
        count = Counter((a[-1], b[-1]) for _, groups in each for a, b in groups)
        best = defaultdict(int)
        for (_, b), n in count.items():
            best[b] = max(best[b], n)
        out = []
        for doc_id, groups in each:
            links = [(a[-1], b[-1]) for a, b in groups]
            text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
            out.append((
                doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            ))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def plain(vocabularies):
    return Plain(vocabularies)


def run(docs, folder, vocabularies, ranges=Ranges()):
    found = aligned(docs, folder, vocabularies, ranges)
    return digests(found, collected_counts(link_counts(found), most_links(vocabularies)))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


#: short ranges, so that many documents need several of them and the tree several rounds
SHORT = Ranges(size=512, fan=3, longest=1 << 19)


@pytest.mark.parametrize("ranges", [Ranges(), SHORT])
def test_given_documents(spark, documents, folder, vocabularies, plain, ranges):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(run(documents, folder, vocabularies, ranges)) == plain.corpus(rows)


HARD = [
    "a▁b", "▁", "<|endoftext|> and <s> </s> <unk> <0x41>", "tab\tand\nlines\r\n end ", "   leading  and  double   blanks   ",
    " ", "  ", "\n", "\x00zero\x00", "ﬁ ligature ａ full width", "emoji 👩‍👩‍👧‍👦 and 𝔘𝔫𝔦", "क्षि हिन्दी", "中文沒有空格的長句子" * 40,
    "x" * 3000, "0123456789" * 200, "no break spaces 　 wide\u0085next", "don't we'll I'm", "a b", "é é",
    "==== ---- ////" * 60, "end with blank ", "ünïcödé wörds " * 50,
]


@pytest.mark.parametrize("ranges", [Ranges(), SHORT])
def test_hard_texts(spark, hard_documents, folder, vocabularies, plain, ranges):
    more = spark.createDataFrame([(1000 + n, t) for n, t in enumerate(HARD)], "doc_id long, text string")
    docs = hard_documents.unionByName(more, allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = result(run(docs, folder, vocabularies, ranges))
    assert got == plain.corpus(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[1000][1:] == (0, 0, 0, 0, 0, 0, "") and by_id[1002][1] > 10


def test_an_empty_table(spark, no_documents, folder, vocabularies):
    assert result(run(no_documents, folder, vocabularies)) == []


def test_copies_of_a_long_document_are_counted_each(spark, folder, vocabularies, plain):
    text = "many different words, 12 numbers and punctuation -- " * 40
    rows = [(5, text)] * 30 + [(6, text), (None, text), (None, text), (7, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(run(docs, folder, vocabularies, SHORT)) == plain.corpus(rows)
    pieces = spark.read.parquet(f"{folder}/read").where("piece IS NOT NULL")
    assert pieces.groupBy("doc_id", "text_hash").agg(F.count_distinct("base").alias("n")).agg(F.min("n")).first()[0] > 3


def test_lists_of_groups(spark, documents, folder, vocabularies, plain):
    docs = documents.where("doc_id < 20")
    found = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in group_lists(aligned(docs, folder, vocabularies)).collect()}
    assert found == {r.doc_id: plain.groups(r.text) for r in docs.collect()}


def streams(rng, n):
    """Random tokens of both sides over one text: (a_ids, a_ends, b_ids, b_ends)."""
    out = []
    for _ in range(2):
        ends = np.array(sorted(rng.sample(range(1, n), rng.randrange(0, n // 2)) + [n]))
        out += [np.array([rng.randrange(1000) for _ in ends], np.uint16), ends]
    return out


def cut_at(tokens, edges):
    a_ids, a_ends, b_ids, b_ends = tokens
    parts = []
    for low, high in zip(edges, edges[1:]):
        a, b = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
        parts.append(Fragment.of(a_ids[a], a_ends[a], b_ids[b], b_ends[b]))
    return parts


def as_text(f):
    return f and [f.cut, *(x.tolist() for x in (f.prefix_a, f.prefix_b, f.ids, f.marks, f.suffix_a, f.suffix_b))]


def test_fragments_of_any_byte_ranges_are_a_monoid():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randrange(2, 60)
        tokens = streams(rng, n)
        edges = [0, *sorted(rng.sample(range(1, n), rng.randrange(0, min(9, n - 1)))), n]
        parts = cut_at(tokens, edges)
        whole = reduce(compose, parts)
        assert as_text(whole) == as_text(composed(parts)) == as_text(reduce(lambda r, l: compose(l, r), parts[::-1]))
        while len(parts) > 1:  # any bracketing
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [Fragment.unpack(compose(parts[k], parts[k + 1]).pack())]
        assert as_text(parts[0]) == as_text(whole)
        assert as_text(compose(EMPTY, whole)) == as_text(whole) == as_text(compose(whole, EMPTY))
        ids, marks = closed_groups(whole)
        want = interleaved(*tokens)
        assert ids.tolist() == want[0].tolist() and marks.tolist() == want[1].tolist()
        assert not len(whole.suffix_a) and not len(whole.suffix_b)
        assert compose(None, whole) is None and compose(whole, None) is None


def test_pieces_give_the_groups_of_the_whole(vocabularies, plain):
    aligner = Aligner(vocabularies)
    text = " ".join(HARD[3:]).replace("▁", "")
    data = (" " + text).encode()
    for size in (1, 7, 64, 1000):
        fragments = [f for _, f in aligner.fragments(data, 0, size)]
        ids, marks = closed_groups(composed(fragments))
        a, b = plain.tokens(text)
        assert ids[marks < 2].tolist() == a and ids[marks >= 2].tolist() == b
        assert len(fragments) == -(-len(data) // size)
        if size < 64:
            assert any(len(f.suffix_a) or not f.cut for f in fragments)  # ranges cut groups


def test_pairs_are_bounded_by_the_vocabularies(spark, documents, folder, vocabularies):
    table = link_counts(aligned(documents, folder, vocabularies)).collect()
    of_a, of_b = vocabularies.token_bytes()
    assert all(of_a[r.a].endswith(of_b[r.b]) or of_b[r.b].endswith(of_a[r.a]) for r in table)
    assert len(table) < most_links(vocabularies) < 1 << 20


def test_a_tree_reaches_the_longest_text():
    assert Ranges().rounds == 3 and Ranges().size * Ranges().fan ** 3 >= 1 << 31
    assert Ranges(size=64, fan=2, longest=64).rounds == 0
