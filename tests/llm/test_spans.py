import random

import pyarrow as pa

from lumbung.llm.spans import Run, column_bytes, slices, span_hashes


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice("ab é\t\n\x0b中.") for _ in range(rng.randrange(12))) for _ in range(300)]
    return ["", None, " ", *made, None]


def test_words_of_all_texts_without_crossing():
    given = pa.array(["before", *texts(), "after"])[1:-1]  # an array that does not begin at offset 0
    data, starts, ends = column_bytes(given)
    for most in (1, 7, 1 << 20):
        found = []
        for i, j in slices(starts, ends, most):
            run = Run(data, starts[i:j], ends[i:j])
            first, last, counts = run.words()
            words = [run.text[a:b].tobytes() for a, b in zip(first, last)]
            hashes = span_hashes(run.prefix(), first, last).tolist()
            assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))
            at = 0
            for n in counts.tolist():
                found.append(words[at : at + n])
                at += n
        assert found == [(text or "").encode().split() for text in given.to_pylist()]


def test_large_strings_and_no_rows():
    data, starts, ends = column_bytes(pa.array(["ab", None, "c"], pa.large_string()))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"", b"c"]
    assert len(column_bytes(pa.array([], pa.string()))[1]) == 0
