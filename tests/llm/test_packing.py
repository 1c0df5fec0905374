from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumbung.llm.packing import Bin, best_packing, bins_of, pack_histogram, packed, total_cost


def piece_by_piece(sizes, bins, prefer=None):
    """Best fit decreasing over single pieces: (length, content) of every bin."""
    rooms, contents = [], []
    for size in sorted(sizes, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= size]
        if fitting:
            at = min(fitting, key=lambda k: rooms[k])
        else:
            if prefer is None:
                kind = min((b for b in bins if b.length >= size), key=lambda b: (b.cost / b.length, b.length))
            else:
                kind = min((b for b in bins if b.length >= max(size, prefer)), key=lambda b: b.length)
            rooms.append(kind.length)
            contents.append(0)
            at = len(rooms) - 1
        rooms[at] -= size
        contents[at] += size
    downsized = (min((b for b in bins if b.length >= c), key=lambda b: (b.cost, b.length)) for c in contents)
    return sorted((b.length, c) for b, c in zip(downsized, contents))


def price(made, bins):
    return sum(next(b.cost for b in bins if b.length == length) for length, _ in made)


def cheapest(sizes, bins):
    """The least total cost of all rules for the length to open, the first rule of equal ones."""
    rules = [*sorted(b.length for b in bins), None]
    return min((piece_by_piece(sizes, bins, prefer) for prefer in rules), key=lambda made: price(made, bins))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60), st.sets(st.integers(1, 30)), st.lists(st.integers(1, 60), min_size=31, max_size=31))
def test_histogram_packing_is_piece_by_piece_best_fit(sizes, lengths, costs):
    bins = [Bin(length, costs[length]) for length in lengths | {30}]
    runs = pack_histogram(Counter(sizes), bins)
    loads, cells, taken = Counter(), set(), Counter()
    for length, first, last, begin, each, offset in zip(
        runs.length, runs.first, runs.last, runs.bin, runs.each, runs.offset
    ):
        for rank in range(first, last):
            at, place = begin + (rank - first) // each, offset + (rank - first) % each * length
            loads[int(at)] += int(length)
            span = {(int(at), c) for c in range(place, place + length)}
            assert not span & cells
            cells |= span
            taken[int(length)] += 1
    assert taken == Counter(sizes)
    ends = [*runs.groups[1:], len(loads)]
    made = [(int(c), int(k)) for b, e, c, k in zip(runs.groups, ends, runs.capacity, runs.content) for _ in range(b, e)]
    assert sorted(made) == piece_by_piece(sizes, bins)
    assert sorted(loads.values()) == sorted(k for _, k in made)


def test_every_word_has_one_place(spark):
    sizes = [0, 1, 1, 5, 70, 70, 70, 128, 129, 300, 4, 4, 4, 4, 64, 64, None]
    rows = [(n if n % 5 else None, size) for n, size in enumerate(sizes)] + [(1, 1), (1, 1)]
    found = packed(spark.createDataFrame(rows, "doc_id long, size long"), bins_of((32, 64, 128))).toPandas()
    assert found["length"].sum() == sum(size or 0 for _, size in rows)
    cells = [(b, p + k) for b, p, n in zip(found.bin_id, found.place, found.length) for k in range(n)]
    assert len(cells) == len(set(cells))
    assert (found.place + found.length <= found.content).all() and (found.content <= found.capacity).all()
    assert (found.groupby("bin_id").length.sum() == found.groupby("bin_id").content.first()).all()
    one = found[found.doc_id == 9].sort_values("piece")
    assert one.start.tolist() == [0, 128, 256] and one["length"].tolist() == [128, 128, 44]


def test_packing_of_many_parts_equals_the_histogram(spark):
    rng = np.random.default_rng(2)
    sizes = np.where(rng.random(6000) < 0.4, 17, rng.integers(1, 129, 6000)).tolist()  # a frequent length
    docs = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, size long").repartition(13)
    found = packed(docs, bins_of((32, 64, 128))).toPandas()
    bins = found.groupby("bin_id").agg(capacity=("capacity", "first"), content=("length", "sum"))
    assert sorted(zip(bins.capacity, bins.content)) == cheapest(sizes, bins_of((32, 64, 128)))


def test_empty_table(spark):
    assert packed(spark.createDataFrame([], "doc_id long, size long"), bins_of((8,))).collect() == []


def test_a_piece_has_to_fit():
    with pytest.raises(ValueError):
        pack_histogram({9: 1}, [Bin(8, 1.0)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60), st.sets(st.integers(1, 30)), st.lists(st.integers(1, 60), min_size=31, max_size=31))
def test_the_cheapest_packing_is_taken(sizes, lengths, costs):
    bins = [Bin(length, costs[length]) for length in lengths | {30}]
    runs = best_packing(Counter(sizes), bins)
    assert total_cost(runs, bins) == price(cheapest(sizes, bins), bins)


def test_several_lengths_are_opened_and_cost_less_than_one(spark):
    from lumbung.llm.queries import LENGTHS

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sizes = [r[0] for r in docs.selectExpr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')").collect()]
    pieces = Counter(min(LENGTHS[-1], n - k) for n in sizes for k in range(0, n, LENGTHS[-1]))
    bins = bins_of(LENGTHS)
    chosen = total_cost(best_packing(pieces, bins), bins)
    longest, shortest = (total_cost(pack_histogram(pieces, bins, k), bins) for k in (LENGTHS[-1], LENGTHS[0]))
    assert chosen < longest and chosen <= shortest
    opened = {min(b for b in LENGTHS if b >= c) for c in best_packing(pieces, bins).capacity}
    assert len(opened) >= 3
