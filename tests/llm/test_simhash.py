import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lumbung.llm import simhash
from lumbung.llm.simhash import (
    as_hex,
    fingerprint,
    fingerprint_links,
    first_sets,
    link_sorted,
    near_duplicates,
    one_of_each,
    refined_sets,
)


def fingerprint_by_hand(text):
    words = (text or "").encode().lower().split()
    spans = [words[k : k + 3] for k in range(len(words) - 2)] if len(words) > 2 else [words] * bool(words)
    hashes = [xxh64_intdigest(b" ".join(span), 42) for span in spans]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, distance):
    """The least print of each one's component, from all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def planted(n=250, seed=3):
    rng = random.Random(seed)
    prints = []
    while len(prints) < n:
        base = rng.getrandbits(64)
        prints.append(base)
        for _ in range(rng.choice([0, 0, 1, 6])):
            near = base
            for _ in range(rng.choice([1, 2, 3, 3, 4])):
                near ^= 1 << rng.randrange(64)
            prints.append(near)
            base = rng.choice([base, near])
    return prints


@pytest.mark.parametrize("distance", range(6))
def test_every_pair_meets_in_a_set(distance):
    for differing in itertools.combinations(range(8), distance):
        shared = set(range(8)) - set(differing)
        met = [s for s in first_sets(distance) if set(s) <= shared]
        assert met and all(any(set(r) <= shared for r in refined_sets(s, distance)) for s in met)


@pytest.mark.parametrize("most", [2048, 3])
@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_links_connect_exactly_the_groups(spark, monkeypatch, most, distance):
    monkeypatch.setattr(simhash, "MOST", most)  # 3: entries are refined and searched by masks
    prints = planted()
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fp long").distinct()
    links = [(r.a % 2**64, r.b % 2**64) for r in fingerprint_links(df, distance).collect()]
    wanted = groups_by_hand(prints, distance)
    root = {p: p for p in wanted}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {p: find(p) for p in wanted} == wanted


def test_large_entries_by_masks_equal_shifts():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 20, 6000).astype(np.uint64)).view(np.int64)
    keys = np.zeros(len(prints), np.int64)
    a, b = link_sorted(keys, prints, 2)  # more than twice MOST
    assert len(prints) > 2 * simhash.MOST
    label = {int(p): int(p) for p in prints}
    label.update({int(x): int(y) for x, y in zip(a, b)})
    everything = set(label)
    for p in list(everything)[:300]:
        for bits in itertools.combinations(range(20), 2):
            other = p ^ 1 << bits[0] ^ 1 << bits[1]
            assert other not in everything or label[other] == label[p]


def test_fingerprints(spark, documents, hard_documents):
    for df in (documents, hard_documents):
        for row in df.select("text", fingerprint(3).alias("fp")).select("text", as_hex("fp").alias("h")).collect():
            assert row.h == f"{fingerprint_by_hand(row.text):016x}"


def test_components_of_documents(spark, documents, hard_documents):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for base in range(30):
        text = [rng.choice(words) for _ in range(rng.randrange(40, 400))]
        for copy in range(rng.choice([1, 2, 5])):
            changed = list(text)
            if copy and rng.random() < 0.7:
                changed[rng.randrange(len(changed))] = "changed"
            rows.append((base * 10 + copy, " ".join(changed)))
    rng.shuffle(rows)
    made = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (made, documents.select("doc_id", "text"), hard_documents):
        found = near_duplicates(df).collect()
        given = [(r.doc_id, fingerprint_by_hand(r.text)) for r in df.collect()]
        roots = groups_by_hand([p for _, p in given], 3)
        least = {}
        for i, p in given:
            if i is not None:
                least[roots[p]] = min(i, least.get(roots[p], i))
        wanted = sorted((str(i), p, least.get(roots[p])) for i, p in given)
        assert sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in found) == wanted


def test_one_of_each_component_stays(spark, hard_documents, no_documents):
    kept = one_of_each(hard_documents)
    assert kept.columns == hard_documents.columns
    components = near_duplicates(hard_documents).select("root").distinct().count()
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named))
    prints = [fingerprint_by_hand(r.text) for r in kept.collect()]
    roots = groups_by_hand([fingerprint_by_hand(r.text) for r in hard_documents.collect()], 3)
    assert len({roots[p] for p in prints}) == len(prints)
    # two texts of one id are two components with one least id, of which one row stays
    assert components - len(prints) <= 1
    nameless = hard_documents.withColumn("doc_id", F.lit(None).cast("long"))
    assert one_of_each(nameless).count() == components
    assert one_of_each(no_documents).collect() == [] and near_duplicates(no_documents).collect() == []


def test_components_that_share_an_id_each_keep_a_row(spark, hard_documents):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    rows = [(3, texts[0], "x"), (5, texts[0] + " ", "x"), (5, texts[1], "x")]  # (3,A), (5,A'), (5,B)
    rows += [(7, text, "hot") for text in texts[2:]] * 3  # an id of most rows, and equal rows
    rows += [(None, texts[0], "x"), (None, "a text without an id", "x"), (None, "a text without an id", None)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for docs in (made, made.repartition(7), hard_documents):
        given = [tuple(r) for r in docs.collect()]
        kept = [tuple(r) for r in one_of_each(docs).collect()]
        roots = groups_by_hand([fingerprint_by_hand(r[1]) for r in given], 3)
        least = {}
        for r in given:
            if r[0] is not None:
                least[roots[fingerprint_by_hand(r[1])]] = min(r[0], least.get(roots[fingerprint_by_hand(r[1])], r[0]))
        found = [roots[fingerprint_by_hand(r[1])] for r in kept]
        components = near_duplicates(docs).select("root").distinct().count()
        assert len(kept) == components and sorted(found) == sorted(set(roots.values()))
        assert all(r in given and r[0] == least.get(root) for r, root in zip(kept, found))
