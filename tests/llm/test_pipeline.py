"""run() against its stages done by hand on what each predecessor kept."""

from collections import Counter

from llm.conftest import SF, words_of
from llm.test_language import FOREIGN, junk
from llm.test_packing import cheapest
from llm.test_rules import by_hand as statistics_by_hand
from llm.test_simhash import fingerprint_by_hand, groups_by_hand

import corpus_pipeline as p
from lumbung.llm.mixing import mixed, mixed_documents
from lumbung.llm.packing import bins_of
from lumbung.llm.queries import LENGTHS


def stages(spark, docs, sf_dir, folder):
    out = [docs]
    for number, (_, stage) in enumerate(p.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{number}")
        out.append(spark.read.parquet(f"{folder}/{number}"))
    return out


def key(row):
    return tuple(map(str, row))


def test_stages_and_run(spark, documents, folder):
    given, spoken, good, single, mixed, packed = stages(spark, documents, SF, folder)
    for df in (spoken, good, single, mixed):
        assert df.columns == documents.columns
    rows = [Counter(map(key, df.collect())) for df in (given, spoken, good, single)]
    assert all(not later - earlier for earlier, later in zip(rows, rows[1:]))
    lettered = [r for r in given.collect() if any(c.isalpha() for c in r.text or "")]
    assert spoken.count() == len(lettered)  # clean documents stay

    for row in good.collect():
        n_words, _, _, _, repeated = statistics_by_hand(row.text)
        assert n_words >= 10 and 100 * repeated <= 20 * n_words
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    passed = {r.doc_id for r in good.collect()}
    clean = [r.doc_id for r in spoken.collect() if labels.get(r.doc_id) == 1
             and (s := statistics_by_hand(r.text))[0] >= 10 and 100 * s[4] <= 20 * s[0]]
    assert all(i in passed for i in clean)

    prints = {r.doc_id: fingerprint_by_hand(r.text) for r in good.collect()}
    roots = groups_by_hand(prints.values(), 3)
    least = {}
    for i, fp in prints.items():
        least[roots[fp]] = min(i, least.get(roots[fp], i))
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values())

    sizes = Counter()
    for r in mixed.collect():
        sizes[r.doc_id] += 1
    assert set(sizes) <= set(least.values()) and max(sizes.values()) <= 3

    words = [len(words_of(r.text)) for r in mixed.collect()]
    pieces = [min(LENGTHS[-1], n - k) for n in words for k in range(0, n, LENGTHS[-1])]
    frame = packed.toPandas()
    bins = frame.groupby("bin_id").agg(capacity=("capacity", "first"), content=("length", "sum"))
    assert sorted(zip(bins.capacity, bins.content)) == cheapest(pieces, bins_of(LENGTHS))

    again = p.run(spark, SF).toPandas()
    order = ["doc_id", "piece", "bin_id", "place"]
    assert again.groupby(["doc_id", "piece"]).size().equals(frame.groupby(["doc_id", "piece"]).size())
    assert sorted(again["length"]) == sorted(frame["length"]) and set(order) <= set(again.columns)


def test_hard_and_empty_tables(spark, hard_documents, no_documents, hard_labels, folder):
    hard_labels.write.parquet(f"{folder}/sf/labels.parquet")
    found = stages(spark, hard_documents, f"{folder}/sf", f"{folder}/hard")
    assert found[1].where("text is null").count() == 0 and found[-1].count() > 0
    assert stages(spark, no_documents, f"{folder}/sf", f"{folder}/none")[-1].collect() == []


CLASHING = ["language_found", "Quality_Found", "__language", "__quality", "__at", "__id", "__n", "__copy", "at", "id", "of",
            "n", "copy", "copies", "row", "high", "low", "fp", "root", "a.b"]


def test_columns_of_the_caller_stay_as_they_are(spark, documents, folder):
    docs = documents.where("doc_id % 2 = 0").withColumns({name: documents["doc_id"] + k for k, name in enumerate(CLASHING)})
    given = {r.doc_id: r for r in docs.collect()}
    for df in stages(spark, docs, SF, folder)[1:-1]:
        assert df.columns == docs.columns
        rows = df.collect()
        assert rows and all(row == given[row.doc_id] for row in rows)


def test_equal_texts_of_two_sources_keep_their_own_copies(spark):
    rows = [(1, "the same words in both", s, n) for n, s in enumerate(["a", "a", "b", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mark long")
    want = Counter()
    for r in mixed(docs, whole_documents=True).collect():
        want[r.source] += len(r.positions)
    got = Counter(r.source for r in mixed_documents(docs).collect())
    assert got == +want and sum(got.values()) > 0


def test_foreign_and_junk_documents_go_and_clean_switches_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.lang: r.text for r in docs.where("length(text) between 400 and 3000").collect()}
    switch = f"{texts['en'][:300]} {texts['de'][:300]} {texts['fr'][:300]}"
    planted = [*FOREIGN, junk(1), junk(2), switch, f"{texts['es'][:100]} {texts['en'][:100]}"]
    rows = [(-1 - n, "src0", None, len(text), text) for n, text in enumerate(planted)]
    more = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    given = docs.unionByName(more.select(docs.columns))
    kept = Counter(r.doc_id for r in p.known_language(spark, given, SF).collect())
    assert {n for n in range(len(planted)) if kept[-1 - n]} == {6, 7}
    lettered = Counter(r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or ""))
    assert all(kept[i] == n for i, n in lettered.items())
