import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lumbung.llm.merkle import (
    Shape,
    folded,
    group_name,
    leaf_hash,
    path_hash,
    proofs,
    regenerated,
    write_manifest,
)
from lumbung.llm.queries import op13_merkle_manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout=8):
    """(root, siblings of each node level by level) of the plain tree over ``nodes``."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            low = p // fanout * fanout
            paths[k].append(("".join(nodes[low:p]), "".join(nodes[p + 1 : low + fanout])))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        place = [p // fanout for p in place]
    return nodes[0], paths


def brute(rows, fanout=8):
    """The contract's rows for tuples (doc_id, source, lang, n_chars, text)."""
    trees, out = {}, []
    for row in rows:
        trees.setdefault(row[2], []).append((row[0], sha("".join(map(field, row))), row))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    for name in names:
        trees[name].sort(key=lambda leaf: (leaf[0] is not None, leaf[0] or 0, leaf[1]))
    tops = {name: climb([h for _, h, _ in trees[name]], fanout) for name in names}
    root, uppers = climb([tops[name][0] for name in names], fanout)
    for name, upper in zip(names, uppers):
        subroot, paths = tops[name]
        for (doc_id, leaf, row), path in zip(trees[name], paths):
            path = path + upper
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row[4] is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                node = sha("".join(map(field, (*row[:4], text))))
            for left, right in path:
                node = sha(left + node + right)
            out.append((doc_id, leaf, subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


NAMES = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_equals_plain_trees(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r[n] for n in NAMES) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op13_merkle_manifest(spark, folder).collect()), key=str)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_nulls_ties_repeated_rows_and_more_columns(spark, hard_documents, folder):
    hard_documents.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r[n] for n in NAMES) for r in hard_documents.collect()]
    got = sorted((tuple(r) for r in op13_merkle_manifest(spark, folder).collect()), key=str)
    assert got == brute(rows)


def test_an_empty_table_has_no_proofs(spark, no_documents, folder):
    no_documents.write.parquet(f"{folder}/documents.parquet")
    assert op13_merkle_manifest(spark, folder).collect() == []


def manifest_of(spark, folder, sizes, shape):
    rows = [(f"+t{tree}", n, f"{tree}-{n}") for tree, size in enumerate(sizes) for n in range(size)]
    leaves = spark.createDataFrame(rows, "tree string, key long, text string")
    leaves = leaves.select("tree", "key", leaf_hash([F.col("text")]).alias("hash"), F.struct("key").alias("row"))
    return write_manifest(leaves, folder, shape)


@pytest.mark.parametrize("shape", [Shape(2, 2), Shape(3, 1), Shape(2, 3)])
def test_tree_sizes_around_the_ends_of_blocks_and_runs(spark, folder, shape):
    sizes = [1, 2, 3, 4, 5, 8, 9, 15, 16, 17, 33, 64, 65]
    manifest = manifest_of(spark, folder, sizes, shape)
    tops = [climb([sha(field(f"{t}-{n}")) for n in range(size)], shape.fanout) for t, size in enumerate(sizes)]
    # group roots are sorted by name, in which t10 comes before t2
    order = sorted(range(len(sizes)), key=lambda t: f"t{t}")
    root, uppers = climb([tops[t][0] for t in order], shape.fanout)
    assert manifest.root == root
    rows = proofs(manifest).select(
        "tree", "row.key", "hash", "group_root", "path", folded(F.col("hash"), F.col("path")).alias("top"),
        path_hash(F.col("path")).alias("digest"),
    ).collect()
    assert len(rows) == sum(sizes) and all(r.top == root for r in rows)
    for r in rows:
        t = int(r.tree[2:])
        assert r.group_root == tops[t][0]
        want = tops[t][1][r.key] + uppers[order.index(t)]
        assert [(s.left, s.right) for s in r.path] == want
        assert r.digest == sha("".join(a + b for a, b in want))


def test_only_every_few_levels_are_stored(spark, folder):
    manifest = manifest_of(spark, folder, [4096 + 1], Shape(8, 2))
    assert manifest.levels == 3  # 4097 nodes, then 65, then 2
    counts = [manifest.blocks("nodes", k).select(F.explode("nodes")).count() for k in range(3)]
    assert counts == [4097, 65, 2]
    assert manifest.blocks("nodes", 0).agg(F.max(F.size("nodes"))).first()[0] == 64


def test_one_row_repeated_often_fills_several_ranges(spark, folder):
    leaves = spark.range(0, 20_000, 1, 8).select(
        F.lit("+a").alias("tree"), F.lit(1).alias("key"), F.sha2(F.lit("same"), 256).alias("hash"),
        F.struct(F.lit(1).alias("key")).alias("row"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_manifest(leaves, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = spark.read.parquet(f"{folder}/nodes-order")
    assert order.select(F.shiftright("at", 33)).distinct().count() > 1
    assert manifest.root == climb([sha("same")] * 20_000)[0]
    tops = proofs(manifest).select(folded(F.col("hash"), F.col("path")).alias("top")).distinct().collect()
    assert [r.top for r in tops] == [manifest.root]


def test_regenerated_siblings():
    nodes = [sha(str(n)) for n in range(10)]
    assert [tuple(map(tuple, p)) for p in regenerated(nodes, 2, 4)] == [tuple(p) for p in climb(nodes, 4)[1]]
    assert regenerated(nodes[:1], 2, 4) == [[("", ""), ("", "")]]  # the lone last node of a larger tree
    assert regenerated(nodes[:1], 0, 4) == [[]]


def test_names_sort_null_first(spark):
    names = spark.createDataFrame([(None,), ("",), ("z",), ("é",), ("Z",)], "lang string")
    got = [r[0] for r in names.orderBy(group_name(F.col("lang"))).collect()]
    assert got == [None, "", "Z", "z", "é"]
