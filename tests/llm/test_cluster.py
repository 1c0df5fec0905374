import random

from lumbung.llm.cluster import components, cut


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(100, 160)] + [(1000, k) for k in range(1001, 1080)] + [(7, 7)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(230)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    df = spark.createDataFrame(links + links[:5], "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {x: find(x) for x in root}
    assert components(df.where("false")).collect() == []


def test_cut_writes_to_the_shared_folder(spark):
    df = cut(spark.range(10).selectExpr("id * 2 AS x"))
    assert df.inputFiles() == [] and df.count() == 10
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()
