"""Clusters and pairs kept up to date by batches, and the links that hold clusters together, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from roadlens.operators import chains, forest, near_index, similarity


def components(nodes, edges):
    label = {n: n for n in nodes} | {x: x for e in edges for x in e}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        label[y] = x
    return {n: find(n) for n in label}


@pytest.mark.parametrize("seed", [1, 2])
def test_forest_equals_a_rebuild(spark, seed):
    """Random batches, and one that merges two clusters of hundreds; loops, repeats and null ends among them."""
    rng = random.Random(seed)
    start = list(range(0, 60, 7))
    kept = forest.forest_of(spark.createDataFrame([(n,) for n in start] + [(None,)], "node long"))
    batches = [[(rng.randrange(400), rng.randrange(400)) for _ in range(60)] for _ in range(2)]
    batches.append([(1000 + k, 1001 + k) for k in range(300)] + [(k, k + 1) for k in range(300)])
    batches.append([(299, 1300), (5, 5), (2000, 2000)] * 2)
    seen = []
    for batch in batches:
        seen += batch
        kept = forest.merged(kept, spark.createDataFrame([*batch, (None, 1), (1, None)], "src long, dst long"))
        got = {r["node"]: r["component"] for r in kept.labels().collect()}
        assert got == components(start, seen)
    renamed = kept.renamed.collect()
    assert len({r["old"] for r in renamed}) == len(renamed) and not {r["old"] for r in renamed} & {r["label"] for r in renamed}
    small = kept.compacted()
    assert small.renamed.isEmpty() and {r["node"]: r["component"] for r in small.labels().collect()} == got
    assert forest.merged(small, spark.createDataFrame([], "src long, dst long")).labels().count() == len(got)


def plain_forest(edges):
    best = {}
    for a, b, w in edges:
        if a is not None and b is not None and w is not None and a != b:
            k = (min(a, b), max(a, b))
            best[k] = min(best.get(k, w), w)
    label, out = {x: x for e in best for x in e}, []

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for (a, b), w in sorted(best.items(), key=lambda e: (e[1], e[0])):
        if find(a) != find(b):
            label[find(a)] = find(b)
            out.append((a, b, w))
    return sorted(out)


def test_spanning_forest_against_kruskal(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60), rng.randrange(6)) for _ in range(150)] + [(100 + k, 101 + k, k % 3) for k in range(120)] + [(7, 7, 0), (None, 3, 1), (3, 4, None), (200, 300, 1), (300, 200, 0)]
    got = [(r["id_a"], r["id_b"], r["distance"]) for r in chains.spanning_forest(spark.createDataFrame(edges, "id_a long, id_b long, distance int")).collect()]
    assert sorted(got) == plain_forest(edges)
    assert chains.spanning_forest(spark.createDataFrame([], "id_a long, id_b long, distance int")).count() == 0


def test_a_chain_falls_into_pieces(spark):
    edges = [(1, 2, 1), (2, 3, 6), (1, 3, 6), (3, 4, 2), (5, 6, 0)]
    clusters = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 4)] + [(5, 5), (6, 5), (7, 7)], "id long, cluster long")
    got = {r["cluster"]: tuple(r)[1:] for r in chains.inspect_chains(chains.spanning_forest(spark.createDataFrame(edges, "id_a long, id_b long, distance int")), clusters, cut=5).collect()}
    assert got == {1: (4, 3, 6, 1, 2, 2), 5: (2, 1, 0, 0, 1, 2)}


# The index


def prints(spark, n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(63) for _ in range(n // 5)]
    rows = []
    for i in range(n):
        fp = base[i % len(base)]
        for _ in range(rng.randrange(0, 9)):
            fp ^= 1 << rng.randrange(63)
        rows.append((i, fp if i % 17 else None))
    return spark.createDataFrame(rows, "id long, fp long")


def pairs_of(df):
    return sorted((r["id_a"], r["id_b"], r["distance"]) for r in df.collect())


@pytest.mark.parametrize("together", [1, 2])
def test_ingested_batches_equal_a_rebuild(spark, tmp_path, together):
    own = prints(spark, 300, together)
    want = pairs_of(similarity.near_pairs(own))
    index = near_index.NearIndex(spark, f"known_{together}", str(tmp_path / "index"), together=together, buckets=4).create()
    got = []
    for lo, hi in ((0, 0), (0, 120), (120, 290), (290, 300)):
        got += pairs_of(index.ingest(own.where((F.col("id") >= lo) & (F.col("id") < hi))))
    assert sorted(got) == want and len(want) > 50
    # Another session finds it by its folder; compaction changes nothing but the files.
    again = near_index.NearIndex(spark, f"again_{together}", str(tmp_path / "index"), together=together, buckets=4).create()
    batch = own.where("id < 40").withColumn("id", F.col("id") + 1000)
    before = pairs_of(again.match(batch))
    files = again.files()
    small = again.compact(str(tmp_path / "small"))
    assert small.files() <= 4 < files and pairs_of(small.match(batch)) == before and any(a - 1000 == b and d == 0 for a, b, d in before)
    for name in (index.table, small.table):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_the_known_side_is_not_moved(spark, tmp_path):
    index = near_index.NearIndex(spark, "still", str(tmp_path / "index"), buckets=4).create()
    index.ingest(prints(spark, 200, 5))
    own = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = index.match(prints(spark, 50, 6))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", own)
    known = plan[plan.index("FileScan parquet spark_catalog.default.still") - 600 :]
    assert "Bucketed: true" in known and plan.count("Exchange hashpartitioning(key") == 1 and "SelectedBucketsCount: 4 out of 4" in known
    spark.sql("DROP TABLE still")
