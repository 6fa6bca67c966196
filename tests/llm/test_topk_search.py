import numpy as np
from pyspark.sql import functions as F

from threadwarden.llm import topk_search


def brute(vectors, queries, k):
    out = set()
    for q in {q for q, _ in queries}:
        found = []
        for _, v in {(i, tuple(v)) for i, v in queries if i == q}:
            for i, w in vectors:
                if i != q:
                    found.append((-sum(a * b for a, b in zip(v, w)), i))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])}
    return sorted(out)


def search(spark, vectors, queries, k, **options):
    frame = lambda rows: spark.createDataFrame([(i, list(map(int, v)), "clash") for i, v in rows], "vec_id bigint, vector array<bigint>, score string")
    return sorted(tuple(r) for r in topk_search.exact_top_k(frame(vectors), frame(queries), k, **options).collect())


def test_results_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-9, 10, 6)) for i in range(400)]
    queries = [v for v in vectors if v[0] % 40 == 0] + [(1, np.zeros(6, int)), (2, -np.ones(6, int))]
    assert search(spark, vectors, queries, 10, block_rows=50, query_rows=3) == brute(vectors, queries, 10)


def test_ties_repeats_lengths_and_few_rows(spark):
    vectors = [(5, [1, 1]), (3, [1, 1]), (3, [1, 1]), (9, [2]), (7, []), (1, [0, 0, 4])]
    queries = [(5, [1, 1]), (5, [1, 1]), (0, [0, 0, 0])]
    assert search(spark, vectors, queries, 4) == brute(vectors, queries, 4)
    assert search(spark, vectors[:1], vectors[:1], 4) == []
    assert search(spark, [(1, [3 << 40])], [(2, [5 << 15])], 4) == [(2, 1, 1, 15 << 55)]


def test_the_walk_stops_early():
    rng = np.random.default_rng(0)
    block = topk_search.Block(np.arange(5000), rng.integers(-1000, 1000, (5000, 2)))
    met = []
    block._double = type("Counted", (np.ndarray,), {})
    del block._double
    rows = block._as_double()

    class Watched:
        def __getitem__(self, at):
            met.append(len(at))
            return rows[at]

    block._double = Watched()
    ids, _ = block.top(-1, np.array([3, -2]), 10)
    assert sum(met) < 2500 and len(ids) == 10


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [-0.0001, 0.9999])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    kept = df.filter(topk_search.usable(F.col("embedding"))).select("vec_id", topk_search.quantised(F.col("embedding")).alias("v"))
    assert sorted((r.vec_id, r.v) for r in kept.collect()) == [(1, [1024, 2048]), (6, []), (7, [-1, 1023])]
    empty = kept.limit(0).withColumnRenamed("v", "vector")
    assert topk_search.exact_top_k(empty, empty).count() == 0
