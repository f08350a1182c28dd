import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import topk


def slow(rows, k, every):
    vs = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in vs:
        if i % every == 0:
            best = sorted((-int(q @ v), j) for j, v in vs if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "pivots", "k"), [(16, 8, 5), (4096, 3, 20), (7, 1, 40)])
def test_against_brute_force(spark, block_rows, pivots, k):
    rng = np.random.default_rng(block_rows)
    centres = rng.normal(size=(5, 6))
    rows = [(i, [float(x) for x in centres[i % 5] + 0.2 * rng.normal(size=6)]) for i in range(240)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # a hot copy, more than a block
    rows += [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, rows[0][1]), (2010, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("x")).withColumn("score", F.lit(None).cast("string"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, k=k, every=20, pivots=pivots, block_rows=block_rows).collect())
    assert got == slow(rows, k, 20)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df).collect()] == [(20, 1, 21, 2048)]
    assert topk.top_k(df.limit(0)).collect() == []


def test_large_components_stay_exact():
    q, x = np.array([[2**40, 3]]), np.array([[2**20, 1], [5, 2**50]])
    assert topk.scores(q, x).tolist() == [[2**60 + 3, 5 * 2**40 + 3 * 2**50]]


def test_clustered_vectors_need_few_blocks(spark):
    """Clusters far apart, of unlike norms: the bounds leave less than a fifth of the blocks, and the results are exact."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16)) * rng.uniform(2, 4, size=(40, 1))
    rows = [(i, [float(x) for x in centres[i % 40] + 0.02 * rng.normal(size=16)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = []
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, k=10, block_rows=64, visits=lambda asks, blocks: seen.append((asks.count(), blocks))).collect())
    assert got == slow(rows, 10, 20)
    (asked, blocks), queries = seen[0], 200
    assert blocks >= 60 and asked < 0.2 * queries * blocks
