import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riverdeck.llm.neighbours import entries, fit_forest, fitted_share, neighbour_report, search


def exact(ids, x, k):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def lists(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_recall_and_scores(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    truth, got, hit = exact(ids, x, 20), lists(neighbour_report(table)), 0
    assert got.keys() == truth.keys()
    at = {int(i): k for k, i in enumerate(ids)}
    for q, own in got.items():
        assert [r for r, *_ in own] == list(range(1, 21))
        assert all(abs(s - x[at[q]] @ x[at[v]]) < 1e-12 for _, v, s in own)
        assert [s for *_, s in own] == sorted([s for *_, s in own], reverse=True)
        hit += len({v for _, v, _ in own} & {v for v, _ in truth[q]})
    assert hit / sum(map(len, truth.values())) >= 0.9


def test_hot_vector_ties_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).round(3)
    x[100:200] = x[0]  # a third of all rows are copies
    rows = [(k, [float(v) for v in x[k]]) for k in range(300)]
    odd = [(400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [float("inf")] + [1.0] * 7),
           (480, [None] + [1.0] * 7), (500, [1.0] * 3), (520, []), (None, [1.0] * 8), (20, [float(v) for v in x[20]])]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("key", F.lit(1)).repartition(4)
    got, truth = lists(neighbour_report(table)), exact(np.arange(300), x, 20)
    assert got.keys() == truth.keys()
    for q, own in got.items():
        assert [v for _, v, _ in own] == [v for v, _ in truth[q]]


def test_few_rows(spark):
    few = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "id bigint, vector array<double>")
    assert lists(search(few, F.col("id") % 20 == 0, 20)) == {20: [(1, 1, 0.5), (2, 2, 0.5)]}
    assert search(few.limit(0), F.col("id") == 1, 20).count() == 0
    assert search(few, F.col("id") == 7, 20).count() == 0


def test_clustered_vectors_need_few_rows(spark):
    """50,000 vectors around 500 centres: nine in ten neighbours, from under a tenth of the rows."""
    rng = np.random.default_rng(8)
    n, k = 50_000, 20
    centres = rng.normal(size=(500, 24))
    x = centres[rng.integers(500, size=n)] + 0.15 * rng.normal(size=(n, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "vector": x.tolist()}), "id bigint, vector array<double>").repartition(8)
    index = entries(table, k)
    forest, count = fit_forest(index)
    share = fitted_share(index, forest, k)
    assert count == n and 0 < share < 0.1  # of the rows, over all trees: the rows visited are fewer still
    got, hit = lists(search(table, F.col("id") % 500 == 0, k)), 0
    assert len(got) == 100
    for q, own in got.items():
        truth = [j for j in np.argsort(-(x @ x[q]))[:k + 1] if j != q][:k]
        assert len(own) == k
        hit += len({v for _, v, _ in own} & set(truth))
    assert hit / (100 * k) >= 0.9


def test_a_wider_recall_searches_further(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    index = entries(table, 5)
    forest, _ = fit_forest(index)
    shares = [fitted_share(index, forest, 5, recall=r) for r in (0.1, 0.5, 0.9, 1.0)]
    assert shares == sorted(shares) and 0 < shares[0] and shares[-1] <= len(forest.trees)
