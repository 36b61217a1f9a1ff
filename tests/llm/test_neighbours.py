import numpy as np
from pyspark.sql import functions as F

from vellum.llm import neighbours as N


def recall(spark, d):
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in N.op2_neighbours(spark, d).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:20]
        mine = sorted(got[ids[i]])
        assert [m[0] for m in mine] == list(range(1, 21)) and [m[1:] for m in mine] == sorted([m[1:] for m in mine], key=lambda m: (-m[1], m[0]))
        assert all(abs(s - float(x[np.flatnonzero(ids == v)[0]] @ x[i])) < 1e-12 for _, v, s in mine)
        hits += len({ids[j] for j in order} & {m[1] for m in mine})
        total += 20
    return hits / total


def test_recall_against_brute_force(spark):
    for d in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        got = recall(spark, d)
        rows = N.keep(N.valid_vectors(spark.read.parquet(f"{d}/embeddings.parquet")))
        index = N.fit(rows)
        print("recall", d, got, "probed", index.probed, "of", len(index.centres))
        assert got >= 0.9 and index.probed < 0.8 * len(index.centres)


def clusters(n, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(40, 32))
    x = centres[r.integers(0, 40, n)] + 0.3 * r.normal(size=(n, 32))
    x[: n // 3] = x[0]  # one vector of a third of all rows
    return r.permutation(n), x


def test_clustered_vectors_with_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 300)
    monkeypatch.setattr(N, "QUERY_BLOCK", 40)
    monkeypatch.setattr(N, "PAIRS", 5000)
    ids, x = clusters(4000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in N.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    hits = 0
    asked = [k for k in range(4000) if ids[k] % 20 == 0]
    for k in asked:
        scores = x @ x[k]
        order = [ids[j] for j in np.lexsort((ids, -np.round(scores, 9))) if ids[j] != ids[k]][:20]
        mine = [v for _, v in sorted(got[ids[k]])]
        assert len(mine) == len(set(mine)) == 20
        hits += len(set(order) & set(mine))
    index = N.fit(N.keep(N.valid_vectors(df)))
    print(hits / 20 / len(asked), index.probed, len(index.centres))
    assert hits >= 0.95 * 20 * len(asked) and index.probed <= len(index.centres) / 3


def test_scan_abandons_and_keeps(monkeypatch):
    """The tests by column blocks keep nearly all of the best, and leave few candidates to be scored."""
    r = np.random.default_rng(8)
    x = r.normal(size=(3000, 128))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:300] = x[0] + 0.05 * r.normal(size=(300, 128))
    ids = np.arange(3000)
    index = N.Index(x[::10], ids[::10], float(np.linalg.norm(x, axis=1).max()), 1, 1)
    i, j, s = N.scan(index, np.zeros(3000, int), ids, x, ids[:50], x[:50], [{0}] * 50, 20)
    right = 0
    for q in range(50):
        scores = x @ x[q]
        scores[q] = -9
        right += len(set(np.argsort(-scores)[:20]) & set(j[i == q]))
    assert right >= 0.99 * 50 * 20
    assert N.Index.shares(index)[0][1] < 0.5 and N.Index.shares(index)[-1] == (129, 1.0)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, None, 1), (6, [1.0, None], 1), (7, [1.0], 1), (20, [0.0, -3.0], 1), (9, [2.0, 0.0], 1), (9, [2.0, 0.0], 1), (None, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int")
    got = sorted(tuple(r) for r in N.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 9, 2.0), (0, 3, 9, 2.0), (0, 4, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 9, 0.0), (20, 4, 9, 0.0)]
    assert N.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
