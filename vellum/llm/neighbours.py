"""Approximate nearest neighbours by largest inner product: inverted lists and an adaptive dimension scan.

Vectors get one more dimension that makes all lengths equal, so the largest inner product is the smallest distance. There are about sqrt(rows) lists,
MAX_LISTS at most. A bounded sample (about SAMPLE_A_LIST rows a list, picked by a hash of the id) fits the lists' centres, the rotation and how many lists a query probes: as
few as hold RECALL of the true neighbours of sampled queries among the sample. Every vector is indexed, in its nearest list.

Lists that lie side by side form parts, and a part's vectors are dealt into blocks of about BLOCK by a salt, so a list that holds most rows is many blocks;
a part's queries are dealt into chunks of about QUERY_BLOCK. Blocks and chunks meet under the key (part, salt, chunk), so no group is larger than a block and
a chunk, and a query's vector is sent once to each block of a part, not once for each list. In a group a query's probed lists are scanned in turn. The rotated vectors lie in column blocks of STEP dimensions. After each,
a candidate is abandoned by a hypothesis test: the share of a squared distance that lies in the first d of D randomly rotated dimensions is beta distributed, so if the
partial distance exceeds the distance of the query's k-th best by the mean share plus Z standard deviations of it, that the candidate is nearer is improbable. The
k-th best starts as that among SEEDS sampled vectors (those in lists that a query does not probe are results too), and is carried from list to list. Survivors are scored on the original vectors in double precision.

Cases: vectors that are null, zero, or hold null or non-finite components, and those whose length differs from the most
frequent one (ties: the larger), take no part. Fewer candidates than k give all. Repeated ids are separate rows, none of
which is a neighbour of its own id. Ties of score: the smaller id. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import keep, ship

ship(__name__)

#: Rows of the sample for each list, and the most lists: the sample has about 65,536 rows at most.
SAMPLE_A_LIST, MAX_LISTS = 32, 2048
#: Share of the true neighbours that the probed lists hold, measured on TUNING sampled queries.
RECALL, TUNING = 0.93, 256
#: Sampled vectors that give a query's first bound.
SEEDS = 512
BLOCK, QUERY_BLOCK = 4096, 4096
#: Least number of parts.
PARTS = 16
STEP = 16
Z = 3.0
#: Pairs of a query and a candidate that are compared at a time.
PAIRS = 262_144
K = 20


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    inf = F.lit(float("inf"))
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)) & F.exists("v", lambda c: c != 0))
    best = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (best.d if best else 0))


class Index:
    """Centres in the lengthened space, the length they are made equal to, a random rotation, and how many lists to probe."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, longest: float, lists: int, parts: int, k: int = K, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.longest, self.dims = longest, sample.shape[1]
        x = self.lengthen(sample)
        centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
        for _ in range(12):
            near = self._nearest(x, centres)
            order = np.argsort(near, kind="stable")
            own, starts = np.unique(near[order], return_index=True)
            centres[own] = np.add.reduceat(x[order], starts, axis=0) / np.bincount(near)[own, None]
        # lists side by side along the widest direction of the centres
        wide = np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)[2][0]
        self.centres = centres[np.argsort(centres @ wide, kind="stable")]
        self.rotation = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
        near = self._nearest(x, self.centres)
        before = np.cumsum(np.bincount(near, minlength=len(self.centres))) - 1
        self.part = np.minimum(np.maximum(before, 0) * parts // len(x), parts - 1)
        some = rng.choice(len(x), min(SEEDS, len(x)), replace=False)
        self.seeds, self.seed_ids = sample[some], ids[some]
        self.probed = self._tune(sample, ids, near, k, rng.choice(len(x), min(TUNING, len(x)), replace=False))

    def lengthen(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        length = (centres**2).sum(axis=1)
        return np.concatenate([(length - 2 * x[i : i + 4096] @ centres.T).argmin(axis=1) for i in range(0, len(x), 4096)])

    def _tune(self, x: np.ndarray, ids: np.ndarray, near: np.ndarray, k: int, asked: np.ndarray) -> int:
        """The least number of lists that hold RECALL of the true neighbours of the asked rows in the sample."""
        ranks = np.argsort(self.order(x[asked]), axis=1)
        counts = np.zeros(len(self.centres), np.int64)
        for row, i in enumerate(asked):
            scores = np.where(ids == ids[i], -np.inf, x @ x[i])
            best = np.argsort(-scores, kind="stable")[:k]
            np.add.at(counts, ranks[row, near[best[scores[best] > -np.inf]]], 1)
        if not counts.sum():
            return len(self.centres)
        return int(np.searchsorted(np.cumsum(counts), RECALL * counts.sum())) + 1

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return self._nearest(self.lengthen(x), self.centres)

    def order(self, q: np.ndarray) -> np.ndarray:
        """The lists from the nearest to each query on; a query's added dimension is 0."""
        far = (self.centres**2).sum(axis=1) - 2 * q @ self.centres[:, :-1].T
        return np.argsort(far, axis=1, kind="stable")

    def first_bound(self, q: np.ndarray, query_ids: np.ndarray, k: int) -> np.ndarray:
        """The k-th largest score of each query among the seeds of another id; -inf if they are fewer."""
        if len(self.seeds) <= k:
            return np.full(len(q), -np.inf)
        scores = np.where(self.seed_ids[None, :] == query_ids[:, None], -np.inf, q @ self.seeds.T)
        return np.partition(scores, -k, axis=1)[:, -k]

    def shares(self) -> list[tuple[int, float]]:
        """(dimensions seen, greatest share of the bound at which a candidate stays) for each column block."""
        d = self.dims + 1
        out = []
        for seen in [*range(STEP, d, STEP), d]:
            mean, spread = seen / d, math.sqrt(2 * seen * (d - seen) / (d * d * (d + 2)))
            out.append((seen, min(1.0, mean + Z * spread)))
        return out


def scan(index: Index, lists: np.ndarray, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, probes: list[set[int]], k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate place, score) of the best k found of x for each query; lists: the list of each row of x, probes: of each query."""
    rotated = index.lengthen(x) @ index.rotation
    asked = np.concatenate([q, np.zeros((len(q), 1))], axis=1) @ index.rotation
    squares = (q * q).sum(axis=1) + index.longest**2
    steps = index.shares()
    kth = index.first_bound(q, query_ids, k)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))  # the best k so far of every query
    for own in np.unique(lists).tolist():
        places = np.flatnonzero(lists == own)
        queries = np.array([i for i, p in enumerate(probes) if own in p], np.int64)
        width = max(1, PAIRS // len(places))
        for low in range(0, len(queries), width):
            some = queries[low : low + width]
            bound = (squares[some] - 2 * kth[some]) * (1 + 1e-9) + 1e-12  # the k-th best as a squared distance
            first = steps[0][0]
            a, b = asked[some, :first], rotated[places, :first]
            partial = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
            i, j = np.nonzero((partial <= bound[:, None] * steps[0][1] + 1e-9) & (ids[places][None, :] != query_ids[some][:, None]))
            far = partial[i, j]
            for (before, _), (seen, share) in zip(steps, steps[1:], strict=False):
                far = far + ((asked[some[i], before:seen] - rotated[places[j], before:seen]) ** 2).sum(axis=1)
                stay = far <= bound[i] * share + 1e-9
                i, j, far = i[stay], j[stay], far[stay]
            scores = np.einsum("ij,ij->i", x[places[j]], q[some[i]])
            found.append((some[i], places[j], scores))
        held = best_of([held, *found], ids, k)
        found = []
        counts = np.bincount(held[0], minlength=len(q))
        full = np.flatnonzero(counts >= k)
        kth[full] = np.maximum(kth[full], held[2][np.cumsum(counts)[full] - 1])
    return held


def best_of(parts, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest scores of every query, in order of query, score and id."""
    i, j, s = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    starts = np.searchsorted(i, i)
    keep_ = np.arange(len(i)) - starts < k
    return i[keep_], j[keep_], s[keep_]


def _matrix(values, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dims)


def _listed(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                lists = index.list_of(x)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(lists.astype(np.int32)), pa.array(index.part[lists].astype(np.int32))], names=["vec_id", "v", "list", "part"])

    return run


def _probing(index: Index):
    """A row for each part that a query probes, with the lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
            ids = b.column(0).to_numpy()
            rows = [(ids[i], x[i].tobytes(), p, sorted(near[index.part[near] == p].tolist())) for i, near in enumerate(index.order(x)[:, : index.probed]) for p in np.unique(index.part[near]).tolist()]
            columns = zip(*rows, strict=True)
            types = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["query_id", "q", "part", "lists"])

    return run


def _seeded(index: Index, k: int):
    """(query_id, vec_id, score) of the best seeds in lists that a query does not probe: they gave its first bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            q, ids = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1), b.column(0).to_numpy()
            probed = np.zeros((len(q), len(index.centres)), bool)
            np.put_along_axis(probed, index.order(q)[:, : index.probed], True, axis=1)
            i, j = np.nonzero(~probed[:, index.list_of(index.seeds)] & (index.seed_ids[None, :] != ids[:, None]))
            i, j, s = best_of([(i, j, np.einsum("ij,ij->i", q[i], index.seeds[j]))], index.seed_ids, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(index.seed_ids[j]), pa.array(s)], names=["query_id", "vec_id", "score"])

    return run


def _scanned(index: Index, k: int):
    def run(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        ids, query_ids = held["vec_id"].to_numpy(np.int64), asked["query_id"].to_numpy(np.int64)
        x, q = _matrix(held["v"], index.dims), _matrix(asked["q"], index.dims)
        i, j, s = scan(index, held["list"].to_numpy(), ids, x, query_ids, q, [set(p) for p in asked["lists"]], k)
        return pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[j], "score": s})

    return run


def fit(rows: DataFrame, k: int = K) -> Index | None:
    """The index of valid vectors, from a sample of about SAMPLE_A_LIST rows a list; None of no rows."""
    n = rows.count()
    lists = max(1, min(MAX_LISTS, round(math.sqrt(n))))
    share = min(1.0, SAMPLE_A_LIST * lists / max(n, 1))
    picked = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1_000_000)) < math.ceil(1_000_000 * share))
    sample = picked.limit(2 * SAMPLE_A_LIST * lists).collect()  # the limit only bounds the driver where one row repeats
    if not sample:  # so by chance only where rows are few or equal
        sample = rows.limit(1).collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r.vec_id, r.v))
    longest = rows.agg(F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda t, c: t + c * c)))).first()[0]
    parts = min(lists, max(PARTS, -(-n // BLOCK)))
    return Index(np.array([r.v for r in sample], np.float64), np.array([r.vec_id for r in sample], np.int64), longest, lists, parts, k)


def nearest(vectors: DataFrame, queries, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each query; queries: a condition on vec_id."""
    rows = keep(valid_vectors(vectors))
    index = fit(rows, k)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    held = keep(rows.mapInArrow(_listed(index), "vec_id long, v binary, list int, part int"))
    asked = keep(rows.where(queries).mapInArrow(_probing(index), "query_id long, q binary, part int, lists array<int>"))
    blocks = lambda df, size, name: df.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    sizes = F.broadcast(keep(blocks(held, BLOCK, "salts").join(blocks(asked, QUERY_BLOCK, "chunks"), "part"), len(index.centres)))  # as many rows as parts
    apart = F.monotonically_increasing_id()  # of a written table, so that rows which repeat are dealt apart, and alike if a task runs again
    held = held.withColumn("n", apart).join(sizes, "part").select("part", F.pmod(F.xxhash64("vec_id", "n"), F.col("salts")).alias("salt"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "vec_id", "v", "list")
    asked = asked.withColumn("n", apart).join(sizes, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.pmod(F.xxhash64("query_id", "n"), F.col("chunks")).alias("chunk"), "query_id", "q", "lists")
    key = [F.col("part").cast("long"), F.col("salt").cast("long"), F.col("chunk").cast("long")]
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_scanned(index, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = keep(found.unionByName(rows.where(queries).mapInArrow(_seeded(index, k), "query_id long, vec_id long, score double")))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
