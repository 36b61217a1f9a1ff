"""SimHash near-dedup at similarity 0.8 of five-word shingles: wide fingerprints, BK-trees in shards.

A text is the set of its distinct shingles of SHINGLE words. Its fingerprint has BITS bits, each the majority of one bit of all
shingle hashes, so the share of bits on which two fingerprints agree estimates the cosine of the sets: 1 - arccos(cosine) / pi. Two
texts link if that share is SIMILARITY or more. At 0.8 that is a cosine of 0.81, or a Jaccard similarity of 0.68 for sets of one size;
sets with a Jaccard similarity of 0.8 agree on 0.85 of the bits, three standard deviations above the bound, so practically all of those link too.

64-bit fingerprints cannot give this: similarity 0.8 is 10 of 64 bits, a radius within which unrelated texts stand and for which no
pigeonhole shards are selective. So shards are keyed by content: each text is in BANDS shards, each named by the
least hashes of its shingles under ROWS mixing functions. Texts with a Jaccard similarity of 0.68 share a shard with probability 0.9995,
with 0.8 in all but one of ten million cases. A shard is a BK-tree whose children are keyed by their
integer Hamming distance to the parent; a search follows only edges within the radius. Shards grow with the corpus, so their trees are not broadcast, each
lives in the task that its shard was dealt to. The member nearest to the majority of a shard's bits is compared first: what links to it is one
group, and only the others are made a tree and searched, by all members. A shard of more than SHARD_MEMBERS distinct fingerprints is
dealt in pairs of blocks, which compare every pair at a bounded size of a task. Only a spanning forest of each shard's links leaves the task.

Words are runs of ASCII digits, letters (A-Z count as a-z) and characters above U+007F; a text without any takes its white-space-free runs.

Cases: a null or blank text has no shingle and links to any other such. Texts of fewer words than a shingle are one shingle. Equal
fingerprints are one node. Repeated rows stay or go together. Ties: the smallest doc_id of a group names it. Very long texts are
read whole, their hashes in blocks. An empty table gives an empty result. Only doc_id and text are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import component_names, components, keep, maybe_broadcast, ship
from vellum.llm.simhash import BKTree, distances

ship(__name__)

SHINGLE = 5
SIMILARITY = 0.8
BITS = 512
BANDS, ROWS = 20, 3
SHARD_MEMBERS = 16_384
#: Shingle hashes that are mixed at a time.
BLOCK = 4_096
_CLASS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_ODD = np.random.default_rng(20).integers(0, 1 << 63, (2, BITS // 64 + BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MARKED = "doc_id long, node long, fp binary, bands array<long>"


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    import xxhash

    raw = (text or "").encode("utf-8", "replace")
    words = raw.translate(_CLASS).split() or raw.split()
    line = b" ".join(words)
    if len(words) <= width:
        parts = [line] if words else []
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        parts = [line[a:b] for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64, len(parts)))


def _mixed(hashes: np.ndarray, which: slice) -> np.ndarray:
    """One row of hashes for each mixing function."""
    x = (hashes[None, :] ^ _ODD[0, which, None]) * _ODD[1, which, None]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """BITS bits, as uint64; a bit is set if it is set in over half of the hashes."""
    words = BITS // 64
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), BLOCK):
        rows = np.ascontiguousarray(_mixed(hashes[k : k + BLOCK], slice(0, words)).T)
        ones += np.unpackbits(rows.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).view(np.uint64)


def bands(hashes: np.ndarray) -> np.ndarray:
    """The shards' keys, as int64; none without hashes."""
    import xxhash

    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), BLOCK):
        np.minimum(least, _mixed(hashes[k : k + BLOCK], slice(BITS // 64, None)).min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), b) for b, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def _marks(width: int):
    """Rows of _MARKED; a task gives the fingerprint and the bands of a node once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen: set[int] = set()
        for batch in batches:
            nodes, fps, keys = [], [], []
            for text in batch.column(1):
                hashes = shingles(text.as_py(), width)
                fp = wide_fingerprint(hashes).tobytes()
                node = int(np.uint64(xxhash.xxh64_intdigest(fp, len(hashes) > 0)).view(np.int64))
                nodes.append(node)
                fps.append(None if node in seen else fp)
                keys.append(None if node in seen else bands(hashes))
                seen.add(node)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(fps, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "node", "fp", "bands"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys (column 0) with two rows or more, several whole runs at a time."""
    held: list[pa.Table] = []  # the last run so far
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        if held and held[-1].column(0)[0].as_py() != keys[0]:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        rows = pa.Table.from_batches([batch])
        if not len(cuts):
            held.append(rows)
            continue
        yield pa.concat_tables([*held, rows.slice(0, cuts[0])]).combine_chunks()
        if cuts[-1] > cuts[0]:
            yield rows.slice(cuts[0], cuts[-1] - cuts[0]).combine_chunks()
        held = [rows.slice(cuts[-1])]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (shard, node) rows of shards with two nodes or more, each once; sorted by shard and node."""
    for rows in _runs(batches):
        shard, node = (rows.column(c).to_numpy() for c in (0, 1))
        once = np.concatenate(([True], (shard[1:] != shard[:-1]) | (node[1:] != node[:-1])))
        shard, node = shard[once], node[once]
        same = shard[1:] == shard[:-1]
        many = np.concatenate((same, [False])) | np.concatenate(([False], same))
        yield pa.RecordBatch.from_arrays([pa.array(shard[many]), pa.array(node[many])], names=["shard", "node"])


def wide_forest(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges (place, smallest place of its group) of the groups that links within the radius form; values: a row for each fingerprint."""
    ones = np.zeros(values.shape[1] * 64, np.int64)
    for k in range(0, len(values), BLOCK):
        ones += np.unpackbits(np.ascontiguousarray(values[k : k + BLOCK]).view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    middle = np.packbits(2 * ones > len(values)).view(np.uint64)
    pivot = int(distances(values, middle).argmin())
    near = distances(values, values[pivot]) <= radius
    label = np.arange(len(values))
    label[near] = np.flatnonzero(near)[0]
    rest = np.flatnonzero(~near)
    for node, hit in BKTree(values[rest]).search(values, radius) if len(rest) else ():
        groups = np.unique(label[np.append(hit, rest[node])])
        if len(groups) > 1:
            label[np.isin(label, groups)] = groups[0]
    for i in np.flatnonzero(label != np.arange(len(values))).tolist():
        yield i, int(label[i])


def _tree_links(radius: int):
    """Edges (u, v) of nodes; rows: shard, node, fp, sorted by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            shard, node = (rows.column(c).to_numpy() for c in (0, 1))
            values = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint64).reshape(len(node), -1)
            starts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
            first = np.repeat(starts[:-1], np.diff(starts))
            linked = distances(values, values[first]) <= radius
            u, v = [node[linked & (first != np.arange(len(node)))]], [node[first[linked & (first != np.arange(len(node)))]]]
            # shards whose members do not all link to the first
            for k in np.unique(np.searchsorted(starts, np.flatnonzero(~linked), "right") - 1).tolist():
                low, high = int(starts[k]), int(starts[k + 1])
                if high - low > 2 and (found := list(wide_forest(values[low:high], radius))):
                    i, j = np.array(found).T
                    u.append(node[low + i])
                    v.append(node[low + j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    return run


def shard_links(met: DataFrame, fps: DataFrame, radius: int, members: int = SHARD_MEMBERS) -> DataFrame:
    """Edges (u, v) that keep the groups of links between nodes of a shard; met: shard, node; fps: node, fp, a row a node."""
    full = keep(met.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > members), 1)
    if n_full := full.count():
        blocks = F.ceil(F.col("n") / members).cast("long")
        both = met.join(maybe_broadcast(full, n_full, 16), "shard", "left").withColumn("b", F.coalesce(blocks, F.lit(1)))
        mine = F.pmod(F.xxhash64("node"), F.col("b"))
        both = both.select("shard", "node", "b", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("j"))
        met = both.select(F.when(F.col("b") == 1, F.col("shard")).otherwise(F.xxhash64("shard", F.least("i", "j"), F.greatest("i", "j"))).alias("shard"), "node")
    rows = met.join(fps, "node").select("shard", "node", "fp")
    return rows.repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(_tree_links(radius), "u long, v long")


def similar_components(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY, members: int = SHARD_MEMBERS) -> DataFrame:
    """(doc_id, node, component_id) for every row of docs; component_id is the smallest doc_id of its group.

    Null doc_ids stay null and never name a group that has another id."""
    radius = int(BITS * (1 - similarity) + 1e-9)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = keep(rows.mapInArrow(_marks(width), _MARKED))
    dealt = marked.where("bands is not null").select(F.explode("bands").alias("shard"), "node")
    n = BANDS * marked.where("bands is not null").count()
    met = keep(dealt.repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(_met, "shard long, node long"), n)
    wanted = met.select("node").distinct()
    fps = keep(marked.where("fp is not null").select("node", "fp").join(wanted, "node", "left_semi").dropDuplicates(["node"]), n // BANDS)
    stars = components(shard_links(met, fps, radius, members), met.count())
    n_rows = marked.count()
    nodes = keep(marked.groupBy("node").agg(F.min("doc_id").alias("first_id")), n_rows)
    classes = keep(component_names(nodes, stars, n_rows), n_rows)
    return marked.select("doc_id", "node").join(classes, "node").select("doc_id", "node", "component_id")


def one_of_each_group(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its group of similar texts. Rows that repeat a doc_id stay or go together: they
    go if any of them has a group with a smaller doc_id. Rows without a doc_id stay."""
    dropped = similar_components(docs, width, similarity).where("doc_id != component_id").select("doc_id").distinct()
    dropped = keep(dropped, docs.count())
    return docs.join(maybe_broadcast(dropped, dropped.count(), 16), "doc_id", "left_anti")
