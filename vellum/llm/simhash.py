"""SimHash fingerprints and their linking by BK-trees over pigeonhole shards.

Two 64-bit fingerprints within 3 bits agree on one of four 16-bit blocks, and within the other 48 bits
on one of four 12-bit blocks. So 16 shards a fingerprint, each keyed by 28 agreed bits, hold every pair
within the radius. A shard is a BK-tree whose children are keyed by their integer Hamming distance to
the parent; a search follows only edges within the radius. Trees grow with the corpus, so they are not
broadcast: each lives in the task that its shard was dealt to. A shard beyond SHARD_MEMBERS is not held: its
rows stream out again under four keys each, by the same rule on the bits that they need not agree on, up to three
times. A shard returns the edges of a spanning forest of its links, never all pairs of a group.

Cases: a null or blank text has the fingerprint zero and links like any other. Texts of fewer words
than a shingle hash as one shingle. Equal fingerprints are one node. Repeated rows each give a row.
An empty table gives an empty result. Only doc_id and text are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import component_names, components, keep, ship

ship(__name__)

RADIUS = 3
SHINGLE = 3
#: Distinct fingerprints of a shard beyond which it is split.
SHARD_MEMBERS = 16_384
#: Most bits that each split of a shard agrees on; after the last, 16 bits or fewer are free, so 65,536 members are the most.
SPLIT_WIDTHS = (9, 7, 6)
#: Row v: the bits of byte v, most significant first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is set in over half of the shingle hashes."""
    from itertools import repeat

    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        parts = [line[a:b] for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(42))), np.uint8).reshape(-1, 8)
    if len(parts) < 256:
        ones = np.unpackbits(digests, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(digests[:, k], minlength=256) @ BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(parts)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number. No shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def distances(values: np.ndarray, value) -> np.ndarray:
    """Hamming distances; a fingerprint is a number, or a row of several."""
    far = np.bitwise_count(values ^ value)
    return far.astype(np.int64) if far.ndim == 1 else far.sum(axis=1, dtype=np.int64)


class BKTree:
    """A BK-tree over distinct fingerprints (numbers or rows), built and searched for many of them at a time."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: dict[int, list[tuple[int, int]]] = {}
        todo = [np.arange(len(values))]
        while todo:
            members = todo.pop()
            node, rest = members[0], members[1:]
            if not len(rest):
                continue
            far = distances(values[rest], values[node])
            order = np.argsort(far, kind="stable")
            far, rest = far[order], rest[order]
            cuts = np.flatnonzero(np.diff(far)) + 1
            groups = np.split(rest, cuts)
            self.children[int(node)] = [(int(far[i]), int(g[0])) for i, g in zip([0, *cuts.tolist()], groups, strict=True)]
            todo.extend(groups)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, positions in queries within the radius of it) for every node that is reached."""
        def reached(node: int, asked: np.ndarray):
            far = distances(queries[asked], self.values[node])
            return node, asked[far <= radius], (asked, far, iter(self.children.get(node, ())))

        # one frame for each level of the path, so memory grows with the depth, not with the children
        frames = []
        if len(self.values):
            node, hit, frame = reached(0, np.arange(len(queries)))
            frames.append(frame)
            if len(hit):
                yield node, hit
        while frames:
            asked, far, edges = frames[-1]
            for edge, child in edges:
                if len(below := asked[np.abs(far - edge) <= radius]):
                    node, hit, frame = reached(child, below)
                    frames.append(frame)
                    if len(hit):
                        yield node, hit
                    break
            else:
                frames.pop()


def forest(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges (position, smallest position of its group) of the groups that links within the radius form."""
    if len(values) == 2:
        if int(values[0] ^ values[1]).bit_count() <= radius:
            yield 1, 0
        return
    label = np.arange(len(values))
    for _, hit in BKTree(values).search(values, radius):
        groups = np.unique(label[hit])
        if len(groups) > 1:
            label[np.isin(label, groups)] = groups[0]
    for i in np.flatnonzero(label != np.arange(len(values))).tolist():
        yield i, int(label[i])


def free_bits(key: int, level: int) -> list[np.ndarray]:
    """The four blocks of bit places that the members of a shard need not agree on; level: how often its parents were split."""
    choices = []  # the block that each split agreed on
    for width in reversed(SPLIT_WIDTHS[:level]):
        choices.append(key >> width & 3)
        key >>= width + 2
    i, j = key >> 30 & 3, key >> 28 & 3
    others = [b for b in range(4) if b != i]
    rest = np.array([16 * others[2 - r // 16] + r % 16 for r in range(48) if r // 12 != j])
    for choice in reversed(choices):
        rest = np.concatenate([part for k, part in enumerate(np.array_split(rest, 4)) if k != choice])
    return np.array_split(rest, 4)


def split_shard(key: int, level: int, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, values) of a shard's four splits: members within 3 bits of each other meet in at least one of them."""
    for choice, places in enumerate(free_bits(key, level)):
        part = np.zeros(len(values), np.int64)
        for k, place in enumerate(places.tolist()):
            part |= (values >> np.uint64(place) & np.uint64(1)).astype(np.int64) << k
        yield ((key << 2 | choice) << SPLIT_WIDTHS[level]) | part, values


def _shard_links(radius: int, level: int, members: int):
    """Rows (sub, u, v): links with no sub, and of a shard beyond `members` its rows' splits (sub, u) instead."""
    whole = level < len(SPLIT_WIDTHS)  # whether a shard may be split further

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, size, splits = None, [], 0, False
        links: tuple[list, list] = ([], [])
        dealt: list[tuple[np.ndarray, np.ndarray]] = []

        def finish() -> None:
            nonlocal parts, size
            if splits:
                dealt.extend(split_shard(int(key), level, np.concatenate(parts)) if parts else ())
            elif size > 1:
                values = np.concatenate(parts)
                for i, j in forest(values, radius):
                    links[0].append(values[i])
                    links[1].append(values[j])
            parts, size = [], 0

        def flush(full: bool) -> Iterator[pa.RecordBatch]:
            if links[0] and (full or len(links[0]) > 50_000):
                u, v = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in links)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(u), pa.int64()), u, v], names=["sub", "u", "v"])
                links[0].clear()
                links[1].clear()
            for subs, values in dealt:
                yield pa.RecordBatch.from_arrays([pa.array(subs), pa.array(values.view(np.int64)), pa.nulls(len(subs), pa.int64())], names=["sub", "u", "v"])
            dealt.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            starts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
            sizes = np.diff(starts)
            seen = sizes > 1
            seen[[0, -1]] = True  # these may go on in the batches beside this one
            for k in np.flatnonzero(seen).tolist():
                if keys[starts[k]] != key:
                    finish()
                    key, splits = keys[starts[k]], False
                parts.append(values[starts[k] : starts[k + 1]])
                size += int(sizes[k])
                if whole and (splits or size > members):
                    splits = True
                    finish()
            yield from flush(False)
        finish()
        yield from flush(True)

    return run


def _bits(low: int, width: int):
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))


def shards(nodes: DataFrame) -> DataFrame:
    """(key, fp): the 16 shards of each fingerprint."""
    keys = []
    for i in range(4):
        rest = F.lit(0).cast("long")  # the other 48 bits, in order
        for b in (b for b in range(4) if b != i):
            rest = F.shiftleft(rest, 16).bitwiseOR(_bits(16 * b, 16))
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(4095))
            keys.append(F.lit((i * 4 + j) << 28).cast("long").bitwiseOR(F.shiftleft(_bits(16 * i, 16), 12)).bitwiseOR(part))
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def near_links(nodes: DataFrame, radius: int = RADIUS, members: int = SHARD_MEMBERS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that keep exactly the groups of links within the radius (3 at most).

    A task holds at most `members` fingerprints and a batch of one shard; what is larger is dealt out again, by more agreed bits."""
    if not 0 <= radius <= 3:
        raise ValueError("the shards hold pairs of up to 3 differing bits")
    dealt, found = shards(nodes), []
    for level in range(len(SPLIT_WIDTHS) + 1):
        rows = keep(dealt.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_shard_links(radius, level, members), "sub long, u long, v long"))
        found.append(rows.where("sub is null").select("u", "v"))
        dealt = rows.where("sub is not null").select(F.col("sub").alias("key"), F.col("u").alias("fp"))
        if not dealt.take(1):
            break
    return reduce(DataFrame.unionByName, found).distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs; component_id is the smallest doc_id of its group.

    Null doc_ids stay null and never name a group that has another id."""
    marked = keep(fingerprints(docs, shingle))
    n_rows = marked.count()
    nodes = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), n_rows)
    stars = components(near_links(nodes.select("fp"), radius), n_rows)
    classes = keep(component_names(nodes.withColumnRenamed("fp", "node"), stars, n_rows), n_rows).withColumnRenamed("node", "fp")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
