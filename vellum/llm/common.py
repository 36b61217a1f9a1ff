"""Shared helpers: shared-folder checkpoints, shipping of functions, graph components."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.session import ROWS_PER_FILE, keep, shared_folder  # noqa: F401 - for the operators

#: Most bytes of a table that is broadcast; beyond it the plain shuffled join is used.
BROADCAST_BYTES = 32 << 20


def ship(module_name: str) -> None:
    """Pickle this module's functions by value, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def empty_safe(text):
    """Null texts are treated as empty."""
    return F.coalesce(text, F.lit(""))


def maybe_broadcast(df: DataFrame, n_rows: int, row_bytes: int) -> DataFrame:
    """Broadcast hint if the counted size is within BROADCAST_BYTES."""
    return F.broadcast(df) if n_rows * row_bytes <= BROADCAST_BYTES else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores appended until no column of df has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame, rows: int | None = None, max_rounds: int = 60) -> DataFrame:
    """Connected components of (u, v) long edges as stars (u, v): v is the smallest id reachable from u.

    Alternating large-star and small-star rounds, each written to the shared folder. Every step is a
    join or a map-side-combined minimum; nothing is collected but three counts a round. Nodes that are
    the smallest of their component appear only as v. Self-edges and repeats are ignored. rows: a bound of the edges, if known.
    """
    e = keep(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows)
    for _ in range(max_rounds):
        n, distinct_u = e.agg(F.count("*"), F.count_distinct("u")).first()
        if n == distinct_u and not e.join(e.select(F.col("u").alias("v")), "v", "left_semi").take(1):
            return e
        # the least neighbours are written before they are joined, so that the joins are plain ones, whose hot hubs adaptive execution splits
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keep(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), 2 * n)
        large = keep(both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), 2 * n)
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), 2 * n)
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), 2 * n)
    raise RuntimeError("components did not settle")


def component_names(nodes: DataFrame, stars: DataFrame, n_nodes: int) -> DataFrame:
    """(node, component_id) of nodes (node, first_id): the smallest first_id of the node's star, stars as components() gives them.

    The names of the roots are written before they are joined, so that the join is a plain one, whose hot roots adaptive execution splits."""
    rooted = keep(nodes.join(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node")), n_nodes)
    named = keep(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), n_nodes)
    return rooted.select("node", "root").join(named, "root").select("node", "component_id")


def crc32_fold(doc_id, folds: int = 3):
    """crc32 of the id's decimal text modulo folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
