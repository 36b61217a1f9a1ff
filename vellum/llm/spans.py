"""Spans of regular expressions as column expressions: places are code points, ends are exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<start:int,end:int,value:string>>"


def find(text: Column, pattern: str, likely: Column) -> Column:
    """Leftmost non-overlapping matches of pattern, where the cheap test `likely` holds; else none.

    The text splits into the pieces between matches; running lengths of pieces and matches give the places."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda p, h: F.struct(p.alias("p"), h.alias("h")))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["p"])
        end = start + F.length(x["h"])
        one = F.struct(start.alias("start"), end.alias("end"), x["h"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    none = F.array().cast(FOUND)
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda done: done["out"])
    return F.when(likely & F.regexp_like(text, F.lit(pattern)), spans).otherwise(none)


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (span["start"] < o["end"]) & (o["start"] < span["end"]))


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """Spans with their kind and its rank in the listing order."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column, by_kind: bool) -> Column:
    """kind:start:end, comma-joined, by kind then start or by start then kind."""
    keys = ("rank", "start", "end", "kind") if by_kind else ("start", "rank", "end", "kind")
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[k].alias(k) for k in keys])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, fill: str | None = None) -> Column:
    """text with every span (start, end, kind) replaced by its kind in angle brackets, or each of its characters by fill; of overlapping spans the first counts, the rest of
    a later one goes with it."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(done: Column, s: Column) -> Column:
        before = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mark = F.repeat(F.lit(fill), F.greatest(s["end"] - F.greatest(s["start"], done["at"]), F.lit(0))) if fill else F.when(s["start"] >= done["at"], F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], F.array(F.concat(before, mark))).alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step)
    return F.when(F.size(spans) > 0, F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)
