"""Benchmark decontamination by a distributed positional inverted index.

Test items are cut into windows of ten consecutive words (an item of fewer is one window). A first pass counts in how many
texts each test term stands and so picks each window's RARE rarest terms. A second pass builds the index, partitioned by document: every text's postings
of those terms, each (hash of the term, place), beside its number of words; it is written once, no text is shuffled. A posting of a window's rarest
term, minus the term's offset in the window, is a candidate start; it stays if the lists of the window's other rare terms, each minus its own offset, hold the same start. Only the texts of
what the intersection leaves are read again, and there the window's other words are compared. With slop, a window also matches in proximity: every other rare term has an adjusted
start within slop words of the rarest term's. Only DataFrame functions are used.

Up to LITERAL_TERMS rare terms the index is built inside each row; beyond, terms are joined (broadcast in blocks of a bounded size) and postings
are grouped by text. Documents get their items by the distinct sets of windows that they hold, so items that share a window are listed
once for each such set.

Words are runs of ASCII digits, letters and all characters above U+007F; A-Z compare without case. Index terms are lower-cased beyond ASCII
too, which only adds candidates.

Cases: null and empty texts have no words. Items without words have no window. Repeated items and equal
windows of several items all count for each item. Ties: of equally rare terms the first in the window counts as rarer. Rows are told apart by doc_id and a hash of the text; rows
that repeat both give equal results. Very long texts are read whole; their postings are one array. Empty tables give no hits. Other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import BROADCAST_BYTES, empty_safe, free_names, keep, maybe_broadcast

WINDOW = 10
#: Rare terms of a window whose lists are intersected.
RARE = 3
#: Most rare terms that are put into the plan as a set.
LITERAL_TERMS = 8_192
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies between words, once lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Estimated bytes of a term, and of a window with its words; longer words are counted by their length.
TERM_BYTES, WINDOW_BYTES = 64, 512


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(empty_safe(text)), BETWEEN), "")


def terms_of(text: Column) -> Column:
    """The index terms of a text; the first and the last may be empty and are no words."""
    return F.split(F.lower(empty_safe(text)), BETWEEN)


def windows_of(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(window_id, window) of the distinct windows, and (item_id, window_id)."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text").cast("string")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = words.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at"), F.lit(size)).alias("window")).distinct()
    n = words.agg(F.sum(F.greatest(F.size("w") - size + 1, F.lit(1)))).first()[0] or 0
    cut = keep(cut, n)
    windows = keep(cut.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()), n)
    return windows, cut.join(windows, "window").select("item_id", "window_id").distinct()


def _bytes(column: Column, least: int) -> Column:
    return F.sum(F.greatest(F.octet_length(column) + 32, F.lit(least))).alias("bytes")


def _blocks(rows: DataFrame, by: str, n_bytes: int) -> list[DataFrame]:
    """rows in blocks that may each be broadcast."""
    n = max(1, -(-n_bytes // BROADCAST_BYTES))
    return [F.broadcast(rows if n == 1 else rows.where(F.pmod(F.xxhash64(by), F.lit(n)) == k)) for k in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def term_counts(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """(term, n): in how many texts each term stands; terms: distinct column term, of n_terms rows at most."""
    terms = keep(terms, n_terms)
    size = terms.agg(_bytes(F.col("term"), TERM_BYTES)).first()[0] or 0
    # outer, since before an inner explode the optimizer tests the array's size, and makes the array once more for it
    tokens = docs.select(F.explode_outer(F.array_distinct(terms_of(F.col("text").cast("string")))).alias("term")).where("term != ''")
    return _union([tokens.join(block, "term").groupBy("term").agg(F.count("*").alias("n")) for block in _blocks(terms, "term", size)])


def rare_terms(windows: DataFrame, docs: DataFrame, rare: int = RARE) -> DataFrame:
    """(window_id, window, rare): the rarest terms of each window, rarest first, as structs of n, offset, term and its hash."""
    places = windows.select("window_id", F.posexplode("window").alias("offset", "w")).select("window_id", "offset", F.lower("w").alias("term"))
    n_terms = WINDOW * windows.count()
    counts = keep(term_counts(docs, places.select("term").distinct(), n_terms), n_terms)
    size = counts.agg(_bytes(F.col("term"), TERM_BYTES)).first()[0] or 0
    counts = maybe_broadcast(counts, size, 1)
    one = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("offset"), F.col("term"), F.hash("term").alias("hash"))
    # a group is one window: ten terms
    ranked = places.join(counts, "term", "left").groupBy("window_id").agg(F.slice(F.sort_array(F.collect_list(one)), 1, rare).alias("rare"))
    return windows.join(ranked, "window_id")


def posting(hashed: Column, place: Column) -> Column:
    """A term's hash and a place as one number."""
    return F.shiftleft(hashed.cast("long"), 32).bitwiseOR(place.cast("long"))


def index(docs: DataFrame, anchors: DataFrame, literal_terms: int = LITERAL_TERMS) -> DataFrame:
    """(doc_id, text_hash, n_words, postings, firsts) of every row of docs: the postings of all rare terms and those of rarest terms."""
    each = anchors.select(F.posexplode("rare").alias("k", "r")).groupBy("r.term", "r.hash").agg(F.min("k").alias("k"))
    each = keep(each.select("term", "hash", (F.col("k") == 0).alias("first")), RARE * anchors.count())
    n, size = each.agg(F.count("*"), _bytes(F.col("term"), TERM_BYTES)).first()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(empty_safe(text)).alias("text_hash"), terms_of(text).alias("w"))
    lead = F.when(F.get("w", F.lit(0)) == "", F.lit(1)).otherwise(F.lit(0))
    tail = F.when((F.size("w") > 1) & (F.element_at("w", -1) == ""), F.lit(1)).otherwise(F.lit(0))
    rows = rows.select("doc_id", "text_hash", "w", lead.alias("lead"), (F.size("w") - lead - tail).cast("long").alias("n_words"))
    if n <= literal_terms:
        terms = each.collect()
        if not terms:
            none = F.array().cast("array<long>")
            return rows.select("doc_id", "text_hash", "n_words", none.alias("postings"), none.alias("firsts"))
        found = F.transform("w", lambda t, i: F.when(t.isin([r.term for r in terms]), posting(F.hash(t), i - F.col("lead"))))
        rows = rows.select("doc_id", "text_hash", "n_words", F.filter(found, lambda p: p.isNotNull()).alias("postings"))
        firsts = F.filter("postings", lambda p: F.shiftright(p, 32).isin([r.hash for r in terms if r.first]))
        return rows.select("doc_id", "text_hash", "n_words", "postings", firsts.alias("firsts"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    tokens = rows.select("row", F.posexplode_outer("w").alias("i", "term"), "lead").select("row", (F.col("i") - F.col("lead")).alias("place"), "term")
    hits = _union([tokens.join(block, "term").select("row", posting(F.col("hash"), F.col("place")).alias("p"), "first") for block in _blocks(each, "term", size)])
    # a group is one text
    lists = hits.groupBy("row").agg(F.collect_list("p").alias("postings"), F.collect_list(F.when(F.col("first"), F.col("p"))).alias("firsts"))
    none = F.array().cast("array<long>")
    return rows.select("row", "doc_id", "text_hash", "n_words").join(lists, "row", "left").select("doc_id", "text_hash", "n_words", F.coalesce("postings", none).alias("postings"), F.coalesce("firsts", none).alias("firsts"))


def intersect(indexed: DataFrame, anchors: DataFrame, slop: int = 0) -> DataFrame:
    """(doc_id, text_hash, window_id, start, length, met): candidate starts by the rarest term's postings at which, within slop, the lists of all other
    rare terms stand; met: at the very start."""
    hits = indexed.where(F.size("firsts") > 0).select("doc_id", "text_hash", "postings", F.explode("firsts").alias("p"))
    hits = hits.select("doc_id", "text_hash", "postings", F.shiftright("p", 32).cast("int").alias("hash"), F.col("p").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("place"))
    narrow = F.transform("rare", lambda r: F.struct(r["offset"].alias("offset"), r["hash"].alias("hash")))
    wanted = anchors.select("window_id", F.size("window").alias("length"), F.get("rare", F.lit(0))["hash"].alias("hash"), narrow.alias("rare"))
    found = hits.join(maybe_broadcast(wanted, wanted.count(), 160), "hash").withColumn("start", F.col("place") - F.get("rare", F.lit(0))["offset"])
    others = F.slice("rare", F.lit(2), F.greatest(F.size("rare") - 1, F.lit(0)))
    met = F.forall(others, lambda r: F.array_contains("postings", posting(r["hash"], F.col("start") + r["offset"])))
    if not slop:
        return found.where((F.col("start") >= 0) & met).select("doc_id", "text_hash", "window_id", "start", "length", F.lit(True).alias("met"))
    beside = lambda r: F.exists("postings", lambda p: (F.shiftright(p, 32) == r["hash"]) & (F.abs(p.bitwiseAND(F.lit(0xFFFFFFFF)) - r["offset"] - F.col("start")) <= slop))
    return found.where(F.forall(others, beside)).select("doc_id", "text_hash", "window_id", "start", "length", ((F.col("start") >= 0) & met).alias("met"))


def matches(docs: DataFrame, windows: DataFrame, indexed: DataFrame, anchors: DataFrame, slop: int = 0) -> DataFrame:
    """(doc_id, text_hash, window_id, start, length, kind): every phrase match, and with slop also the proximity matches."""
    found = keep(intersect(indexed, anchors, slop).distinct())
    # a group is what one text holds
    asked = keep(found.where("met").groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.collect_list(F.struct("window_id", "start", "length")).alias("starts")), found.count())
    size = asked.agg(F.count("*"), F.sum(F.size("starts"))).first()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(empty_safe(text)).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    rows = rows.join(maybe_broadcast(asked, (size[0] or 0) + (size[1] or 0), 32), same).select("doc_id", "text_hash", words_of(F.col("text")).alias("w"), "starts")
    stretch = F.transform("starts", lambda s: F.struct(s["window_id"].alias("window_id"), s["start"].alias("start"), F.slice("w", s["start"] + 1, s["length"]).alias("held")))
    rows = rows.select("doc_id", "text_hash", F.explode_outer(stretch).alias("s")).select("doc_id", "text_hash", "s.window_id", "s.start", "s.held")
    n_bytes = windows.agg(_bytes(F.array_join("window", " "), WINDOW_BYTES)).first()[0] or 0
    rows = rows.join(maybe_broadcast(windows, n_bytes, 1), "window_id").where(F.col("held") == F.col("window"))
    phrase = keep(rows.select("doc_id", "text_hash", "window_id", "start", F.size("window").alias("length"), F.lit("phrase").alias("kind")).distinct(), size[1] or 0)
    if not slop:
        return phrase
    p = phrase.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("window_id").alias("w"), F.col("start").alias("s"))
    near = found.join(p, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")) & (F.col("window_id") == F.col("w")) & (F.col("start") == F.col("s")), "left_anti")
    return phrase.unionByName(near.select("doc_id", "text_hash", "window_id", "start", "length", F.lit("proximity").alias("kind")))


def item_classes(window_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(window_id, class) and (class, item_id): windows that the same items hold are of one class."""
    held = window_items.groupBy("window_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    named = keep(held.groupBy("items").agg(F.min("window_id").alias("class"), F.collect_set("window_id").alias("windows")), window_items.count())
    return named.select("class", F.explode("windows").alias("window_id")), named.select("class", F.explode("items").alias("item_id"))


def hits(found: DataFrame, window_items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_hit, item_ids): the words inside matches and the items that they are of."""
    classes, items = item_classes(window_items)
    span = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    # a group is what one text holds
    held = keep(found.join(classes, "window_id").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(span)).alias("spans"), F.sort_array(F.collect_set("class")).alias("set")), found.count())
    sets = held.select("set").distinct()
    lists = sets.select("set", F.explode("set").alias("class")).join(items, "class").groupBy("set").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda t, s: F.struct((t["n"] + F.greatest(s["end"] - F.greatest(t["end"], s["start"]), F.lit(0))).alias("n"), F.greatest(t["end"], s["end"]).alias("end"))
    return held.join(lists, "set").select("doc_id", "text_hash", F.aggregate("spans", zero, step, lambda t: t["n"]).alias("n_hit"), "item_ids")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0, literal_terms: int = LITERAL_TERMS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, near_ids) of every row of docs; items: item_id and text. near_ids: items of
    proximity matches (none without slop)."""
    windows, window_items = windows_of(items, size)
    n = windows.count()
    window_items = keep(window_items, n)
    anchors = keep(rare_terms(windows, docs), WINDOW * n)
    indexed = keep(index(docs, anchors, literal_terms))
    found = matches(docs, windows, indexed, anchors, slop)
    none = F.array().cast("array<string>")
    marked = hits(found.where("kind = 'phrase'"), window_items).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "n_hit", "item_ids")
    rows = indexed.select("doc_id", "text_hash", "n_words").join(marked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left").drop("d", "h")
    if slop:
        near = hits(found.where("kind = 'proximity'"), window_items).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("item_ids").alias("near_ids"))
        rows = rows.join(near, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    else:
        rows = rows.withColumn("near_ids", none)
    ids = F.coalesce("item_ids", none)
    return rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), F.coalesce("near_ids", none).alias("near_ids"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """The rows of docs in which no window of an item occurs (with slop: nor in proximity).

    The rows that go are broadcast if their counted size allows; the texts are then not shuffled."""
    windows, _ = windows_of(items, size)
    anchors = keep(rare_terms(windows, docs), WINDOW * windows.count())
    found = matches(docs, windows, keep(index(docs, anchors)), anchors, slop)
    d, h = free_names(docs, "leaked_id", "leaked_hash")
    leaked = keep(found.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h)).distinct(), found.count())
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64(empty_safe(F.col("text").cast("string"))) == F.col(h))
    return docs.join(maybe_broadcast(leaked, leaked.count(), 32), same, "left_anti")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN t ON t.r = d.r
"""
