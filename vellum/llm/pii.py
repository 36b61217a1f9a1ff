"""Personal data: fixed formats, and bootstrapped contextual extraction beyond them.

The fixed formats (email, ip, card, phone) give the seeds. Candidates are all other runs without white space that hold a digit, and such
runs joined by single spaces as one (groups of an identifier); what holds no digit is no candidate. Seeds and candidates are found by one
expression in the text with its seeds blanked out, so both see the same context. Each induces lexical patterns: the two words to its left; the words to its left and
right; the word to its left with the shape of the value (every letter and digit by its class). A word is a run of ASCII letters, digits and characters above U+007F,
whole at any length; one that holds a digit is written # and no pattern's nearest word.

The graph of patterns and distinct values is scored in up to ROUNDS rounds. A value weighs 1 for its kind as a seed, its score
once it is accepted, else nothing. A pattern's trust for a kind is the weight of its values over all that stands in its slot anywhere in the corpus: that weight, values of
other kinds, all distinct words without a digit, half of the unknown candidates, and one. Patterns of MIN_TRUST or more whose values weigh
MIN_SEEDS or more accept the candidates in their slot, with the noisy-or of their trusts as the score; these induce
the next round's patterns. What stands in the slot of a trusted pattern of the last round is a span of its kind. Only DataFrame functions are used: two passes over the texts and two over small shares of them (these and the last
count the words in the slots of possible patterns), then aggregates and joins over the graph, cut by checkpoints.

Cases: a null text is empty and has no spans. Rows are told apart by doc_id and a hash of the text; rows that repeat
both give equal results. An empty table gives an empty result. Other columns may have any name. Ties: a place that patterns of several kinds
reach takes the kind of most trust, then the first listed; a span of two fixed kinds is a seed of the first listed. Very long texts and words are
read whole. A pattern or value that many documents share is pre-aggregated in every task before it is shuffled, and joins on them are either broadcast or plain
sort-merge joins whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import empty_safe, free_names, keep, maybe_broadcast
from vellum.llm.spans import count_of, find, joined, masked

KINDS = ("email", "ip", "card", "phone")
#: Starts inside a run cannot match where its start did not, so runs are entered at their start or after a match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Stands for each character of a seed where contexts are looked for.
FILL = "\uffff"
#: A blanked seed, or a run without white space that holds a digit.
INSTANCE = r"\uffff++|(?<![^\x00-\x20])[^0-9\x00-\x20\uffff]*+[0-9][^\x00-\x20\uffff]*+(?![^\x00-\x20])"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
ROUNDS = 4
MIN_TRUST = 0.75
MIN_SEEDS = 4
#: One in so many texts, by a hash, in which the words in the slots of patterns are counted in turn.
SHARES = (256, 16, 1)
#: Most patterns that the texts are first searched for as they stand.
FEW = 64
#: Estimated bytes of a broadcast row of the graph.
ROW_BYTES = 128


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-digit test."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(values, F.lit(0), lambda t, v: t + v) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the fixed formats, in the listing order of kinds."""
    digits = lambda s: F.regexp_replace(s["value"], "[^0-9]", "")
    near = lambda pattern: F.regexp_like(text, F.lit(pattern))
    card = F.filter(find(text, CARD, near("[0-9](?:[ -]?[0-9]){15}")), lambda s: F.length(digits(s)).between(16, 19))
    return {
        "email": find(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(find(text, IP, near(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), lambda s: F.forall(F.split(s["value"], r"\."), lambda part: F.try_to_number(F.right(part, F.lit(3)), F.lit("999")).between(0, 255) & F.regexp_like(part, F.lit("^0*[0-9]{1,3}$")))),
        "card": F.filter(card, lambda s: luhn(digits(s))),
        "phone": F.filter(find(text, PHONE, F.contains(text, F.lit("+"))), lambda s: F.length(digits(s)).between(8, 15)),
    }


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _blur(word: Column) -> Column:
    """The word as contexts hold it."""
    return F.when(F.regexp_like(word, F.lit("[0-9\uffff]")), F.lit("#")).otherwise(word)


def shape(value: Column) -> Column:
    """Every ASCII letter and digit by its class."""
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    return F.translate(value, upper + lower + digits, "A" * 26 + "a" * 26 + "9" * 10)


def _patterns(s: Column) -> Column:
    """The patterns of an occurrence (value, left: its left context reversed, right)."""
    one, two, after = s["one"], s["two"], s["right"]
    named = (one != "") & (one != "#")
    pairs = F.when(named & (two != ""), F.concat(F.lit("2 "), two, F.lit(" "), one))
    around = F.when(named & (after != "") & (after != "#"), F.concat(F.lit("1 "), one, F.lit(" "), after))
    shaped = F.when(named, F.concat(F.lit("s "), one, F.lit(" "), shape(s["value"])))
    return F.filter(F.array(pairs, around, shaped), lambda p: p.isNotNull())


OCCURRENCES = "array<struct<start:int,end:int,value:string,one:string,two:string,right:string>>"


def _occurrences(pieces: Column, hits: Column) -> Column:
    """The matches of INSTANCE with the two words to the left and the one to the right; candidates that single spaces join, where letters or
    digits stand on both sides of each, are one."""
    gaps = F.zip_with(pieces, F.slice(pieces, F.lit(2), F.size(hits)), lambda p, n: F.struct(p.alias("p"), n.alias("n")))
    runs = F.zip_with(hits, F.slice(hits, F.lit(2), F.size(hits)), lambda h, n: F.struct(h.alias("h"), n.alias("n")))
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), runs, lambda g, r: F.struct(g["p"].alias("p"), r["h"].alias("h"), F.concat(g["n"], F.coalesce(r["n"], F.lit(""))).alias("after")))
    last_two = f"^{BETWEEN}*+({WORD}++)(?:{BETWEEN}++({WORD}++))?"
    word = lambda text, k: _blur(_ascii_lower(F.reverse(F.regexp_extract(text, last_two, k))))
    plain = lambda c: F.regexp_like(c, F.lit("[A-Za-z0-9]"))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["p"])
        end = start + F.length(x["h"])
        left = F.concat(F.reverse(x["p"]), done["left"])  # reversed: the nearest comes first
        right = _blur(_ascii_lower(F.regexp_extract(x["after"], f"^{BETWEEN}*+({WORD}++)", 1)))
        one = F.struct(start.alias("start"), end.alias("end"), x["h"].alias("value"), word(left, 1).alias("one"), word(left, 2).alias("two"), right.alias("right"))
        last = F.get(done["out"], F.size(done["out"]) - 1)
        joins = last.isNotNull() & (x["p"] == " ") & plain(F.right(last["value"], F.lit(1))) & plain(F.left(x["h"], F.lit(1)))
        both = F.struct(last["start"].alias("start"), end.alias("end"), F.concat(last["value"], F.lit(" "), x["h"]).alias("value"), last["one"].alias("one"), last["two"].alias("two"), right.alias("right"))
        before = F.slice(done["out"], F.lit(1), F.greatest(F.size(done["out"]) - 1, F.lit(0)))
        kept = F.regexp_extract(F.concat(F.reverse(x["h"]), left), f"^{BETWEEN}*+(?:{WORD}++{BETWEEN}*+){{0,2}}", 0)
        return F.struct(end.alias("at"), kept.alias("left"), F.when(joins, F.concat(before, F.array(both))).otherwise(F.concat(done["out"], F.array(one))).alias("out"))

    none = F.array().cast(OCCURRENCES)
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.lit("").alias("left"), none.alias("out")), step, lambda done: done["out"])


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, seen): base spans (start, end, rank, kind), and all seeds and candidates with their patterns
    (start, end, value, kind, patterns; kind null for candidates); one pass over the texts."""
    rows = docs.select("doc_id", empty_safe(F.col("text").cast("string")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), *[s.alias(f"s_{k}") for k, s in base_spans(F.col("text")).items()])
    one = lambda k, i: F.transform(F.col(f"s_{k}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(i).alias("rank"), F.lit(k).alias("kind"), s["value"].alias("value")))
    rows = rows.select("doc_id", "text", "text_hash", F.concat(*[one(k, i) for i, k in enumerate(KINDS)]).alias("base"))
    rows = rows.select("doc_id", "text_hash", "base", masked(F.col("text"), F.col("base"), FILL).alias("m"))
    none = F.array().cast("array<string>")
    any_hit = F.regexp_like("m", F.lit("[0-9\uffff]"))
    rows = rows.select("doc_id", "text_hash", "base", F.when(any_hit, F.split("m", INSTANCE, -1)).otherwise(none).alias("p"), F.when(any_hit, F.regexp_extract_all("m", F.lit(INSTANCE), F.lit(0))).otherwise(none).alias("h"))
    rows = rows.select("doc_id", "text_hash", "base", F.when(F.size("h") > 0, _occurrences(F.col("p"), F.col("h"))).otherwise(F.array().cast(OCCURRENCES)).alias("o"))

    def with_kind(s: Column) -> Column:
        seed = F.get(F.filter(F.col("base"), lambda b: (b["start"] >= s["start"]) & (b["start"] < s["end"])), F.lit(0))
        found = F.startswith(s["value"], F.lit(FILL))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(found, seed["value"]).otherwise(s["value"]).alias("value"), F.when(found, seed["kind"]).alias("kind"), s["one"].alias("one"), s["two"].alias("two"), s["right"].alias("right"))

    rows = rows.select("doc_id", "text_hash", "base", F.filter(F.transform("o", with_kind), lambda s: s["value"].isNotNull()).alias("o"))
    seen = F.transform("o", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["kind"].alias("kind"), _patterns(s).alias("patterns")))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind")))
    return rows.select("doc_id", "text_hash", base.alias("base"), seen.alias("seen"))


def slot_words(docs: DataFrame, patterns: DataFrame, n_patterns: int) -> DataFrame:
    """(pattern, words): in how many distinct words without a digit the slot of a pattern of two words (left) or one (left and right) is
    filled, over all texts of docs; patterns: distinct column pattern."""
    text = _ascii_lower(empty_safe(F.col("text").cast("string")))
    if n_patterns <= FEW:  # only texts that hold both words of some pattern
        pairs = [[w for w in r.pattern.split(" ")[1:] if w != "#"] for r in patterns.collect() if not r.pattern.startswith("s ")]
        held = [reduce(Column.__and__, [F.contains(text, F.lit(w)) for w in pair]) for pair in pairs]
        docs = docs.where(reduce(Column.__or__, held, F.lit(False)))
    bare = F.regexp_replace(text, r"(?<![^\x00-\x20])[^0-9@\x00-\x20]*+[0-9@][^\x00-\x20]*+", " 0 ")
    bare = F.when(F.regexp_like(text, F.lit("[0-9@]")), bare).otherwise(text)
    words = docs.select(F.array_remove(F.split(bare, f"{BETWEEN}+"), "").alias("w"))
    blank = F.lit("")
    beside = {"word": F.col("w"), "one": F.concat(F.array(blank), "w"), "two": F.concat(F.array(blank, blank), "w"), "after": F.slice("w", F.lit(2), F.size("w"))}
    # outer, since before an inner explode the optimizer tests the array's size, and makes the array once more for it
    at = words.select(*[c.alias(k) for k, c in beside.items()]).select(F.explode_outer(F.arrays_zip(*beside)).alias("z")).select("z.word", "z.one", "z.two", "z.after")
    at = at.where("word != '0' and one not in ('', '0')")
    parts = F.split("pattern", " ")
    wanted = patterns.select("pattern", F.get(parts, F.lit(0)).alias("type"), F.get(parts, F.lit(1)).alias("a"), F.get(parts, F.lit(2)).alias("b"))
    wanted = wanted.where("type in ('1', '2')").select("pattern", "type", F.when(F.col("type") == "2", F.col("b")).otherwise(F.col("a")).alias("one"), F.when(F.col("type") == "2", F.col("a")).otherwise(F.col("b")).alias("other"))
    near = maybe_broadcast(wanted.select("one").distinct(), n_patterns, ROW_BYTES)
    at = at.join(near, "one", "left_semi")
    both = F.array(F.struct(F.lit("2").alias("type"), F.when(F.col("two") == "0", F.lit("#")).when(F.col("two") != "", F.col("two")).alias("other")), F.struct(F.lit("1").alias("type"), F.col("after").alias("other")))
    at = at.select("word", "one", F.explode(both).alias("c")).select("word", "one", "c.type", "c.other")
    held = at.join(maybe_broadcast(wanted, n_patterns, ROW_BYTES), ["one", "type", "other"]).groupBy("pattern", "word").agg(F.lit(1).alias("x"))
    return held.groupBy("pattern").agg(F.count("*").alias("words"))


def possible(docs: DataFrame, edges: DataFrame, n_edges: int, min_trust: float, min_seeds: int) -> tuple[DataFrame, int]:
    """(pattern, words) of the patterns that may come to be trusted, and a count of them.

    A pattern of n values can weigh n at most, so too few values or too many words rule it out. The words of growing shares of the texts are counted: those
    of a part are a lower bound of all, so what a part rules out need not be counted further, and the last share is all texts."""
    left = keep(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= min_seeds), n_edges // min_seeds)
    n = left.count()
    left = left.withColumn("words", F.lit(0).cast("long"))
    for share in SHARES:
        if not left.where("not startswith(pattern, 's ')").take(1):  # slots of a shape hold no words
            break
        part = docs if share == 1 else docs.where(F.pmod(F.xxhash64(empty_safe(F.col("text").cast("string"))), F.lit(share)) == 0)
        counted = slot_words(part, left.select("pattern"), n)
        room = F.col("n") / (F.col("n") + F.col("words") + 1) >= min_trust
        left = keep(left.select("pattern", "n").join(counted, "pattern", "left").select("pattern", "n", F.coalesce("words", F.lit(0)).alias("words")).where(room), n)
        n = left.count()
    return left.select("pattern", "words"), n


def discover(docs: DataFrame, extracted: DataFrame, rounds: int = ROUNDS, min_trust: float = MIN_TRUST, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(pattern, kind, trust): the trusted patterns of the last round."""
    flat = extracted.select(F.explode("seen").alias("s")).select("s.value", "s.kind", F.explode("s.patterns").alias("pattern"))
    n_edges = 3 * (extracted.agg(F.sum(F.size("seen"))).first()[0] or 0)
    edges = keep(flat.groupBy("pattern", "value").agg(F.min_by("kind", _rank(F.col("kind"))).alias("seed")), n_edges)
    able, n_able = possible(docs, edges, n_edges, min_trust, min_seeds)
    empty = edges.sparkSession.createDataFrame([], "pattern string, kind string, trust double")
    if not n_able:
        return empty
    # a value that is a seed anywhere is one everywhere
    seeds = edges.where("seed is not null").groupBy("value").agg(F.min_by("seed", _rank(F.col("seed"))).alias("fixed"))
    edges = keep(edges.select("pattern", "value").join(maybe_broadcast(able, n_able, ROW_BYTES), "pattern").join(seeds, "value", "left"), n_edges)
    accepted, good, before = None, empty, (0, 0)
    for _ in range(rounds):
        held = edges if accepted is None else edges.join(accepted, "value", "left")
        kind = F.col("fixed") if accepted is None else F.coalesce("fixed", "kind")
        weight = F.lit(1.0) if accepted is None else F.when(F.col("fixed").isNotNull(), F.lit(1.0)).otherwise(F.col("score"))
        held = held.select("pattern", "words", kind.alias("k"), weight.alias("w"))
        sums = [F.sum(F.when(F.col("k") == k, F.col("w")).otherwise(F.lit(0.0))).alias(f"w_{k}") for k in KINDS] + [F.count(F.when(F.col("k") == k, F.lit(1))).alias(f"n_{k}") for k in KINDS]
        totals = held.groupBy("pattern").agg(*sums, F.max("words").alias("words"), F.count("*").alias("n"), F.count("k").alias("known"))
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"w_{k}").alias("w"), F.col(f"n_{k}").alias("own")) for k in KINDS])).alias("e")
        graded = totals.select("pattern", "words", "n", "known", each).select("pattern", "e.kind", "e.w", "e.own", "words", "n", "known")
        slot = F.col("w") + (F.col("known") - F.col("own")) + F.col("words") + (F.col("n") - F.col("known")) / 2 + 1
        good = keep(graded.select("pattern", "kind", "w", (F.col("w") / slot).alias("trust")).where((F.col("w") >= min_seeds) & (F.col("trust") >= min_trust)).select("pattern", "kind", "trust"), n_able)
        n_good = good.count()
        reach = edges.where("fixed is null").select("pattern", "value").join(maybe_broadcast(good, n_good, ROW_BYTES), "pattern")
        scored = reach.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.ln(1 - F.col("trust"))))).alias("score"))
        best = scored.groupBy("value").agg(F.max(F.struct(F.col("score"), -_rank(F.col("kind")), F.col("kind"))).alias("b"))
        accepted = keep(best.select("value", "b.kind", "b.score"), n_edges)
        now = (n_good, accepted.count())
        accepted = maybe_broadcast(accepted, now[1], ROW_BYTES)
        if now == before or not now[1]:
            break
        before = now
    return good


def _rank(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, F.lit(i)) for i, k in enumerate(KINDS)])


def pii_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans) of every row of docs: arrays of (start, end, rank, kind)."""
    rows = keep(extract(docs))
    found = discover(docs, rows)
    base = rows.select("doc_id", "text_hash", "base")
    n_found = found.count()
    if not n_found:
        return base.select("*", F.col("base").alias("spans"))
    reached = rows.select("doc_id", "text_hash", F.explode("seen").alias("s")).where("s.kind is null").select("doc_id", "text_hash", "s.start", "s.end", F.explode("s.patterns").alias("pattern"))
    reached = reached.join(maybe_broadcast(found, n_found, ROW_BYTES), "pattern")
    place = reached.groupBy("doc_id", "text_hash", "start", "end").agg(F.max(F.struct(F.col("trust"), -_rank(F.col("kind")), F.col("kind"))).alias("b"))
    one = F.struct(F.col("start"), F.col("end"), _rank(F.col("b.kind")).alias("rank"), F.col("b.kind").alias("kind"))
    more = keep(place.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.collect_set(one).alias("more"), F.count("*").alias("n")), rows.count())
    size = more.agg(F.count("*"), F.sum("n")).first()
    out = base.join(maybe_broadcast(more.drop("n"), (size[0] or 0) + (size[1] or 0), 64), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return out.select("doc_id", "text_hash", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")).alias("spans"))


def mask_pii(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in angle brackets and n_chars, where there is one, set to the new length.

    The rows with spans are broadcast if their counted size allows; the texts are then not shuffled."""
    d, h, s = free_names(docs, "marked_id", "marked_hash", "marked_spans")
    marked = keep(pii_spans(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("spans").alias(s)), docs.count())
    size = marked.agg(F.count("*"), F.sum(F.size(s))).first()
    text = F.col("text").cast("string")
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64(empty_safe(text)) == F.col(h))
    out = docs.join(maybe_broadcast(marked, (size[0] or 0) + (size[1] or 0), 64), same, "left").withColumn("text", F.when(F.col(s).isNull(), text).otherwise(masked(text, F.col(s))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(s).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_pii(spark, sf_dir: str) -> DataFrame:
    found = pii_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base"), True).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans"), True).alias("spans"))
