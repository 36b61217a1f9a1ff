"""Document operators: segmentation, selection, joins and assembly on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions import references as R
from vellum.functions import text as X

# Fixed value: conjunctions that open a sentence weakly.
WEAK = r"^(And|But|Or|For|If|When|While|So|Yet)\s"

#: Most lines that a task is dealt on average, whatever the number of lines.
LINES_A_TASK = 100_000
#: Pages of a volume in one stretch, in which entries and pages meet.
STRETCH = 64

# How a speech service is asked to read.
VOICE = (("stability", 0.75), ("similarity_boost", 0.85), ("style", 0.15), ("use_speaker_boost", True), ("speed", 0.85))


def volume_ranges(spark: SparkSession) -> DataFrame:
    """(lo, hi, volume): 63 disjoint ranges over 1..3563. Volumes hold 57 numbers but for 1 (53), 6 (66) and 63 (24)."""
    v = F.col("volume")
    lo = F.when(v == 1, 1).when(v <= 6, 54 + 57 * (v - 2)).otherwise(348 + 57 * (v - 7))
    hi = F.when(v == 6, 347).when(v == 63, 3563).when(v == 1, 53).otherwise(lo + 56)
    return spark.range(1, 64).select(F.col("id").cast("int").alias("volume")).select(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), "volume")


def assign_volume(items: DataFrame, number: str, last: int = 63) -> DataFrame:
    """items with the volume of their number; numbers outside all ranges get the last one. The ranges (63 rows) are broadcast."""
    ranges = F.broadcast(volume_ranges(items.sparkSession))
    joined = items.join(ranges, F.col(number).between(F.col("lo"), F.col("hi")), "left")
    return joined.withColumn("volume", F.coalesce("volume", F.lit(last))).drop("lo", "hi")


def sentence_rows(docs: DataFrame, split=X.sentences) -> DataFrame:
    """(doc_id, pos, sentence)."""
    return exploded(docs, split(F.col("text")), "sentence")


def exploded(docs: DataFrame, values: Column, name: str) -> DataFrame:
    """(doc_id, pos, name) of an array. An outer explode, since the optimizer puts a test of the array's size, and with it the array's whole
    computation, once more before an inner one."""
    return docs.select("doc_id", F.posexplode_outer(values).alias("pos", name)).where("pos is not null")


def strong_count(sentence: Column, words: tuple[str, ...]) -> Column:
    return F.regexp_count(sentence, F.lit(rf"(?i)\b({'|'.join(words)})\b"))


def top_sentences(docs: DataFrame, words: tuple[str, ...], k: int = 8, prefix: int = 30, at_least: int = 2, artifacts: tuple[str, ...] = ()) -> DataFrame:
    """The k best sentences of each document: 30 to 120 characters, closed, capitalised, with enough strong words (one more
    after a weak conjunction); score 10 a strong word, -0.08 a character, 3 for an exclamation mark; of those with an equal prefix the best stays.
    Lines in capitals, of a page number or with an artifact are left out first. All within a row: no shuffle, rows that repeat are ranked each."""
    bare = F.transform(F.split(F.col("text"), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r\n\f\x0b")))
    junk = lambda x: (x == "") | (F.regexp_like(x, F.lit(r"\p{Lu}")) & ~F.regexp_like(x, F.lit(r"\p{Ll}"))) | F.regexp_like(x, F.lit("^[0-9]+$"))
    for mark in artifacts:
        junk = lambda x, mark=mark, other=junk: other(x) | F.contains(F.lower(x), F.lit(mark))
    rows = docs.select("doc_id", X.sentences_simple(F.array_join(F.filter(bare, lambda x: ~junk(x)), " ")).alias("s"))
    sized = F.filter(F.transform("s", lambda x, i: F.when(F.length(x).between(30, 120) & F.regexp_like(x, F.lit("^\\p{Lu}")) & F.regexp_like(x, F.lit("[.!?]$")), F.struct(i.alias("pos"), x.alias("sentence"), strong_count(x, words).alias("strong")))), lambda x: x.isNotNull())
    rows = rows.select("doc_id", F.filter(sized, lambda x: x["strong"] >= at_least + F.regexp_like(x["sentence"], F.lit(WEAK)).cast("int")).alias("s"))
    score = lambda x: F.round(x["strong"] * 10 - F.length(x["sentence"]) * 0.08 + F.when(F.contains(x["sentence"], F.lit("!")), 3).otherwise(0), 6)
    rows = rows.select("doc_id", F.array_sort(F.transform("s", lambda x: F.struct((-score(x)).alias("low"), x["pos"].alias("pos"), x["sentence"].alias("sentence")))).alias("s"))
    heads = rows.select("doc_id", "s", F.transform("s", lambda x: F.left(x["sentence"], F.lit(prefix))).alias("h"))
    best = heads.select("doc_id", F.slice(F.filter("s", lambda x, i: F.array_position("h", F.get("h", i)) == i + 1), 1, k).alias("s"))
    return exploded(best, F.col("s"), "x").withColumnRenamed("pos", "rank").select("doc_id", (F.col("rank") + 1).alias("rank"), "x.pos", (-F.col("x.low")).alias("score"), "x.sentence")


def first_of_prefix(docs: DataFrame, prefix: int, split=X.sentences) -> DataFrame:
    """(doc_id, pos, sentence): of a document's sentences with an equal prefix the first. Within a row: no shuffle."""
    rows = docs.select("doc_id", split(F.col("text")).alias("s"))
    rows = rows.select("doc_id", "s", F.transform("s", lambda x: F.left(x, F.lit(prefix))).alias("h"))
    first = F.transform(F.array_distinct("h"), lambda p: F.array_position("h", p).cast("int") - 1)
    kept = F.transform(first, lambda i: F.struct(i.alias("pos"), F.get("s", i).alias("sentence")))
    return rows.select("doc_id", F.explode_outer(kept).alias("x")).where("x is not null").select("doc_id", "x.pos", "x.sentence")


def keep_first(rows: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    (r,) = free_names(rows, "r")
    return rows.withColumn(r, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(r) == 1).drop(r)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores appended until no column of df has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def tail_third(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line): the last floor(n/3) lines."""
    ls = X.lines(F.col("text"))
    n = F.size(ls)
    return exploded(docs, F.slice(ls, n - F.floor(n / 3).cast("int") + 1, F.floor(n / 3).cast("int")), "line")


def page_ranges(bookmarks: DataFrame, totals: DataFrame) -> DataFrame:
    """Each entry owns the pages from its start to the next entry's; the last one to the end. bookmarks: volume, ord, start_page;
    totals: volume, total."""
    after = F.lead("start_page").over(Window.partitionBy("volume").orderBy("ord"))
    return bookmarks.where("start_page is not null").join(totals, "volume").withColumn("end_page", F.coalesce(after, F.col("total"))).drop("total")


def volume_documents(bookmarks: DataFrame, pages: DataFrame, totals: DataFrame, is_header=X.header_line, is_promo=X.promo_line) -> DataFrame:
    """(volume, num, title, body): one row for each number of a volume's entries, with the text of the pages that the entry owns.

    bookmarks: volume, ord, title, page_no; pages: volume, page_no, text; totals: volume, total. Entries without a page or a number are
    none; an entry without pages has an empty body. Entries and pages meet in stretches of STRETCH pages of a volume, so that a volume's pages are not held
    against all its entries; the stretches of an entry end with the volume's pages, whatever the total says."""
    entries = bookmarks.where("page_no is not null").select("volume", "ord", F.col("page_no").alias("start_page"), X.bookmark_numbers(F.btrim("title")).alias("b")).where("b is not null")
    there = pages.groupBy(F.col("volume").alias("v")).agg(F.min("page_no").alias("least"), F.max("page_no").alias("most"))
    owned = page_ranges(entries, totals).join(there, F.col("volume") == F.col("v"), "left")
    stretch = lambda page: F.floor(page / STRETCH)
    begin, end = F.greatest("start_page", "least"), F.least(F.col("end_page") - 1, "most")
    # an entry without pages keeps one row
    owned = owned.select("volume", "ord", "b", "start_page", "end_page", F.explode_outer(F.when(F.col("most").isNotNull() & (F.col("start_page") < F.col("end_page")) & (begin <= end), F.sequence(stretch(begin), stretch(end)))).alias("stretch"))
    text = pages.where("text != ''").select(F.col("volume").alias("v"), stretch(F.col("page_no")).alias("at"), "page_no", "text")
    near = (F.col("v") == F.col("volume")) & (F.col("at") == F.col("stretch")) & (F.col("page_no") >= F.col("start_page")) & (F.col("page_no") < F.col("end_page"))
    rows = owned.join(text, near, "left").withColumn("ls", F.split("text", "\n", -1)).withColumn("ls", X.without_head(F.col("ls"), is_header))
    ls = F.when(F.col("page_no") == F.col("end_page") - 1, X.without_promotion(F.col("ls"), is_promo)).otherwise(F.col("ls"))
    rows = rows.withColumn("part", F.struct("page_no", F.array_join(ls, "\n").alias("s")))
    whole = rows.groupBy("volume", "ord", "b").agg(F.array_sort(F.collect_list(F.when(F.col("page_no").isNotNull(), F.col("part")))).alias("parts"))
    return whole.select("volume", F.explode("b.nums").alias("num"), "b.title", F.array_join(F.transform("parts", lambda p: p["s"]), "\n").alias("body"))


def modal_value(rows: DataFrame, key: str, value: Column, order: str, default: float) -> DataFrame:
    """The most frequent rounded value of each key; of equals the first met, then the smaller."""
    counts = rows.groupBy(key, F.bround(value, 0).alias("v")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = F.min_by("v", F.struct(-F.col("n"), F.col("first"), F.col("v")))
    return counts.groupBy(key).agg(F.coalesce(best, F.lit(default)).alias("mode"))


def upper_median(rows: DataFrame, key: str, value: Column, default: float) -> DataFrame:
    """The upper median of each key's values: one aggregate over counts of values, combined in every task first."""
    (v,) = free_names(rows, "v")
    median = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{v}` DESC)")
    return rows.withColumn(v, value).groupBy(key).agg(F.coalesce(median, F.lit(default)).alias("median"))


def layout_metrics(lines: DataFrame, document: str) -> DataFrame:
    """(document, margin, spacing): the most frequent left edge, and the upper median of the steps of 0 to 30 points from one line's top to the next's.

    lines: document, page_no, line_no, x0, y0."""
    order = Window.partitionBy(document).orderBy("page_no", "line_no")
    gap = F.col("y0") - F.lag("y0").over(order)
    rows = lines.select(document, "x0", "page_no", "line_no", gap.alias("gap")).withColumn("at", F.struct("page_no", "line_no"))
    margin = modal_value(rows, document, F.col("x0"), "at", 54.0).withColumnRenamed("mode", "margin")
    spacing = upper_median(rows, document, F.when((F.col("gap") > 0) & (F.col("gap") < 30), F.col("gap")), 16.0).withColumnRenamed("median", "spacing")
    return margin.join(spacing, document)


def paragraph_islands(lines: DataFrame, margin: float | Column, spacing: float | Column, within: tuple[str, ...] = ("doc",)) -> DataFrame:
    """Layout lines (doc, line_no, x0, y0, y1, size) with para_id and kind; margin and spacing may be columns of lines. Breaks between neighbouring lines make islands; a
    first-line indent then splits islands of body text only. Lines of equal `within` are neighbours; all is found in one order of them."""
    w = Window.partitionBy(*within).orderBy("line_no")
    x0 = F.bround("x0", 0)
    rows = lines.withColumn("rx", x0).withColumn("indented", x0 >= margin + 100).withColumn("verse", (x0 >= margin + 100) & (F.col("size") <= 13))
    gap = F.col("y0") - F.lag("y1").over(w)
    turn = (gap < -50) & ((F.col("rx") > margin + 10) | F.col("indented"))
    start = F.lag("y1").over(w).isNull() | (gap > spacing * 1.5) | turn | (F.col("verse") != F.lag("verse").over(w))
    kind = F.when(F.col("verse"), "verse").when(F.col("indented"), "blockquote").otherwise("body")
    rows = rows.withColumn("start", start.cast("int")).withColumn("kind", F.last(F.when(F.col("start") == 1, kind), ignorenulls=True).over(w))
    indent = (F.col("rx") > margin + 10) & (F.col("rx") < margin + 20) & ~F.col("verse") & (F.col("size") >= 13.5) & (F.col("kind") == "body")
    rows = rows.withColumn("cut", F.greatest(F.col("start"), indent.cast("int")))
    return rows.withColumn("para_id", F.sum("cut").over(w)).select("doc", "line_no", "para_id", "kind", *[c for c in lines.columns if c not in ("doc", "line_no")])


def ordered_concat(rows: DataFrame, key: str, order: list[str], value: str, separator: str = "\n") -> DataFrame:
    packed = F.array_sort(F.collect_list(F.struct(*order, value)))
    return rows.groupBy(key).agg(F.array_join(F.transform(packed, lambda r: r[value]), separator).alias(value))


def boilerplate_trim(lines: DataFrame, is_header: Column, is_promo: Column, most: int = 2) -> DataFrame:
    """Lines (doc, line_no, line) without up to `most` leading headers and without the blank or promotional lines at the end."""
    down, up = Window.partitionBy("doc").orderBy("line_no"), Window.partitionBy("doc").orderBy(F.desc("line_no"))
    rows = lines.withColumn("head", F.min(is_header.cast("int")).over(down)).withColumn("at", F.row_number().over(down))
    rows = rows.withColumn("tail", F.min((is_promo | (F.btrim("line") == "")).cast("int")).over(up))
    return rows.where(~((F.col("head") == 1) & (F.col("at") <= most)) & (F.col("tail") == 0)).select("doc", "line_no", "line")


def layout_lines(lines: DataFrame, document: str, is_header, is_promo, most: int = 3) -> DataFrame:
    """The lines of a page layout that belong to the text, with their text and largest size.

    lines: document, page_no, line_no, page_height, y0 and spans of (text, size). Empty spans and blank lines go; so do small print, small
    headers and promotion in the bottom margin, the first `most` headers of a page, and the promotion that ends a document's last page.
    One shuffle by document, to tasks whose number follows that of the lines, since each task sorts what it is dealt; is_header and is_promo map a line's text to a condition."""
    spans = F.filter("spans", lambda s: s["text"] != "")
    printed = F.filter(spans, lambda s: F.btrim(s["text"]) != "")
    context = lines.sparkSession.sparkContext
    lines = lines.repartition(max(context.defaultParallelism, -(-lines.count() // LINES_A_TASK)), document)
    rows = lines.withColumn("__last", F.col("page_no") == F.max("page_no").over(Window.partitionBy(document)))
    rows = rows.withColumns({"spans": spans, "text": F.array_join(F.transform(spans, lambda s: s["text"]), ""), "size": F.array_max(F.transform(printed, lambda s: s["size"]))})
    text = F.btrim("text", F.lit(" \t\r\n\f\x0b"))
    footer = (F.col("y0") > F.col("page_height") - 80) & (F.col("size") <= 12) & (is_header(text) | is_promo(text))
    rows = rows.where((text != "") & (F.col("size") > 10.5) & ~footer)
    page = Window.partitionBy(document, "page_no")
    rows = rows.withColumn("__h", F.sum(is_header(text).cast("int")).over(page.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where(~is_header(text) | (F.col("__h") > most))
    rows = rows.withColumn("__p", F.min(is_promo(text).cast("int")).over(page.orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where(~F.col("__last") | (F.col("__p") == 0)).drop("__last", "__h", "__p")


def counts_by(rows: DataFrame, key: str, content: str) -> DataFrame:
    """(key, processed, succeeded): how many documents each key has, and how many of them have content."""
    return rows.groupBy(key).agg(F.count("*").alias("processed"), F.count_if(F.coalesce(F.col(content) != "", F.lit(False))).alias("succeeded"))


def document_files(docs: DataFrame) -> DataFrame:
    """(file_name, content) of documents (num, title, body): a title line, the number, a blank line and the body."""
    content = F.concat("title", F.lit("\n"), F.col("num").cast("string"), F.lit("\n\n"), "body", F.lit("\n"))
    return docs.select(X.numbered_name(F.col("num"), F.col("title")).alias("file_name"), content.alias("content"))


def catalogue_entries(files: DataFrame) -> DataFrame:
    """(num, title, file, scripture, volume) of files (file_name, text) named number_title.txt; others are none."""
    key = r"^(\d+)_(.+)\.txt$"
    own = files.where(F.regexp_like("file_name", F.lit(key)))
    rows = own.select(F.regexp_extract("file_name", key, 1).cast("int").alias("num"), X.first_line(F.col("text")).alias("title"), F.regexp_replace("file_name", r"\.txt$", "").alias("file"), R.first_reference(F.col("text")).alias("scripture"))
    return assign_volume(rows, "num")


def speech_requests(docs: DataFrame, ssml: str, model: str, settings: tuple[tuple[str, object], ...] = VOICE) -> DataFrame:
    """docs with column request: the JSON request of a speech service, its text without prosody wrappers."""
    voice = F.struct(*[F.lit(v).alias(k) for k, v in settings])
    return docs.withColumn("request", F.to_json(F.struct(X.prosody_inner(F.col(ssml)).alias("text"), F.lit(model).alias("model_id"), voice.alias("voice_settings"))))


def fallback(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """left with value from right by key where that is given and not empty, else its own, else ''."""
    (o,) = free_names(left, "other")
    other = right.select(key, F.col(value).alias(o))
    return left.join(other, key, "left").withColumn(value, F.coalesce(F.nullif(o, F.lit("")), F.col(value), F.lit(""))).drop(o)


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done, key, "left_anti")


def manifest(kinds: dict[str, DataFrame], order: str) -> DataFrame:
    """One row: for each kind the array of its rows, by `order`. A catalogue of files, so its size is that of a listing."""
    out = None
    for name, rows in kinds.items():
        one = rows.agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in rows.columns if c != order]))).alias(name))
        out = one if out is None else out.join(one, F.lit(True))  # one row each
    return out
