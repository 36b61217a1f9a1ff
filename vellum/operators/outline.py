"""A document's outline as rows: divisions, illustrations, applications, its rendering; broken words; the scan of layout lines."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import markup as M
from vellum.functions import outline as O
from vellum.functions import references as R
from vellum.functions import text as X
from vellum.operators.documents import exploded, free_names, layout_lines, layout_metrics, paragraph_islands

#: Most pieces that a broken word is looked up in, and its most characters.
PIECES, LONGEST = 8, 64
NONE = "array<struct<numeral:string,text:string,section:string>>"


def _part(numeral: Column, text: Column, section: Column) -> Column:
    return F.struct(numeral.alias("numeral"), text.alias("text"), section.alias("section"))


def roman_parts(ls: Column) -> Column:
    """Divisions that open with a Roman numeral; the heading goes on over up to four lines in capitals or while it is short."""
    at = F.filter(F.transform(ls, lambda x, i: F.when(F.regexp_like(x, F.lit(O.ROMAN)), i)), lambda i: i.isNotNull())

    def go_on(t: Column, line: Column) -> Column:
        more = t["open"] & (line != "") & ~F.regexp_like(line, F.lit(r"^\d+\.")) & (O.is_upper(line) | (F.length(t["text"]) < 60))
        return F.struct(F.when(more, F.concat(t["text"], F.lit(" "), line)).otherwise(t["text"]).alias("text"), more.alias("open"))

    def part(i: Column, after_it: Column) -> Column:
        after = F.transform(F.split(F.left(F.array_join(F.slice(ls, i + 2, F.lit(4)), "\n"), F.lit(499)), "\n", -1), O.strip)
        text = F.aggregate(after, F.struct(O.strip(F.regexp_extract(F.get(ls, i), O.ROMAN, 2)).alias("text"), F.lit(True).alias("open")), go_on, lambda t: t["text"])
        section = F.array_join(F.slice(ls, i + 1, F.coalesce(after_it, F.size(ls)) - i), "\n")
        return _part(F.regexp_extract(F.get(ls, i), O.ROMAN, 1), text, section)

    return X.let(at, lambda at: F.transform(at, lambda i, k: part(i, F.get(at, k + 1))))


def ordinal_parts(body: Column) -> Column:
    """Divisions that open with "First," and the like, up to the next full stop within 200 characters, else 150."""
    def part(mark: Column, start: Column, end: Column) -> Column:
        numeral = None
        for word, roman in O.ORDINALS:
            hit = F.contains(F.lower(mark), F.lit(word))
            numeral = F.when(hit, roman) if numeral is None else numeral.when(hit, roman)
        tail = F.substring(body, start + F.length(mark) + 1, F.lit(201))
        closed = lambda tail: X.let(F.locate(".", tail), lambda dot: F.when(dot > 0, F.left(tail, dot - 1)).otherwise(F.left(tail, F.lit(150))))
        text = O.strip(F.regexp_replace(O.strip(X.let(tail, closed)), "^,+", ""))
        return _part(numeral, text, F.substring(body, start + 1, end - start))

    def at(parts: Column, marks: Column) -> Column:
        """Where each mark begins, one running sum."""
        step = lambda t, x: F.struct((t["n"] + F.length(x["p"]) + F.length(x["m"])).alias("n"), F.array_append(t["at"], t["n"] + F.length(x["p"])).alias("at"))
        pairs = F.zip_with(F.slice(parts, F.lit(1), F.size(marks)), marks, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
        return F.aggregate(pairs, F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("at")), step, lambda t: t["at"])

    def all_parts(marks: Column) -> Column:
        one = lambda starts: F.transform(marks, lambda mark, k: X.let(F.get(starts, k), lambda start: part(mark, start, F.coalesce(F.get(starts, k + 1), F.length(body)))))
        return X.let(at(F.split(body, O.ORDINAL, -1), marks), one)

    return X.let(F.regexp_extract_all(body, F.lit(O.ORDINAL), F.lit(0)), all_parts)


def topic_parts(body: Column, ls: Column, promo: str | None = None) -> Column:
    """Without marks: first sentences of up to four paragraphs that open past 500 characters; the last has the whole body as section."""
    artifact = lambda s: F.contains(s, F.lit("Volume")) | (F.contains(F.lower(s), F.lit(promo)) if promo else F.lit(False))
    begin = F.struct(F.lit(False).alias("blank"), F.lit(0).alias("seen"), F.array().cast("array<int>").alias("at"))

    def step(t: Column, x: Column) -> Column:
        s, page = x["s"], F.regexp_like(x["s"], F.lit(r"^\d+$"))
        seen = t["seen"] + F.when(page | artifact(s), 0).otherwise(F.length(s))
        opens = t["blank"] & (F.length(s) > 50) & (seen > 500) & ~artifact(s) & ~page
        return F.struct(F.when(page, t["blank"]).otherwise(s == "").alias("blank"), seen.alias("seen"), F.when(opens, F.array_append(t["at"], x["i"])).otherwise(t["at"]).alias("at"))

    at = F.aggregate(F.transform(ls, lambda s, i: F.struct(i.alias("i"), O.strip(s).alias("s"))), begin, step, lambda t: t["at"])

    def sentence(i: Column) -> Column:
        first = lambda flat, end: F.when((end > 0) & (end <= 200), F.left(flat, end)).when(F.length(flat) > 150, O.complete_phrase(flat, 150)).otherwise(flat)
        return X.let(paragraph_from(ls, i), lambda flat: X.let(F.regexp_instr(flat, F.lit(r"[.!?]\s")), lambda end: first(flat, end)))

    found = F.slice(F.filter(F.transform(at, sentence), lambda s: F.length(s) > 20), 1, 4)
    one = lambda s, k, n: _part(F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV"))), k + 1), s, F.when(k + 1 == n, body).otherwise(F.lit("")))
    return X.let(found, lambda found: F.transform(found, lambda s, k: one(s, k, F.size(found))))


def paragraph_from(ls: Column, i: Column) -> Column:
    """The line at i and up to four more, until a blank one, as one line."""
    near = F.transform(F.slice(ls, i + 1, F.lit(5)), O.strip)
    own = lambda near: X.let(F.array_position(near, F.lit("")).cast("int"), lambda blank: F.when(blank > 0, F.slice(near, F.lit(1), blank - 1)).otherwise(near))
    return X.collapse(F.array_join(X.let(near, own), " "))


def with_divisions(docs: DataFrame, promo: str | None = None) -> DataFrame:
    """docs (doc_id, body and more) with divisions: an array of (numeral, heading, refs, section), by Roman numerals, else ordinals, else topic sentences."""
    text, ls, a, b, c = free_names(docs, "text_", "ls", "a", "b", "c")
    none = F.array().cast(NONE)
    body = F.coalesce("body", F.lit(""))
    rows = docs.withColumn(text, body).withColumn(ls, F.split(text, "\n", -1)).withColumn(a, roman_parts(F.col(ls)))
    rows = rows.withColumn(b, F.when(F.size(a) == 0, ordinal_parts(F.col(text))).otherwise(none))
    rows = rows.withColumn(c, F.when((F.size(a) == 0) & (F.size(b) == 0), topic_parts(F.col(text), F.col(ls), promo)).otherwise(none))
    one = lambda p: F.struct(p["numeral"].alias("numeral"), O.heading(p["text"], (promo,) if promo else ()).alias("heading"), F.slice(R.references(p["section"]), 1, 3).alias("refs"), p["section"].alias("section"))
    return rows.withColumn("divisions", F.transform(F.concat(a, b, c), one)).drop(text, ls, a, b, c)


def divisions(docs: DataFrame, promo: str | None = None) -> DataFrame:
    """(doc_id, pos, numeral, heading, refs, section) of documents (doc_id, body)."""
    return exploded(with_divisions(docs.select("doc_id", "body"), promo), F.col("divisions"), "p").select("doc_id", "pos", "p.numeral", "p.heading", "p.refs", "p.section")


def _first_of_prefix(found: Column, name: str, most: int) -> Column:
    """Of structs with an equal prefix of 25 characters in `name` the first, at most `most`; found is a column, not an expression."""
    heads = F.transform(found, lambda x: F.left(x[name], F.lit(25)))
    return F.slice(F.transform(F.array_distinct(heads), lambda h: F.get(F.filter(found, lambda x: F.left(x[name], F.lit(25)) == h), F.lit(0))), 1, most)


def with_illustrations(docs: DataFrame, most: int = 6, starters: str = O.ILLUSTRATION) -> DataFrame:
    """docs (body and more) with illustrations: an array of (pos, illustration), what the sentences that open an illustration are about, one for each prefix of 25 characters."""
    ls, found = free_names(docs, "ls", "found")
    opens = lambda x: (F.length(x) >= 30) & F.regexp_like(x, F.lit(starters))
    lines = F.transform(ls, lambda x, i: F.when(opens(O.strip(x)), F.struct(i.alias("pos"), O.strip(x).alias("line"), paragraph_from(F.col(ls), i).alias("t"))))
    at = lambda x: F.least(F.regexp_instr(x["line"], F.lit(starters)) - 1, F.length(x["t"]) - 1)
    marked = F.transform(F.filter(lines, lambda x: x.isNotNull()), lambda x: F.struct(x["pos"].alias("pos"), x["t"].alias("t"), at(x).alias("at")))

    def bounds(x: Column) -> Column:
        begin = F.length(F.regexp_extract(F.left(x["t"], x["at"] - 2), r"(?s)^(.+[.!?])", 1))
        end = F.regexp_instr(F.substring(x["t"], x["at"] + 2, F.length(x["t"])), F.lit("[.!?]"))
        return F.struct(x["pos"].alias("pos"), x["t"].alias("t"), begin.alias("begin"), F.when(end > 0, x["at"] + end + 1).otherwise(F.length(x["t"])).alias("end"))

    sentence = lambda x: F.struct(x["pos"].alias("pos"), O.strip(F.substring(x["t"], x["begin"] + 1, x["end"] - x["begin"])).alias("s"))
    about = F.transform(F.transform(F.transform(marked, bounds), sentence), lambda x: F.struct(x["pos"].alias("pos"), O.concept(x["s"]).alias("illustration")))
    rows = docs.withColumn(ls, F.split(F.coalesce("body", F.lit("")), "\n", -1)).withColumn(found, F.filter(about, lambda x: F.length(x["illustration"]) > 10))
    return rows.withColumn("illustrations", _first_of_prefix(F.col(found), "illustration", most)).drop(ls, found)


def illustrations(docs: DataFrame, most: int = 6, starters: str = O.ILLUSTRATION) -> DataFrame:
    """(doc_id, pos, illustration) of documents (doc_id, body)."""
    rows = with_illustrations(docs.select("doc_id", "body"), most, starters)
    return rows.select("doc_id", F.explode_outer("illustrations").alias("x")).where("x is not null").select("doc_id", "x.pos", "x.illustration")


def with_applications(docs: DataFrame, markers: str = O.APPLICATION, most: int = 4, promo: str | None = None) -> DataFrame:
    """docs (body and more) with applications: an array of (pos, application), marked sentences of 30 to 130 characters in the last third of the lines."""
    ls, found = free_names(docs, "ls", "found")
    third = F.floor(F.size(ls) / 3).cast("int")
    kept = F.filter(F.transform(F.slice(ls, F.size(ls) - third + 1, third), O.strip), lambda s: (s != "") & ~O.is_upper(s) & ~F.regexp_like(s, F.lit("^[0-9]+$")) & (~F.contains(F.lower(s), F.lit(promo)) if promo else F.lit(True)))
    marked = F.transform(X.sentences_simple(F.array_join(kept, " ")), lambda s, i: F.when(F.length(s).between(30, 130) & F.regexp_like(s, F.lit(markers)), F.struct(i.alias("pos"), X.cut_with_dots(s, 120, 117).alias("application"))))
    rows = docs.withColumn(ls, X.lines(F.coalesce("body", F.lit("")))).withColumn(found, F.filter(marked, lambda x: x.isNotNull()))
    return rows.withColumn("applications", _first_of_prefix(F.col(found), "application", most)).drop(ls, found)


def applications(docs: DataFrame, markers: str = O.APPLICATION, most: int = 4, promo: str | None = None) -> DataFrame:
    """(doc_id, pos, application) of documents (doc_id, body)."""
    rows = with_applications(docs.select("doc_id", "body"), markers, most, promo)
    return rows.select("doc_id", F.explode_outer("applications").alias("x")).where("x is not null").select("doc_id", "x.pos", "x.application")


def _wrap(batches: Iterator) -> Iterator:
    import textwrap

    for rows in batches:
        out = []
        for title, number, ref, when, parts, notes in zip(rows["title"], rows["number"], rows["reference"], rows["date_place"], rows["parts"], rows["notes"], strict=True):
            bullet = lambda s: textwrap.wrap(f"• {s}", 78, initial_indent="   ", subsequent_indent="     ")
            top = [title.upper(), f"Sermon #{number}", *([f"Scripture: {ref}"] if ref else []), *([f"Date/Location: {when}"] if when else []), "═" * 55, ""]
            if not len(parts):
                top += ["[No clear structural divisions detected]", ""]
            for p in parts:
                top += textwrap.wrap(f"{p['numeral']}. {p['heading']}", 78, subsequent_indent="     ")
                for s in p["points"]:
                    top += bullet(s)
                top += [*([f"   → Scripture: {'; '.join(p['refs'])}"] if len(p["refs"]) else []), ""]
            rule, under = "─" * 55, []
            for k, (name, values) in enumerate(zip(("Key Illustrations:", "Key Quotes:", "Application:"), notes, strict=True)):
                if len(values):
                    under += [name, *[line for v in values for line in bullet(f'"{v}"' if k == 1 else v)], *([""] if k < 2 else [])]
            lines = [*top, rule, *under, rule]
            if len(lines) > 60:
                room = 59 - len(top) - 1
                lines = [*top, rule, *under[:room], rule] if room > 0 else [*lines[:59], rule]
            out.append("\n".join(lines) + "\n")
        yield rows[["doc_id"]].assign(outline=out)


def long_enough(docs: DataFrame, least: int = 3) -> DataFrame:
    """The documents of at least three lines; others get no outline."""
    return docs.where(F.size(F.split("text", "\n", -1)) >= least)


def render(docs: DataFrame, quotes: DataFrame) -> DataFrame:
    """(doc_id, outline): at most 60 lines of 78 characters. docs: doc_id, title, number, text, body; quotes: doc_id, rank, sentence.

    Only the wrapping of lines is Python, over Arrow batches; illustrations and applications are made within a document's row, divisions and quotes are joined."""
    rows = with_applications(with_illustrations(docs, 3), most=2).withColumn("title", X.cut_with_dots(F.coalesce("title", F.lit("")), 78, 75))
    # points are made of rows: their steps name each other more than once, which only compiled code shares
    point = F.struct("pos", "numeral", "heading", O.subpoints(F.col("section")).alias("points"), F.slice("refs", 1, 2).alias("refs")).alias("v")
    parts = divisions(docs).where("pos < 5").select("doc_id", point).groupBy("doc_id").agg(F.array_sort(F.collect_list("v")).alias("parts"))
    rows = rows.join(parts, "doc_id", "left").withColumn("parts", F.coalesce("parts", F.array().cast(parts.schema["parts"].dataType)))
    rows = rows.withColumn("reference", O.opening_reference(F.col("text"))).withColumn("date_place", O.date_and_place(F.col("text"))).withColumn("date_place", X.cut_with_dots(F.col("date_place"), 64, 61))
    listed = quotes.groupBy("doc_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("rank", "sentence"))), 1, 3)["sentence"].alias("quoted"))
    empty = F.array().cast("array<string>")
    notes = F.array(F.col("illustrations")["illustration"], F.coalesce("quoted", empty), F.col("applications")["application"])
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    out = rows.join(listed, "doc_id", "left").select("doc_id", "title", blank("number"), blank("reference"), blank("date_place"), "parts", notes.alias("notes"))
    return out.mapInPandas(_wrap, out.select("doc_id").schema.add("outline", "string"))


def _core(word: Column) -> Column:
    return F.regexp_replace(word, r"[.,;:!?\"')\]}—–-]+$", "")


def join_broken_words(lines: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """lines with words that one blank broke joined again, from the left; words: column word, lower case.

    The dictionary stays a table: what stands in the lines (distinct words, and runs of up to PIECES pieces joined) is looked up by one join, and
    each distinct line meets the hits of its own pieces. The fold over a line is a column expression. A word of more than PIECES pieces or LONGEST characters stays broken."""
    line, found = free_names(lines, "line_text", "known")
    pieces = lines.select(F.col(column).alias(line)).distinct().select(line, F.split(line, " ", -1).alias("w"))
    pieces = pieces.select(line, F.posexplode_outer("w").alias("k", "x"), "w").where("k is not null")
    runs = F.filter(F.transform(F.sequence(F.lit(1), F.lit(PIECES)), lambda n: F.array_join(F.slice("w", F.col("k") + 1, n), "")), lambda s: F.length(s) <= LONGEST)
    asked = pieces.select(line, F.explode(F.array_distinct(F.transform(F.concat(runs, F.array("x")), lambda s: F.lower(_core(s))))).alias("word")).distinct()
    hits = asked.join(words.select("word").distinct(), "word", "left_semi").groupBy(line).agg(F.collect_set("word").alias(found))
    out = lines.join(hits, F.col(column) == F.col(line), "left").withColumn(found, F.coalesce(found, F.array().cast("array<string>")))
    known = lambda s: F.array_contains(found, F.lower(s))
    alpha = lambda s: F.regexp_like(s, F.lit(r"^\p{L}+$"))

    def step(done: Column, x: Column) -> Column:
        last, core = F.try_element_at(done, F.lit(-1)), _core(x)
        flanked = F.regexp_like(last, F.lit(r"\p{Ll}$")) & F.regexp_like(x, F.lit(r"^\p{Ll}"))
        broken = alpha(last) & alpha(core) & known(F.concat(last, core)) & (~(known(last) & known(core)) | (F.least(F.length(last), F.length(core)) <= 3))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.concat(last, x)))
        return F.when((F.size(done) > 0) & F.coalesce(flanked & broken, F.lit(False)), joined).otherwise(F.concat(done, F.array(x)))

    mended = F.array_join(F.aggregate(F.split(column, " ", -1), F.array().cast("array<string>"), step), " ")
    likely = F.regexp_like(column, F.lit(r"\p{Ll} \p{Ll}"))
    return out.withColumn(column, F.when(likely, mended).otherwise(F.col(column))).select(*[F.col(f"`{c}`") for c in lines.columns])


def clean_text(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, text) of documents (doc_id, text): lines that end in a hyphen joined to the next, then each line's broken words."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), X.dehyphenate(X.lines(F.col("text"))).alias("ls"))
    lines = rows.select("doc_id", "row", F.posexplode_outer("ls").alias("pos", "line"))
    mended = join_broken_words(lines, "line", words)
    # a group is one document
    return mended.groupBy("doc_id", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text")).select("doc_id", "text")


def layout_roles(lines: DataFrame, is_metadata: Column, margin: float | Column) -> DataFrame:
    """Layout lines (doc, line_no, text, size, x0) with role metadata, scripture or body. A line that opens a quotation starts the
    scripture, which ends at the next line of size 13.5; else the first large line near the margin that is no metadata starts the body."""
    s = O.strip(F.col("text"))
    no = F.col("line_no")
    large = F.when((s != "") & (F.col("size") >= 13.5), no)
    whole = Window.partitionBy("doc")
    rows = lines.withColumn("__q", F.min(F.when(F.regexp_like(s, F.lit("^[\"“”'‘’„]")), no)).over(whole))
    rows = rows.withColumn("__b", F.min(F.when(~is_metadata & (F.bround("x0", 0) <= margin + 20), large)).over(whole))
    quoted = F.col("__q").isNotNull() & (F.col("__b").isNull() | (F.col("__q") <= F.col("__b")))
    ends = F.coalesce(F.min(F.when(no >= F.col("__q"), large)).over(whole), F.max("line_no").over(whole) + 1)
    start = F.when(quoted, ends).otherwise(F.coalesce("__b", F.min("line_no").over(whole)))
    role = F.when(no >= F.col("__start"), "body").when(quoted & (no >= F.col("__q")) & (s != ""), "scripture").otherwise("metadata")
    return rows.withColumn("__start", start).withColumn("role", role).drop("__q", "__b", "__start")


def layout_html(lines: DataFrame, document: str, is_header=X.header_line, is_promo=X.promo_line, is_metadata=X.metadata_line) -> DataFrame:
    """(document, html): the page markup of each document's layout lines: the lines of the text, without the metadata that opens them, the opening
    quotation as a heading, paragraphs by their place on the page. lines: as layout_lines takes them, with x0, y1 and spans of text, italic, bold and size."""
    kept = layout_lines(lines, document, is_header, is_promo)
    kept = kept.join(layout_metrics(kept, document), document)
    number = F.row_number().over(Window.partitionBy(document).orderBy("page_no", "line_no"))
    rows = kept.select(F.col(document).alias("doc"), number.alias("line_no"), "x0", "y0", "y1", "text", "size", "margin", "spacing", "spans")
    rows = layout_roles(rows, is_metadata(F.btrim("text")), F.col("margin"))
    # scripture and body are marked side by side, so that their lines are made once
    marked = paragraph_islands(rows.where("role != 'metadata'"), F.col("margin"), F.col("spacing"), ("doc", "role"))
    head = F.col("role") == "scripture"
    marked = marked.select("doc", "line_no", F.when(head, F.lit(0)).otherwise(F.col("para_id")).alias("para_id"), F.when(head, "scripture").otherwise(F.col("kind")).alias("kind"), "spans")
    # a group is one paragraph, then one document
    paragraphs = marked.groupBy("doc", "para_id").agg(F.min("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("line_no", "spans"))).alias("ls"))
    paragraphs = paragraphs.select("doc", "para_id", "kind", F.transform("ls", lambda x: x["spans"]).alias("ls"))
    html = paragraphs.select("doc", "para_id", M.paragraph_html(F.col("kind"), F.col("ls")).alias("h"))
    whole = html.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("para_id", "h"))).alias("ps"))
    return whole.select(F.col("doc").alias(document), F.concat(F.array_join(F.transform("ps", lambda p: p["h"]), "\n"), F.lit("\n")).alias("html"))
