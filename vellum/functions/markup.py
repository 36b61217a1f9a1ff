"""Speech and page markup as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import references as R
from vellum.functions import text as X
from vellum.functions.lexicons import KEEP_UPPER, PRONUNCIATIONS

# Lines that a document's head may hold between its title and its body.
HEADER_LINES = (r"^\s*$", r"^[A-Z][A-Z\s,;:'\-—.!?&]+\s*$", r"(?i)^NO\.\s*\d+", r"(?i)^A SERMON DELIVERED", r"(?i)^A SERMON\s*,?\s*PREACHED", r"(?i)^DELIVERED ON", r"(?i)^AT\s+(THE\s+)?[A-Z]", r"(?i)^ON\s+(LORD['’]?S[- ]DAY|SABBATH|SUNDAY|THURSDAY)")


def header_lines(author: str | None = None) -> tuple[str, ...]:
    return HEADER_LINES + ((rf"(?i)^BY\s+(THE\s+REV\.\s+)?{re.escape(author)}",) if author else ())


def title_and_body(text: Column, headers: tuple[str, ...] = HEADER_LINES) -> Column:
    """struct(title, number, body): a number stands on the first non-blank line of the next four, bare or after "No."; then
    header lines are skipped."""
    raw = F.split(text, "\n", -1)
    bare = F.transform(raw, lambda x: F.btrim(x, F.lit(" \t\r\n\f\x0b")))
    near = F.transform(F.slice(bare, 2, 4), lambda x, i: F.struct((i + 1).alias("i"), x.alias("s")))
    second = F.get(F.filter(near, lambda x: x["s"] != ""), F.lit(0))
    number = F.coalesce(F.nullif(F.regexp_extract(second["s"], r"^(\d+)$", 1), F.lit("")), F.nullif(F.regexp_extract(second["s"], r"^[Nn][Oo]\.?\s*(\d+)", 1), F.lit("")))
    start = F.when(number.isNotNull(), second["i"] + 1).otherwise(F.lit(1))
    header = lambda s: F.regexp_like(s, F.lit("|".join(f"(?:{p})" for p in headers)))
    # slices, not conditions inside the lambdas, so that each search runs once over the lines
    rest = F.slice(bare, start + 1, F.size(raw))
    skipped = F.get(F.filter(F.transform(rest, lambda x, i: F.when(~header(x), i)), lambda i: i.isNotNull()), F.lit(0))
    body = F.array_join(F.slice(raw, start + F.coalesce(skipped, F.size(rest)) + 1, F.size(raw)), "\n")
    return F.struct(F.get(bare, F.lit(0)).alias("title"), number.alias("number"), body.alias("body"))


def with_title_and_body(docs: DataFrame, headers: tuple[str, ...] = HEADER_LINES) -> DataFrame:
    """(doc_id, text, title, number, body) as title_and_body tells them, each step a column of its own, since later ones name it more than once."""
    ends = F.lit(" \t\r\n\f\x0b")
    rows = docs.select("doc_id", "text", F.split("text", "\n", -1).alias("raw")).select("doc_id", "text", "raw", F.transform("raw", lambda x: F.btrim(x, ends)).alias("bare"))
    near = F.transform(F.slice("bare", 2, 4), lambda x, i: F.struct((i + 1).alias("i"), x.alias("s")))
    rows = rows.select("*", F.get(F.filter(near, lambda x: x["s"] != ""), F.lit(0)).alias("second"))
    number = F.coalesce(F.nullif(F.regexp_extract("second.s", r"^(\d+)$", 1), F.lit("")), F.nullif(F.regexp_extract("second.s", r"^[Nn][Oo]\.?\s*(\d+)", 1), F.lit("")))
    rows = rows.select("*", number.alias("number")).select("*", F.when(F.col("number").isNotNull(), F.col("second.i") + 1).otherwise(F.lit(1)).alias("start"))
    header = lambda s: F.regexp_like(s, F.lit("|".join(f"(?:{p})" for p in headers)))
    body = F.transform(F.slice("bare", F.col("start") + 1, F.size("raw")), lambda x: ~header(x))
    rows = rows.select("*", F.array_position(body, F.lit(True)).cast("int").alias("first"))
    kept = F.when(F.col("first") > 0, F.slice("raw", F.col("start") + F.col("first"), F.size("raw"))).otherwise(F.array().cast("array<string>"))
    return rows.select("doc_id", "text", F.get("bare", F.lit(0)).alias("title"), "number", F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias("body"))


#: Stand for the ends of paragraphs and of sentences while a body is one string.
_PARAGRAPH, _SENTENCE = "\u0001", "\u0002"


#: A spoken mark with what it holds, or any tag.
_WHOLE_MARKS = "<sub[^>]*>[^<]*</sub>|<phoneme[^>]*>[^<]*</phoneme>|<[^>]*>"


def marked_body(body: Column, compat: bool = True) -> Column:
    """The body as one string, in which marks stand for the ends of paragraphs and sentences; without compat no sentence ends inside
    what a tag marks."""
    flat = F.replace(F.replace(F.translate(body, "\u0001\u0002", ""), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    flat = F.regexp_replace(F.regexp_replace(flat, r"\n\s*\n", _PARAGRAPH), X._UNEVEN, " ")
    flat = F.regexp_replace(F.regexp_replace(flat, " ?(?:\u0001 ?)+", _PARAGRAPH), "^[\u0001 ]+|[\u0001 ]+$", "")
    ends = lambda t: F.regexp_replace(t, r'([.!?])(?:\s*")?\s+(?=[A-Z0-9"“])', f"$1{_SENTENCE}")
    return ends(flat) if compat else X.outside_tags(flat, ends, _WHOLE_MARKS)


def pauses(marked: Column, compat: bool = True) -> Column:
    """A pause after each comma, semicolon or colon that a blank follows, outside tags; without compat not inside what a tag marks, nor
    after the semicolon of an escaped character."""
    if compat:
        return X.comma_breaks(marked)
    return X.outside_tags(marked, lambda p: F.regexp_replace(p, "(?<!&amp(?=;)|&lt(?=;)|&gt(?=;))([,;:]) ", '$1<break time="400ms"/> '), _WHOLE_MARKS)


def speech(title: Column, number: Column, marked: Column) -> Column:
    """A spoken document: title, number if there is one, paragraphs of sentences with pauses; marked: as marked_body gives it, with pauses."""
    middle = F.replace(F.replace(marked, F.lit(_SENTENCE), F.lit('</s>\n<break time="750ms"/>\n<s>')), F.lit(_PARAGRAPH), F.lit('</s>\n</p>\n\n<break time="1200ms"/>\n\n<p>\n<s>'))
    middle = F.when(marked != "", F.concat(F.lit("<p>\n<s>"), middle, F.lit("</s>\n</p>\n"))).otherwise(F.lit(""))
    head = F.concat(F.lit('<speak>\n<prosody rate="slow" pitch="-8%" volume="soft">\n\n<p>\n<s><emphasis level="strong">'), title, F.lit('</emphasis></s>\n<break time="1500ms"/>\n</p>\n\n'))
    numbered = F.when(number.isNotNull(), F.concat(F.lit('<p>\n<s><sub alias="Sermon number '), number, F.lit('">No. '), number, F.lit('</sub>.</s>\n<break time="1200ms"/>\n</p>\n\n'))).otherwise(F.lit(""))
    return F.concat(head, numbered, middle, F.lit("\n</prosody>\n</speak>\n"))


def spoken_documents(docs: DataFrame, lexicon=PRONUNCIATIONS, books=R.BOOKS, headers: tuple[str, ...] = HEADER_LINES, keep: tuple[str, ...] = KEEP_UPPER, compat: bool = True) -> DataFrame:
    """(doc_id, ssml) of documents (doc_id, text): title and body, capitals of the body, escaping, references, pronunciations, markup.

    compat keeps the quirks that results must equal: sentences end and pauses stand inside marks, and after escaped characters. Each step is a column of its own, since the next names it more than once. No shuffle."""
    rows = with_title_and_body(docs, headers).select("doc_id", "title", "number", "body")
    rows = rows.withColumn("body", X.caps_to_title(F.col("body"), leading=True)).withColumn("body", X.caps_to_title(F.col("body"), keep))
    for step in (X.xml_escape, lambda s: R.expand_references(s, books), lambda s: pronounce(s, lexicon)):
        rows = rows.withColumn("title", step(F.col("title"))).withColumn("body", step(F.col("body")))
    rows = rows.withColumn("body", marked_body(F.col("body"), compat)).withColumn("body", pauses(F.col("body"), compat))
    return rows.select("doc_id", speech(F.col("title"), F.col("number"), F.col("body")).alias("ssml"))


def spans_html(spans: Column) -> Column:
    """Spans of (text, italic, bold): nested tags, spans of white space left bare."""
    def one(s: Column) -> Column:
        text = X.html_escape(s["text"])
        inner = F.when(s["italic"], F.concat(F.lit("<em>"), text, F.lit("</em>"))).otherwise(text)
        return F.when(F.btrim(s["text"]) == "", text).when(s["bold"], F.concat(F.lit("<strong>"), inner, F.lit("</strong>"))).otherwise(inner)

    return F.array_join(F.transform(spans, one), "")


def join_lines(lines: Column) -> Column:
    """The spans of several lines as one array: a line that ends in a small letter and a hyphen joins the next if that opens with a
    small letter, all others meet at a span of one blank."""
    span = "array<struct<text:string,italic:boolean,bold:boolean>>"
    lean = F.transform(lines, lambda line: F.transform(line, lambda s: F.struct(s["text"].alias("text"), s["italic"].alias("italic"), s["bold"].alias("bold"))))
    blank = F.array(F.struct(F.lit(" ").alias("text"), F.lit(False).alias("italic"), F.lit(False).alias("bold"))).cast(span)

    def step(out: Column, line: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        tail = F.regexp_replace(last["text"], r"\s+$", "")
        broken = F.regexp_like(tail, F.lit(r"\p{Ll}-$")) & F.regexp_like(F.get(line, F.lit(0))["text"], F.lit(r"^\s*\p{Ll}"))
        cut = F.struct(F.left(tail, F.length(tail) - 1).alias("text"), last["italic"].alias("italic"), last["bold"].alias("bold"))
        joined = F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(cut), line)
        return F.when((F.size(out) == 0) | (F.size(line) == 0), F.concat(out, line)).when(broken, joined).otherwise(F.concat(out, blank, line))

    return F.aggregate(lean, F.array().cast(span), step)


def text_fixes(html: Column, keep: tuple[str, ...] = KEEP_UPPER) -> Column:
    """Capitals mended between the tags of page markup."""
    return X.outside_tags(html, lambda p: X.fix_caps(p, keep), "<[^>]+>")


def paragraph_html(kind: Column, lines: Column) -> Column:
    """A paragraph of lines (arrays of spans) by its kind: scripture, verse, blockquote or body. Verse keeps its lines."""
    ends = F.lit(" \t\r\n\f\x0b")
    whole = F.btrim(text_fixes(X.rejoin_hyphen(X.merge_tags(spans_html(join_lines(lines))))), ends)
    verse = F.array_join(F.transform(lines, lambda line: F.btrim(text_fixes(X.merge_tags(spans_html(line))), ends)), "<br>\n")
    tagged = lambda tag, inner: F.concat(F.lit(f"<{tag}>"), inner, F.lit(f"</{tag}>"))
    return F.when(kind == "scripture", tagged("h2", whole)).when(kind == "verse", F.concat(F.lit('<div class="verse">'), verse, F.lit("</div>"))).when(kind == "blockquote", tagged("blockquote", whole)).otherwise(tagged("p", whole))


def pronounce(text: Column, lexicon: tuple[tuple[str, str, bool], ...] = PRONUNCIATIONS) -> Column:
    """Names of (name, ipa, case matters) as <phoneme> outside tags, longest first; a name inside a mark already set is left alone. Names
    that differ in case only must be given once."""
    if not lexicon:
        return text
    alternatives = {True: [], False: []}
    for name, _, case in sorted(lexicon, key=lambda x: -len(x[0])):
        alternatives[case].append(re.escape(name))
    names = "|".join(f"(?{'' if case else 'i'}:{'|'.join(x)})" for case, x in alternatives.items() if x)
    pattern = rf"(?U)<phoneme[^>]*>[^<]*</phoneme>|<[^>]*>|(?<![\w</])(?:{names})(?![\w>])"
    sounds = F.create_map(*[F.lit(x) for name, ipa, case in lexicon for x in (name if case else name.lower(), ipa)])
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sound = lambda m: F.coalesce(F.try_element_at(sounds, m), F.try_element_at(sounds, F.lower(m)), F.lit(""))
    mark = lambda m: F.when(m.startswith("<"), m).otherwise(F.concat(F.lit('<phoneme alphabet="ipa" ph="'), sound(m), F.lit('">'), m, F.lit("</phoneme>")))
    said = F.array_join(F.zip_with(parts, F.transform(found, mark), lambda p, m: F.concat(F.coalesce(p, F.lit("")), F.coalesce(m, F.lit("")))), "")
    return F.when(F.regexp_like(text, F.lit(f"(?U){names}")), said).otherwise(text)


def speech_stats(ssml: Column) -> Column:
    """struct of counts: paragraphs, sentences, breaks, aliases, and the milliseconds of all breaks."""
    pauses = F.regexp_extract_all(ssml, F.lit(r'<break time="(\d+)ms"/>'), F.lit(1))
    count = lambda tag: F.regexp_count(ssml, F.lit(tag))
    total = F.aggregate(pauses, F.lit(0).cast("long"), lambda t, p: t + p.cast("long"))
    return F.struct(count(r"<p>").alias("paragraphs"), count(r"<s>").alias("sentences"), F.size(pauses).alias("breaks"), count(r"<sub ").alias("aliases"), total.alias("pause_ms"))
