"""Parts of a document's outline as column expressions: phrases, headings, the head's date, place and reference, sub-points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions import references as R
from vellum.functions import text as X

# The patterns that mark parts of an outline.
ROMAN = r"^(I{1,3}V?|IV|V|VI{0,3})\.\s+(.+)$"
ORDINAL = r"(?im)^(?:First(?:ly)?,|Second(?:ly)?,|Third(?:ly)?,|Fourth(?:ly)?,|Fifth(?:ly)?,|In\s+the\s+(?:first|second|third|fourth|fifth)\s+place)"
ORDINALS = (("first", "I"), ("second", "II"), ("third", "III"), ("fourth", "IV"), ("fifth", "V"))
ARTIFACTS = (r"Volume\s+\d+", r"Sermons?\s+#[\d,\s]+")
TRANSITION = (
    r"(?i)^(?:Having\s+(?:thus\s+)?(?:shown|said|considered|noticed|noted|observed)\s+.*?,\s*(?:we\s+)?(?:pass\s+on\s+to|now\s+(?:come|turn)\s+to|(?:shall|will|let\s+us)\s+(?:now\s+)?(?:consider|notice|observe))\s*"
    r"|We\s+(?:now\s+)?(?:come|turn|proceed|pass)\s+(?:on\s+)?to\s+|(?:Let\s+us|I\s+shall)\s+(?:now\s+)?(?:consider|notice|observe|examine)\s+|(?:Now|Next|Then)[,\s]+(?:we\s+)?(?:come|turn|proceed|pass)\s+(?:on\s+)?to\s+)"
)
CLAUSE_END = r"[.;:—]|\s+(?:which|that|where|when|who|because|since|for\s)"
CAPS_PHRASE = r"[A-Z][A-Z\s,'\"\-‘’“”]{8,}"
ILLUSTRATION = (
    r"(?i)\b(?:suppose|imagine|picture|consider\s+the\s+case|I\s+remember|A\s+certain\s+man|A\s+certain\s+woman|let\s+me\s+illustrate|by\s+way\s+of\s+illustration|there\s+was\s+once|there\s+is\s+a\s+story|I\s+have\s+heard|I\s+have\s+read"
    r"|an?\s+(?:old|young|poor|rich|good|certain)\s+(?:man|woman|farmer|soldier|king|sailor)|like\s+a\s+(?:man|ship|soldier|tree|river|fountain|bird)|as\s+if|as\s+though|it\s+is\s+as\s+when|it\s+is\s+like|just\s+as)\b"
)
CONCEPTS = (
    r"(?i)(?:suppose|imagine|picture|consider)\s+(.+?)(?:[,;.]|\s+and\s+)",
    r"(?i)((?:a|an)\s+(?:\w+\s+)?(?:man|woman|farmer|soldier|king|sailor|traveler|traveller|boy|girl|child|person|merchant|beggar)\s+[^,.;]{5,})",
    r"(?i)I\s+(?:remember|have\s+heard|have\s+read)\s+(.+?)(?:[,;.])",
)
APPLICATION = (
    r"(?i)\b(?:let\s+us|let\s+me\s+(?:urge|beseech|entreat|exhort)|I\s+(?:beseech|entreat|urge|exhort)\s+you|may\s+(?:God|the\s+Lord)|go\s+(?:home|away|forth)\s+and|(?:come|turn|fly|flee)\s+to\s+(?:Christ|Jesus|God|the\s+Saviour)"
    r"|believe\s+(?:on|in)\s+(?:Him|Christ|Jesus|the\s+Lord)|trust\s+(?:in\s+)?(?:Him|Christ|Jesus|God)|repent|receive\s+(?:Him|Christ))\b"
)
STRONG_WORDS = ("Christ", "Jesus", "God", "grace", "salvation", "faith", "cross", "blood", "eternal", "glory", "redemption", "sovereign", "mercy", "gospel", "heaven", "hell", "justified", "sanctified", "atone", "atonement", "resurrection", "Saviour", "Savior", "Redeemer", "Lord", "Spirit", "Holy")
MONTHS = "JANUARY|FEBRUARY|MARCH|APRIL|MAY|JUNE|JULY|AUGUST|SEPTEMBER|OCTOBER|NOVEMBER|DECEMBER"


def strip(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def is_upper(s: Column) -> Column:
    """At least one capital and no small letter."""
    return F.regexp_like(s, F.lit(r"\p{Lu}")) & ~F.regexp_like(s, F.lit(r"\p{Ll}"))


def some(s: Column) -> Column:
    return X.let(s, lambda s: F.when(s != "", s))


def upper_first(s: Column) -> Column:
    return X.let(s, lambda s: F.concat(F.upper(F.left(s, F.lit(1))), F.substring(s, F.lit(2), F.length(s))))


def title_words(s: Column) -> Column:
    """Every run of letters capitalised, wherever it starts."""
    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit(r"\p{L}+|\P{L}+"), F.lit(0)), X.capitalise), "")


def complete_phrase(text: Column, n: int = 75) -> Column:
    """The first sentence if it ends within n characters; else what precedes the last clause mark past the middle, or a word boundary."""
    def clause(cut: Column) -> Column:
        def marked(back: Column) -> Column:
            out = None
            for mark in ("; ", ", ", " -- ", " - "):
                at = F.locate(mark[::-1], back)
                last = n - at - len(mark) + 1  # characters before the last mark
                hit = (at > 0) & (last > n // 2)
                out = F.when(hit, strip(F.left(cut, last))) if out is None else out.when(hit, strip(F.left(cut, last)))
            return out.otherwise(cut)

        return X.let(F.reverse(cut), marked)

    def phrase(flat: Column) -> Column:
        closed = lambda end: F.when((end > 0) & (end <= n + 1), F.left(flat, end)).when(F.length(flat) <= n, flat).otherwise(X.let(F.left(flat, F.lit(n)), clause))
        return X.let(F.regexp_instr(F.left(flat, F.lit(n + 5)), F.lit(r"[.!?](?:\s|$)")), closed)

    return X.let(X.collapse(text), phrase)


def heading(text: Column, promo: tuple[str, ...] = ()) -> Column:
    """A short heading of a division: its phrase in capitals if it has one, else its topic up to the first clause end."""
    for p in (*promo, *ARTIFACTS):
        text = F.regexp_replace(text, p, "")

    def short(flat: Column) -> Column:
        caps = strip(F.regexp_replace(strip(F.regexp_extract(flat, CAPS_PHRASE, 0)), ",+$", ""))
        clause = lambda topic: X.let(F.regexp_instr(topic, F.lit(CLAUSE_END)), lambda end: F.when(end > 6, strip(F.left(topic, end - 1))).otherwise(topic))
        topic = X.let(F.coalesce(some(strip(F.regexp_replace(flat, TRANSITION, ""))), flat), clause)
        topic = F.regexp_replace(F.regexp_replace(topic, r"(?i)^(?:and|but|or|now|then|next|also)[,\s]+", ""), r"[,\s]+$", "")
        return F.when(F.regexp_like(flat, F.lit(CAPS_PHRASE)), X.phrase_trim(title_words(caps), 58)).otherwise(X.phrase_trim(X.title_case(topic), 58))

    return X.let(X.collapse(text), short)


def head_lines(text: Column, n: int) -> Column:
    return F.transform(F.slice(X.lines(text), 1, n), strip)


def date_and_place(text: Column) -> Column:
    """"occasion, date; place" from the first 15 lines, or ''; the last line that gives a part wins."""
    tail = lambda s: F.regexp_replace(strip(s), ",+$", "")
    start = F.struct(F.lit("").alias("date"), F.lit("").alias("place"))

    def step(t: Column, line: Column) -> Column:
        date = F.coalesce(some(tail(F.regexp_extract(line, rf"(?i)(?:DELIVERED|PREACHED)\s+ON\s+.*?,\s*((?:{MONTHS})\s+\d+,?\s*\d{{4}})", 1))), t["date"])
        occasion = tail(F.regexp_extract(line, rf"(?i)(?:DELIVERED|PREACHED)\s+ON\s+(.*?),\s*(?:{MONTHS})", 1))
        place = F.coalesce(some(strip(F.regexp_extract(line, r"(?i)^AT\s+(.+?)\.?\s*$", 1))), t["place"])
        return F.struct(F.concat_ws(", ", some(occasion), some(date)).alias("date"), place.alias("place"))

    return F.aggregate(head_lines(text, 15), start, step, lambda t: F.concat_ws("; ", some(t["date"]), some(t["place"])))


def opening_reference(text: Column) -> Column:
    """The first reference on a line after the one that opens a quotation, among 25; else the first of all; else ''."""
    found = F.transform(head_lines(text, 25), lambda x: F.struct(x.startswith('"').alias("q"), F.coalesce(F.get(R.references(x), F.lit(0)), F.lit("")).alias("ref")))
    first = lambda a: F.get(F.filter(F.transform(a, lambda x: x["ref"]), lambda r: r != ""), F.lit(0))
    opens = lambda found: F.array_position(F.transform(found, lambda x: x["q"]), F.lit(True)).cast("int")
    after = lambda found: X.let(opens(found), lambda at: F.when(at > 0, first(F.slice(found, at + 1, F.lit(25)))))
    return F.coalesce(X.let(found, lambda found: F.coalesce(after(found), first(found))), F.lit(""))


def body_start(text: Column) -> Column:
    """Index of the first body line after a reference, among 30 lines; else 10, or the last line."""
    marks = F.transform(head_lines(text, 30), lambda x, i: F.struct(i.alias("i"), (F.size(R.references(x)) > 0).alias("ref"), ((x != "") & ~x.startswith("NO.") & ((F.length(x) > 40) | (F.regexp_like(x, F.lit(r"^\p{Lu}")) & ~is_upper(x)))).alias("body")))
    first = F.get(F.filter(marks, lambda m: m["ref"]), F.lit(0))["i"]
    after = F.get(F.filter(marks, lambda m: ~m["ref"] & m["body"] & (m["i"] > first)), F.lit(0))["i"]
    return F.coalesce(after, F.least(F.lit(10), F.size(X.lines(text)) - 1))


def distinct_prefix(values: Column, n: int) -> Column:
    """The first of the values that share their first n characters, in order."""
    return X.let(values, lambda values: F.filter(values, lambda x, i: ~F.exists(F.slice(values, F.lit(1), i), lambda y: F.left(y, F.lit(n)) == F.left(x, F.lit(n)))))


def subpoints(section: Column, strong: tuple[str, ...] = STRONG_WORDS, most: int = 3, promo: tuple[str, ...] = ()) -> Column:
    """Numbered points of a section; without any, first sentences of its later paragraphs that hold a strong word."""
    text = section
    for p in (*promo, *ARTIFACTS, r"(?m)^\s*\d+\s*$"):
        text = F.regexp_replace(text, p, "")
    text = F.regexp_replace(text, "  +", " ")
    mark = r"(?:^|\n)\s*\d+\.\s+(?=[A-Z])"

    def points(text: Column) -> Column:
        parts, marks = F.split(text, mark, -1), F.regexp_extract_all(text, F.lit(mark), F.lit(0))
        rest = lambda values: X.let(values, lambda v: F.slice(v, F.lit(2), F.size(v) + 1))
        inter = F.zip_with(rest(parts), rest(marks), lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
        near = lambda inter: F.transform(inter, lambda x, i: complete_phrase(F.left(F.array_join(F.slice(inter, i + 1, F.lit(8)), ""), F.lit(1000)), 75))
        return F.filter(X.let(inter, near), lambda x: F.length(x) > 15)

    def closing(text: Column) -> Column:
        paragraphs = F.filter(F.transform(F.slice(F.split(text, r"\n\s*\n", -1), F.lit(2), F.length(text) + 1), X.collapse), lambda p: F.length(p) >= 40)
        first = F.filter(F.transform(paragraphs, lambda p: F.left(p, F.regexp_instr(p, F.lit(r"[.!?]\s")))), lambda s: F.length(s).between(22, 150) & F.regexp_like(s, F.lit(rf"(?i)\b(?:{'|'.join(strong)})\b")))
        return distinct_prefix(F.transform(first, lambda s: F.when(F.length(s) > 75, complete_phrase(s, 75)).otherwise(s)), 25)

    either = lambda text: X.let(points(text), lambda numbered: F.when(F.size(numbered) > 0, numbered).otherwise(closing(text)))
    return F.slice(X.let(text, either), 1, most)


def trailing_topic(text: Column) -> Column:
    """The last part between commas or semicolons of over five characters, at most 40; or ''."""
    parts = F.filter(F.transform(F.split(text, "[,;]", -1), strip), lambda p: F.length(p) > 5)
    return F.coalesce(X.phrase_trim(F.try_element_at(parts, F.lit(-1)), 40), F.lit(""))


def concept(sentence: Column) -> Column:
    """What an illustrating sentence is about: its likeness and topic, or its scene, person or story; else the trimmed sentence."""
    like = r"(?i)(?:like|as)\s+(?:a|an|the)\s+([^,.;]+)"
    likeness = X.phrase_trim(strip(F.regexp_extract(sentence, like, 0)), 50)
    topic = trailing_topic(strip(F.regexp_replace(F.regexp_replace(strip(F.left(sentence, F.regexp_instr(sentence, F.lit(like)) - 1)), ",+$", ""), "-+$", "")))
    out = F.when(F.regexp_like(sentence, F.lit(like)), F.when(F.length(topic) > 5, F.concat(likeness, F.lit(" -- "), X.title_case(topic))).otherwise(X.capitalise(likeness)))
    for p in CONCEPTS:
        out = out.when(F.regexp_extract(sentence, p, 1) != "", upper_first(X.phrase_trim(strip(F.regexp_extract(sentence, p, 1)), 55)))
    return out.otherwise(X.phrase_trim(sentence, 75))


def escape_ascii(json: Column) -> Column:
    r"""Characters beyond ASCII as \uXXXX, those beyond the basic plane as two."""
    def one(c: Column) -> Column:
        code = F.ascii(c)
        low = lambda v: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(v), 4, "0")))
        pair = F.concat(low(F.lit(0xD800) + F.shiftright(code - 0x10000, 10)), low(F.lit(0xDC00) + (code - 0x10000).bitwiseAND(F.lit(1023))))
        return F.when(code < 128, c).when(code < 0x10000, low(code)).otherwise(pair)

    return F.array_join(F.transform(F.regexp_extract_all(json, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), F.lit(0)), one), "")
