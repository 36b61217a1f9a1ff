"""Scalar text functions as Spark column expressions. Patterns are prefixed (?U) where Unicode classes are meant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.lexicons import KEEP_UPPER

# Words that stay in lower case inside a heading.
SMALL_WORDS = ("a", "an", "the", "and", "but", "or", "nor", "for", "yet", "so", "in", "on", "at", "to", "by", "of", "up", "as", "is", "if", "it", "be", "we", "us", "no")
# Words that may not end a trimmed phrase.
DANGLING = "a|an|the|and|but|or|of|in|on|at|to|by|for|with|from|as|is|are|was|were|that|which|this"


def let(value: Column, body) -> Column:
    """body of value, which is computed once however often body names it: Spark computes what is named twice inside a lambda twice."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def capitalise(word: Column) -> Column:
    """First character upper (a sharp s becomes Ss), the rest lower."""
    first = F.left(word, F.lit(1))
    return F.concat(F.when(first == "ß", "Ss").otherwise(F.upper(first)), F.lower(F.substring(word, F.lit(2), F.length(word))))


#: White space that is not a single blank: only that needs replacing.
_UNEVEN = r"[\t\n\x0B\f\r]\s*| \s+"


def collapse(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, _UNEVEN, " "))


def nonempty(values: Column) -> Column:
    return F.filter(values, lambda v: v != "")


def lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n", -1)


def first_line(text: Column) -> Column:
    return F.btrim(F.substring_index(text, "\n", 1))


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, white space collapsed."""
    return nonempty(F.transform(F.split(F.regexp_replace(text, "\r\n?", "\n"), r"\n\s*\n", -1), collapse))


def sentences(text: Column) -> Column:
    """Sentences before a capital, digit or opening quote; a closing quote at the cut goes with the separator."""
    return nonempty(F.transform(F.split(collapse(text), r'(?<=[.!?])(?:\s*")?\s+(?=[A-Z0-9"“])', -1), lambda s: F.btrim(s)))


def sentences_simple(text: Column) -> Column:
    """Sentences before an ASCII capital."""
    return nonempty(F.transform(F.split(collapse(text), r"(?<=[.!?])\s+(?=[A-Z])", -1), lambda s: F.btrim(s)))


def xml_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def html_escape(text: Column) -> Column:
    for a, b in (('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(xml_escape(text) if a == '"' else text, F.lit(a), F.lit(b))
    return text


def outside_tags(text: Column, change, tag: str = "<[^>]*>") -> Column:
    """change applied to the stretches between <...> tags; the tags stay."""
    def changed(text: Column) -> Column:
        parts, tags = F.split(text, tag, -1), F.regexp_extract_all(text, F.lit(f"({tag})"), F.lit(1))
        joined = F.array_join(F.zip_with(F.transform(parts, change), tags, lambda p, t: F.concat(F.coalesce(p, F.lit("")), F.coalesce(t, F.lit("")))), "")
        return F.when(F.contains(text, F.lit("<")), joined).otherwise(change(text))

    return let(text, changed)


def comma_breaks(text: Column) -> Column:
    """A pause after each comma, semicolon or colon that a space follows, outside tags. One pass marks tags and pauses alike, the marks of
    tags go again: no text is taken apart."""
    marked = F.regexp_replace(text, "(<[^>]*>)|([,;:]) ", "$1$2\ufdd0")
    return F.replace(F.replace(marked, F.lit(">\ufdd0"), F.lit(">")), F.lit("\ufdd0"), F.lit('<break time="400ms"/> '))


def title_case(text: Column) -> Column:
    words = nonempty(F.split(F.btrim(text), r"\s+"))
    return F.array_join(F.transform(words, lambda w, i: F.when((i == 0) | ~F.lower(w).isin(*SMALL_WORDS), capitalise(w)).otherwise(F.lower(w))), " ")


def phrase_trim(text: Column, n: int) -> Column:
    """At most n characters, cut at the last space past the middle, without a dangling word or separators at the end."""
    def shorter(cut: Column) -> Column:
        last = lambda back: F.when((back > 0) & (n - back > n // 2), F.left(cut, n - back)).otherwise(cut)  # noqa: E731 - back: the last space, from the end
        return let(F.locate(" ", F.reverse(cut)), last)

    bare = lambda text: F.regexp_replace(let(F.left(text, F.lit(n)), shorter), rf"(?i)\s+(?:{DANGLING})\s*$", "")
    return let(text, lambda text: F.when(F.length(text) <= n, text).otherwise(F.regexp_replace(bare(text), "[ ,;:-]+$", "")))


def cut_with_dots(text: Column, n: int, kept: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(kept)), F.lit("..."))).otherwise(text)


def pascal_case(title: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(title, "[—–-]", " "), r"(?U)[^\w\s]", "")
    return F.array_join(F.transform(nonempty(F.split(F.btrim(bare), r"(?U)\s+")), capitalise), "")


def numbered_name(number: Column, title: Column, suffix: str = ".txt") -> Column:
    return F.concat(F.format_string("%04d_%s", number, pascal_case(title)), F.lit(suffix))


def caps_to_title(text: Column, keep: tuple[str, ...] = (), leading: bool = False) -> Column:
    """Words of two or more ASCII capitals before white space become capitalised, unless kept; leading: only those that open a line."""
    pattern = r"(?md)^[A-Z]{2,}(?=\s)" if leading else r"(?<![\p{L}\p{N}_])[A-Z]{2,}(?=\s)"

    def fixed(text: Column) -> Column:
        parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
        changed = F.transform(found, lambda w: F.when(w.isin(*keep), w).otherwise(capitalise(w)) if keep else capitalise(w))
        joined = F.array_join(F.zip_with(parts, changed, lambda p, w: F.concat(F.coalesce(p, F.lit("")), F.coalesce(w, F.lit("")))), "")
        return F.when(F.regexp_like(text, F.lit(pattern)), joined).otherwise(text)

    return let(text, fixed)


def fix_caps(text: Column, keep: tuple[str, ...] = KEEP_UPPER) -> Column:
    """Words in capitals that open a line become capitalised, kept ones too; then all others but the kept ones."""
    return caps_to_title(caps_to_title(text, leading=True), keep)


def rejoin_hyphen(html: Column) -> Column:
    return F.regexp_replace(html, r"([a-z])-\s+([a-z])", "$1$2")


def merge_tags(html: Column) -> Column:
    """Tags that close and open again at once are dropped with the white space between them."""
    return F.regexp_replace(F.regexp_replace(html, r"</em>\s*<em>", ""), r"</strong>\s*<strong>", "")


def prosody_inner(ssml: Column) -> Column:
    """The markup without its prosody wrapper; all else stays."""
    return F.regexp_replace(ssml, "<prosody[^>]*>|</prosody>", "")


def dehyphenate(values: Column) -> Column:
    """Lines that end in a hyphen join the next line once; a joined line takes no third."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(True).alias("joined"))

    def step(t: Column, line: Column) -> Column:
        last = F.element_at(t["out"], -1)
        join = ~t["joined"] & F.regexp_like(F.coalesce(last, F.lit("")), F.lit("[A-Za-z]-$"))
        merged = F.concat(F.slice(t["out"], F.lit(1), F.greatest(F.size(t["out"]) - 1, F.lit(0))), F.array(F.concat(F.regexp_replace(last, "-$", ""), F.ltrim(line))))
        return F.struct(F.when(join, merged).otherwise(F.concat(t["out"], F.array(line))).alias("out"), join.alias("joined"))

    return F.aggregate(values, start, step, lambda t: t["out"])


def bookmark_numbers(title: Column) -> Column:
    """struct(nums, title) of an outline entry "12, 13 - Title.", or null when it holds no number."""
    dashed, plain = r"^(\d[\d\s,A-Z]*?)\s*[-–\r]\s*(.+)$", r"^(\d[\d\s,A-Z]*?)\s{1,4}([A-Z\"'].+)$"
    pick = lambda flat, k: F.coalesce(F.nullif(F.regexp_extract(flat, dashed, k), F.lit("")), F.nullif(F.regexp_extract(flat, plain, k), F.lit("")))

    def entry(flat: Column) -> Column:
        numbers = F.transform(F.split(F.replace(pick(flat, 1), F.lit("O"), F.lit("0")), ","), lambda p: F.regexp_replace(F.btrim(p), "[A-Z]+$", ""))
        nums = F.transform(F.filter(numbers, lambda p: F.regexp_like(p, F.lit("^[0-9]+$"))), lambda p: p.cast("int"))
        return let(nums, lambda nums: F.when(F.size(nums) > 0, F.struct(nums.alias("nums"), F.regexp_replace(F.btrim(pick(flat, 2)), r"\.+$", "").alias("title"))))

    return let(F.regexp_replace(title, "[\r\n]", " "), entry)


def allcaps(line: Column) -> Column:
    """At least three letters, over four fifths of them capitals."""
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    return (letters >= 3) & (F.regexp_count(line, F.lit(r"\p{Lu}")) > 0.8 * letters)


# What marks a page's head, a document's closing promotion, and the lines between title and body.
HEADERS = (r"Sermon\s*#\s*\d+", r"Volume\s*\d+")
PROMOTION = ("PRAY THE HOLY SPIRIT", "Spanish translations", "By the grace of God", "WILL USE THIS SERMON", "TO BRING MANY TO A SAVING KNOWLEDGE")
METADATA = (r"NO\.\s*\d+", r"A\s+SERMON", r"DELIVERED\s+BY", r"AT\s+(THE\s+)?(METROPOLITAN\s+TABERNACLE|NEW\s+PARK\s+STREET|EXETER\s+HALL|SURREY)", r"ON\s+(SUNDAY|MONDAY|TUESDAY|WEDNESDAY|THURSDAY|FRIDAY|SATURDAY|LORD)", r"INTENDED\s+FOR\s+READING")


def header_line(line: Column, patterns: tuple[str, ...] = HEADERS) -> Column:
    """A page number of up to four digits, or a line that any header pattern stands in. patterns may come from a table (lexicons.rows_of)."""
    return F.regexp_like(F.btrim(line), F.lit("(?i)" + "|".join((r"^[0-9]{1,4}\s*$", *patterns))))


def promo_line(line: Column, markers: tuple[str, ...] = PROMOTION) -> Column:
    """Whether any marker stands in the line, in either case; a blank line is none. markers may come from a table."""
    return F.exists(F.array(*[F.lit(m.lower()) for m in markers]), lambda m: F.contains(F.lower(line), m))


def metadata_line(line: Column, more: tuple[str, ...] = ()) -> Column:
    """Blank, mostly capitals, or opened by a metadata pattern."""
    return (F.btrim(line) == "") | F.regexp_like(line, F.lit(r"(?i)^\s*(" + "|".join((*METADATA, *more)) + ")")) | allcaps(line)


def strip_title_block(values: Column, more: tuple[str, ...] = ()) -> Column:
    """Lines without the metadata that opens them: up to the first that opens a quotation or is no metadata, and the blank lines
    there. Unchanged if nothing but blank lines came before a line that is no metadata."""
    def step(t: Column, line: Column) -> Column:
        bare = F.btrim(line, F.lit(" \t\r\n\f\x0b"))
        quoted = F.regexp_like(bare, F.lit("^[\"“”'‘’]"))
        goes = ~t["done"] & ~quoted & metadata_line(line, more)
        return F.struct((t["at"] + goes.cast("int")).alias("at"), (t["done"] | ~goes).alias("done"), (t["found"] | (~t["done"] & (bare != "") & (quoted | goes))).alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("done"), F.lit(False).alias("found"))
    return F.aggregate(values, start, step, lambda t: F.when(t["found"], F.slice(values, t["at"] + 1, F.size(values))).otherwise(values))


def without_head(values: Column, is_header, most: int = 2) -> Column:
    """A page's lines without its head: blank lines, up to `most` headers and, after these, page numbers."""
    def step(t: Column, line: Column) -> Column:
        bare = F.btrim(line)
        header = (t["n"] < most) & is_header(line)
        goes = ~t["done"] & ((bare == "") | header | ((t["n"] >= most) & F.regexp_like(bare, F.lit("^[0-9]{1,4}$"))))
        return F.struct((t["n"] + (goes & header & (bare != "")).cast("int")).alias("n"), (t["at"] + goes.cast("int")).alias("at"), (~goes).alias("done"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit(False).alias("done"))
    return F.slice(values, F.aggregate(values, start, step, lambda t: t["at"]) + 1, F.size(values))


def without_promotion(values: Column, is_promo) -> Column:
    """Lines without the blank lines and promotion at their end."""
    kept = F.filter(F.transform(values, lambda x, i: F.when((F.btrim(x) != "") & ~is_promo(x), i + 1)), lambda i: i.isNotNull())
    return F.slice(values, F.lit(1), F.coalesce(F.array_max(kept), F.lit(0)))
