"""Operators over a few given rows, each with the rows that are expected of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import markup as M
from vellum.functions import outline as O
from vellum.functions import references as R
from vellum.functions import text as X
from vellum.operators import documents as D
from vellum.operators import outline as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return register


NAMES = "(VALUES ('43God''sX.txt'), ('43GodsX.txt'), ('07Two.txt'), ('07Also.txt'), ('51Beyond.txt'), ('notes.md'), ('12Last.txt')) AS t(file_name)"

MARKS = "(VALUES (1, 1, '1 - The First Word.', 3), (1, 2, '7, 8 - Two Parts', 10), (1, 3, '3O - Letter Typo', 10), (1, 4, '165 The Plain One.', 15), (1, 5, 'Contents', NULL), (2, 1, '1451A - Quoted', 2)) AS t(volume, ord, title, start_page)"

LAYOUT = "(VALUES (1, 1, 54.0, 10.0, 20.0, 14.0), (1, 2, 54.4, 26.0, 36.0, 14.0), (1, 3, 68.0, 42.0, 52.0, 14.0), (1, 4, 160.0, 58.0, 68.0, 12.0), (1, 5, 160.0, 74.0, 84.0, 12.0), (1, 6, 54.0, 140.0, 150.0, 14.0), (1, 7, 170.0, 10.0, 20.0, 14.0)) AS t(doc, line_no, x0, y0, y1, size)"

HEADS = r"(VALUES (1, 'T\nPREACHED ON SUNDAY, MAY 3, 1868,\nAT THE HALL.\n\"A word\nMark 1:1'), (2, 'T\nplain\nLuke 2:2')) AS t(i, s)"

BODIES = r"(VALUES (1, 'x\nI. First the theme\nGOES ON\n\nsee John 3:4.\nII. The next matter\nMark 1:1'), (2, 'x\nFirst, we see light. More\nIn the second place, dark'), (3, 'nothing')) AS t(doc_id, body)"

LINES = r"(VALUES (1, '12'), (2, '12345'), (3, 'Sermon #7'), (4, 'see volume 3 there'), (5, 'No. 9'), (6, 'A SERMON DELIVERED x'), (7, 'THE TITLE'), (8, 'Plain words'), (9, ' '), (10, 'on Sunday'), (11, 'They pray the Holy Spirit will')) AS t(i, line)"

SPOKEN = """(VALUES (1, '<speak><prosody rate="slow"><p><s>One,<break time="400ms"/> two.</s></p><break time="1200ms"/><p><s><sub alias="b">B</sub></s><s>C</s></p></prosody></speak>'), (2, 'bare')) AS t(i, ssml)"""


@query("manifest_dedupe", f"SELECT CAST(left(file_name, 2) AS INTEGER) AS num, min(file_name) AS file_name FROM {NAMES} WHERE regexp_matches(file_name, '^[0-9][0-9][A-Z]') AND CAST(left(file_name, 2) AS INTEGER) BETWEEN 1 AND 50 AND NOT contains(file_name, '''') GROUP BY 1")
def manifest_dedupe(spark, d):
    names = spark.sql(f"SELECT file_name FROM {NAMES.replace(chr(39) * 2, chr(92) + chr(39))}").withColumn("num", F.nullif(F.regexp_extract("file_name", r"^(\d{2})[A-Z]", 1), F.lit("")).cast("int"))
    return D.keep_first(names.where(F.col("num").between(1, 50) & ~F.contains("file_name", F.lit("'"))), ["num"], ["file_name"]).select("num", "file_name")


@query("bookmark_explode", "SELECT * FROM (VALUES (1, 1, 'The First Word'), (2, 7, 'Two Parts'), (2, 8, 'Two Parts'), (3, 30, 'Letter Typo'), (4, 165, 'The Plain One'), (1, 1451, 'Quoted')) AS t(ord, num, title)")
def bookmark_explode(spark, d):
    rows = spark.sql(f"SELECT * FROM {MARKS}").withColumn("p", X.bookmark_numbers(F.col("title"))).where("p is not null")
    return rows.select("ord", F.explode("p.nums").alias("num"), F.col("p.title").alias("title"))


@query("page_ranges", f"SELECT volume, ord, start_page, coalesce(lead(start_page) OVER (PARTITION BY volume ORDER BY ord), 20) AS end_page FROM {MARKS} WHERE start_page IS NOT NULL")
def page_ranges(spark, d):
    return D.page_ranges(spark.sql(f"SELECT * FROM {MARKS}"), spark.sql("SELECT * FROM (VALUES (1, 20), (2, 20)) AS t(volume, total)")).select("volume", "ord", "start_page", "end_page")


@query("dehyphenate", "SELECT * FROM (VALUES (1, 0, 'foobar-'), (1, 1, 'baz'), (2, 0, 'plain'), (2, 1, 'conti nued')) AS t(doc, pos, line)")
def dehyphenate(spark, d):
    rows = spark.sql("SELECT 1 AS doc, array('foo-', 'bar-', 'baz') AS l UNION ALL SELECT 2, array('plain', 'conti nued')")
    return rows.select("doc", F.posexplode(X.dehyphenate(F.col("l"))).alias("pos", "line"))


@query("caps_fix", "SELECT * FROM (VALUES (1, 'The Lord Said TO him'), (2, 'II Kept GOD.')) AS t(i, fixed)")
def caps_fix(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES (1, 'THE LORD SAID TO him'), (2, 'II KEPT GOD.')) AS t(i, s)")
    return rows.select("i", X.caps_to_title(F.col("s"), ("II", "TO")).alias("fixed"))


@query("paragraph_islands", "SELECT * FROM (VALUES (1, 1, 1, 'body'), (1, 2, 1, 'body'), (1, 3, 2, 'body'), (1, 4, 3, 'verse'), (1, 5, 3, 'verse'), (1, 6, 4, 'body'), (1, 7, 5, 'blockquote')) AS t(doc, line_no, para_id, kind)")
def paragraph_islands(spark, d):
    rows = spark.sql(f"SELECT doc, line_no, double(x0) x0, double(y0) y0, double(y1) y1, double(size) size FROM {LAYOUT}")
    return D.paragraph_islands(rows, 54.0, 16.0).select("doc", "line_no", F.col("para_id").cast("int").alias("para_id"), "kind")


@query("fallback_join", "SELECT * FROM (VALUES ('a', 'John 3:16'), ('b', 'own'), ('c', '')) AS t(file_name, ref)")
def fallback_join(spark, d):
    left = spark.sql("SELECT * FROM (VALUES ('a', 'x'), ('b', 'own'), ('c', NULL)) AS t(file_name, ref)")
    return D.fallback(left, spark.sql("SELECT * FROM (VALUES ('a', 'John 3:16'), ('b', '')) AS t(file_name, ref)"), "file_name", "ref").select("file_name", "ref")


@query("scripture_expand", """SELECT * FROM (VALUES (1, '<sub alias="Romans chapter 8, verse 28">Rom. 8:28</sub>.'), (2, 'see <sub alias="Psalm chapter 23">Psalm 23</sub>'), (3, '2 Corinthians 5:17'), (4, '<sub alias="John chapter 3, verses 3, 7, 9 through 11">John 3:3, 7, 9-11</sub> and <sub alias="First John chapter 1, verses 3 through 5">1 John 1:3-5</sub>')) AS t(i, ssml)""")
def scripture_expand(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES (1, 'Rom. 8:28.'), (2, 'see Psalm 23'), (3, '2 Corinthians 5:17'), (4, 'John 3:3, 7, 9-11 and 1 John 1:3-5')) AS t(i, s)")
    return rows.select("i", R.expand_references(F.col("s")).alias("ssml"))


@query("scripture_fallback", "SELECT * FROM (VALUES ('a', 'John 3:16'), ('b', 'Psalm 1:1-3'), ('c', '')) AS t(file_name, ref)")
def scripture_fallback(spark, d):
    texts = spark.sql(r"SELECT * FROM (VALUES ('a', 'T\nRomans 1:1'), ('b', 'T\nsee Psalm 1:1-3 x\nMark 1:1'), ('c', 'romans 1:1')) AS t(file_name, text)")
    notes = spark.sql(r"SELECT * FROM (VALUES ('a', 'x\n Scripture: John 3:16\n'), ('b', 'no line')) AS t(file_name, text)")
    return D.fallback(texts.select("file_name", R.first_reference(F.col("text")).alias("ref")), notes.select("file_name", R.noted_reference(F.col("text")).alias("ref")), "file_name", "ref")


@query("scripture_refs", "SELECT * FROM (VALUES (1, 'john 3:4|1 Corinthians 1:23, 24')) AS t(i, refs)")
def scripture_refs(spark, d):
    rows = spark.sql("SELECT 1 AS i, 'john 3:4; 1 Corinthians 1:23, 24. john 3:4' AS s")
    return rows.select("i", F.array_join(R.references(F.col("s")), "|").alias("refs"))


@query("title_body", "SELECT * FROM (VALUES (1, 'My Title', '12', 'Body one.'), (2, 'Other', NULL, 'Plain body' || chr(10) || 'A SERMON DELIVERED x'), (3, 'Third', '7', '')) AS t(i, title, number, body)")
def title_body(spark, d):
    rows = spark.sql(r"SELECT * FROM (VALUES (1, 'My Title\n12\n\nMY TITLE,\nNO. 12\nBody one.'), (2, 'Other\nPlain body\nA SERMON DELIVERED x'), (3, 'Third\n\nNo. 7')) AS t(i, s)")
    return rows.select("i", M.title_and_body(F.col("s")).alias("p")).select("i", "p.title", "p.number", "p.body")


@query("span_html", "SELECT * FROM (VALUES (1, '<strong><em>a&amp;b</em></strong> <em>c</em>d<strong>e</strong>')) AS t(i, html)")
def span_html(spark, d):
    rows = spark.sql("SELECT 1 AS i, array(named_struct('text', 'a&b', 'italic', true, 'bold', true), named_struct('text', ' ', 'italic', true, 'bold', true), named_struct('text', 'c', 'italic', true, 'bold', false), named_struct('text', 'd', 'italic', false, 'bold', false), named_struct('text', 'e', 'italic', false, 'bold', true)) AS spans")
    return rows.select("i", M.spans_html(F.col("spans")).alias("html"))


@query("pronounce", """SELECT * FROM (VALUES (1, '<x a="Job"/> <phoneme alphabet="ipa" ph="dʒoʊb">Job</phoneme> job <phoneme alphabet="ipa" ph="ˈsaɪmən">simon</phoneme> Simonides')) AS t(i, ssml)""")
def pronounce(spark, d):
    rows = spark.sql("""SELECT 1 AS i, '<x a="Job"/> Job job simon Simonides' AS s""")
    return rows.select("i", M.pronounce(F.col("s"), (("Job", "dʒoʊb", True), ("Simon", "ˈsaɪmən", False))).alias("ssml"))


@query("boilerplate_trim", "SELECT * FROM (VALUES (1, 3, 'Body'), (1, 4, '12'), (2, 1, 'Only')) AS t(doc, line_no, line)")
def boilerplate_trim(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES (1, 1, 'Volume 3'), (1, 2, '7'), (1, 3, 'Body'), (1, 4, '12'), (1, 5, ''), (1, 6, 'Visit our site'), (2, 1, 'Only')) AS t(doc, line_no, line)")
    return D.boilerplate_trim(rows, F.regexp_like("line", F.lit(r"(?i)^\d{1,4}\s*$|Volume\s*\d+")), F.contains(F.lower("line"), F.lit("visit our site")))


@query("date_location", "SELECT * FROM (VALUES (1, 'SUNDAY; THE HALL'), (2, '')) AS t(i, v)")
def date_location(spark, d):
    return spark.sql(f"SELECT * FROM {HEADS.replace('MAY 3, 1868', 'MAY')}").select("i", O.date_and_place(F.col("s")).alias("v"))


@query("opening_scripture", "SELECT * FROM (VALUES (1, 'Mark 1:1'), (2, 'Luke 2:2')) AS t(i, ref)")
def opening_scripture(spark, d):
    return spark.sql(f"SELECT * FROM {HEADS}").select("i", O.opening_reference(F.col("s")).alias("ref"))


@query("body_start", "SELECT * FROM (VALUES (1, 1), (2, 2)) AS t(i, first_line)")
def body_start(spark, d):
    rows = spark.sql(r"SELECT * FROM (VALUES (1, 'x\ny'), (2, 'T\nLuke 2:2\nNow it starts')) AS t(i, s)")
    return rows.select("i", O.body_start(F.col("s")).alias("first_line"))


@query("divisions_roman", "SELECT * FROM (VALUES (1, 0, 'I', 'First the Theme Goes on', 'John 3:4'), (1, 1, 'II', 'The Next Matter Mark 1', 'Mark 1:1')) AS t(doc_id, pos, numeral, heading, refs)")
def divisions_roman(spark, d):
    return P.divisions(spark.sql(f"SELECT * FROM {BODIES}").where("doc_id = 1")).select("doc_id", "pos", "numeral", "heading", F.array_join("refs", "|").alias("refs"))


@query("divisions_fallback", "SELECT * FROM (VALUES (2, 0, 'I', 'We See Light'), (2, 1, 'II', 'Dark')) AS t(doc_id, pos, numeral, heading)")
def divisions_fallback(spark, d):
    return P.divisions(spark.sql(f"SELECT * FROM {BODIES}").where("doc_id > 1")).select("doc_id", "pos", "numeral", "heading")


@query("division_points", "SELECT * FROM (VALUES (1, 'Alpha beta gamma delta.|Second point of it all.')) AS t(i, points)")
def division_points(spark, d):
    return spark.sql(r"SELECT 1 AS i, 'head\n1. Alpha beta gamma delta.\n2. Second point of it all.' AS s").select("i", F.array_join(O.subpoints(F.col("s")), "|").alias("points"))


@query("illustrations", "SELECT * FROM (VALUES (1, 1, 'like a ship upon the sea -- Holding Firm'), (1, 2, 'A farmer sows his field')) AS t(doc_id, pos, illustration)")
def illustrations(spark, d):
    return P.illustrations(spark.sql(r"SELECT 1 AS doc_id, 'x\nHe stood. Faith here, holding firm like a ship upon the sea, sails. So.\nSuppose a farmer sows his field, then waits.' AS body"))


@query("broken_words", "SELECT * FROM (VALUES (1, 'the gospel, Father and'), (2, 'into it')) AS t(i, line)")
def broken_words(spark, d):
    words = spark.sql("SELECT explode(array('gospel', 'father', 'fat', 'her', 'go', 'into', 'in', 'to', 'it')) AS word")
    return P.join_broken_words(spark.sql("SELECT * FROM (VALUES (1, 'the go spel, Fat her and'), (2, 'in to it')) AS t(i, line)"), "line", words)


@query("layout_roles", "SELECT * FROM (VALUES (1, 1, 'metadata'), (1, 2, 'scripture'), (1, 3, 'body'), (2, 1, 'metadata'), (2, 2, 'body')) AS t(doc, line_no, role)")
def layout_roles(spark, d):
    rows = spark.sql("SELECT doc, line_no, text, double(size) size, double(x0) x0 FROM (VALUES (1, 1, 'HEAD', 14.0, 54.0), (1, 2, '“Words', 12.0, 54.0), (1, 3, 'Body', 13.9, 54.0), (2, 1, 'HEAD', 14.0, 54.0), (2, 2, 'Text', 14.0, 60.0)) AS t(doc, line_no, text, size, x0)")
    return P.layout_roles(rows, F.col("text") == "HEAD", 54.0).select("doc", "line_no", "role")


@query("manifest_nested", """SELECT * FROM (VALUES ('{"first":[{"num":1,"title":"A"},{"num":2,"title":"caf\\u00e9"}],"second":[{"num":7,"title":"B"}]}')) AS t(json)""")
def manifest_nested(spark, d):
    first = spark.sql("SELECT * FROM (VALUES (2, 'café'), (1, 'A')) AS t(num, title)")
    return D.manifest({"first": first, "second": spark.sql("SELECT 7 AS num, 'B' AS title")}, "num").select(O.escape_ascii(F.to_json(F.struct("first", "second"))).alias("json"))


@query("header_filter", rf"""SELECT i, regexp_matches(trim(line), '(?i)^[0-9]{{1,4}}$|Sermon\s*#\s*[0-9]+|Volume\s*[0-9]+') AS header, trim(line) = '' OR regexp_matches(line, '(?i)^\s*(NO\.\s*[0-9]|A\s+SERMON|ON\s+SUNDAY)') OR (length(regexp_replace(line, '[^A-Za-z]', '', 'g')) >= 3 AND length(regexp_replace(line, '[^A-Z]', '', 'g')) > 0.8 * length(regexp_replace(line, '[^A-Za-z]', '', 'g'))) AS metadata FROM {LINES}""")
def header_filter(spark, d):
    return spark.sql(f"SELECT * FROM {LINES}").select("i", X.header_line(F.col("line")).alias("header"), X.metadata_line(F.col("line")).alias("metadata"))


@query("promo_filter", f"SELECT i, line FROM {LINES} WHERE NOT contains(lower(line), 'pray the holy spirit')")
def promo_filter(spark, d):
    return spark.sql(f"SELECT * FROM {LINES}").where(~X.promo_line(F.col("line")))


@query("layout_scan", "SELECT * FROM (VALUES (1, 1, 6, 'fifth Volume 8'), (1, 1, 7, 'Body one'), (1, 2, 2, 'Body two')) AS t(doc, page_no, line_no, text)")
def layout_scan(spark, d):
    shown = "(1, 1, 1, 10.0, 'Volume 3', 14.0), (1, 1, 2, 20.0, '7', 14.0), (1, 1, 3, 30.0, 'small', 10.5), (1, 1, 4, 40.0, 'Volume 4', 14.0), (1, 1, 5, 50.0, '  ', 14.0), (1, 1, 6, 60.0, 'fifth Volume 8', 14.0), (1, 1, 7, 70.0, 'Body one', 14.0), (1, 1, 8, 720.0, '12', 12.0), (1, 2, 2, 10.0, 'Body two', 14.0), (1, 2, 3, 20.0, 'Spanish translations', 14.0), (1, 2, 4, 30.0, 'By the grace of God', 14.0)"
    rows = spark.sql(f"SELECT doc, page_no, line_no, 792.0D AS page_height, double(y0) AS y0, array(named_struct('text', '', 'size', 30.0D), named_struct('text', s, 'size', double(size))) AS spans FROM (VALUES {shown}) AS t(doc, page_no, line_no, y0, s, size)")
    return D.layout_lines(rows, "doc", X.header_line, X.promo_line).select("doc", "page_no", "line_no", "text")


@query("prosody_strip", rf"""SELECT i, regexp_replace(ssml, '<prosody[^>]*>|</prosody>', '', 'g') AS inner_ssml FROM {SPOKEN}""")
def prosody_strip(spark, d):
    return spark.sql(f"SELECT * FROM {SPOKEN}").select("i", X.prosody_inner(F.col("ssml")).alias("inner_ssml"))


@query("ssml_stats", "SELECT * FROM (VALUES (1, 2, 3, 2, 1, 1600::BIGINT), (2, 0, 0, 0, 0, 0::BIGINT)) AS t(i, paragraphs, sentences, breaks, aliases, pause_ms)")
def ssml_stats(spark, d):
    return spark.sql(f"SELECT * FROM {SPOKEN}").select("i", M.speech_stats(F.col("ssml")).alias("x")).select("i", "x.*")


@query("extras_tags", "SELECT * FROM (VALUES ('a', 0, 'x'), ('a', 1, 'y'), ('b', 0, 'x')) AS t(id, pos, tag)")
def extras_tags(spark, d):
    return spark.sql("SELECT * FROM (VALUES ('a', array('x', 'y')), ('b', array('x')), ('c', array())) AS t(id, tags)").select("id", F.posexplode("tags").alias("pos", "tag"))


@query("volume_documents", "SELECT * FROM (VALUES (1, 1, 'One', 'a' || chr(10) || 'By the grace of God' || chr(10) || 'b'), (1, 2, 'Two', ''), (1, 3, 'Two', ''), (1, 4, 'Last', 'c')) AS t(volume, num, title, body)")
def volume_documents(spark, d):
    entries = spark.sql("SELECT * FROM (VALUES (1, 0, 'Contents', 0), (1, 1, ' 1 - One.', 1), (1, 2, '2, 3 - Two', 3), (1, 3, '4 - Last', 3), (1, 4, '5 - Lost', NULL)) AS t(volume, ord, title, page_no)")
    pages = spark.sql(r"SELECT * FROM (VALUES (1, 0, 'no'), (1, 1, 'Volume 1\n\nSermon #1\n7\na\nBy the grace of God'), (1, 2, 'b\n\nSpanish translations\n'), (1, 3, '9\nc'), (1, 4, '')) AS t(volume, page_no, text)")
    return D.volume_documents(entries, pages, spark.sql("SELECT 1 AS volume, 5 AS total"))
