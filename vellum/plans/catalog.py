"""Registered queries of the document engine and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions import markup as M
from vellum.functions import outline as O
from vellum.functions import references as R
from vellum.functions import text as X
from vellum.functions.lexicons import KEEP_UPPER
from vellum.operators import documents as D
from vellum.operators import outline as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
STRONG = ("the", "of", "and", "to")


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FLAT = r"trim(regexp_replace(text, '[ \t\n\f\r\x0b]+', ' ', 'g'))"
SPLIT = rf"""(SELECT doc_id, list_filter(list_transform(string_split(regexp_replace({FLAT}, '([.!?])(?:[ ]*")?[ ]+([A-Z0-9"“])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '') AS s FROM documents)"""
SIMPLE = rf"""(SELECT doc_id, list_filter(list_transform(string_split(regexp_replace({FLAT}, '([.!?])[ ]+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '') AS s FROM documents)"""
ROWS = "(SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM {})"


@query("sentence_split", f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM {ROWS.format(SPLIT)}")
def sentence_split(spark, d):
    return D.sentence_rows(_table(spark, d, "documents"))


@query("sentence_split_simple", f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM {ROWS.format(SIMPLE)}")
def sentence_split_simple(spark, d):
    return D.sentence_rows(_table(spark, d, "documents"), X.sentences_simple)


COUNT = r"len(regexp_extract_all(sentence, '(?i)\b(the|of|and|to)\b'))"
UNTITLED = r"(SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(s, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')), lambda s: s <> '' AND NOT (regexp_matches(s, '\p{Lu}') AND NOT regexp_matches(s, '\p{Ll}')) AND NOT regexp_matches(s, '^[0-9]+$')), ' ') AS text FROM documents)"
TOP = rf"""WITH r AS (SELECT *, {COUNT} AS strong FROM {ROWS.format(SIMPLE.replace("FROM documents", "FROM " + UNTITLED))}),
g AS (SELECT *, round(strong * 10 - length(sentence) * 0.08 + CASE WHEN contains(sentence, '!') THEN 3 ELSE 0 END, 6) AS score FROM r WHERE length(sentence) BETWEEN 30 AND 120 AND regexp_matches(sentence, '^\p{{Lu}}') AND regexp_matches(sentence, '[.!?]$') AND strong >= CASE WHEN regexp_matches(sentence, '^(And|But|Or|For|If|When|While|So|Yet)\s') THEN 3 ELSE 2 END),
u AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY doc_id, left(sentence, 30) ORDER BY score DESC, pos) = 1)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS INTEGER) AS rank, CAST(pos AS INTEGER) AS pos, CAST(score AS DOUBLE) AS score, sentence FROM u QUALIFY rank <= 8"""


@query("top_quotes", TOP)
def top_quotes(spark, d):
    return D.top_sentences(_table(spark, d, "documents"), STRONG)


@query("strong_word_density", f"SELECT doc_id, CAST(sum({COUNT}) AS BIGINT) AS strong, count(*) AS n_sentences FROM {ROWS.format(SIMPLE)} GROUP BY doc_id")
def strong_word_density(spark, d):
    rows = D.sentence_rows(_table(spark, d, "documents"), X.sentences_simple)
    return rows.groupBy("doc_id").agg(F.sum(D.strong_count(F.col("sentence"), STRONG)).alias("strong"), F.count("*").alias("n_sentences"))


@query("prefix_dedupe", f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM {ROWS.format(SPLIT)} QUALIFY row_number() OVER (PARTITION BY doc_id, left(sentence, 25) ORDER BY pos) = 1")
def prefix_dedupe(spark, d):
    return D.first_of_prefix(_table(spark, d, "documents"), 25)


@query("tail_lines", r"""SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS line FROM (SELECT doc_id, l[len(l) - len(l) // 3 + 1:] AS t FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS l FROM documents))""")
def tail_lines(spark, d):
    return D.tail_third(_table(spark, d, "documents"))


@query("paragraphs", r"""SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS paragraph FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n\s*\n', chr(1), 'g'), chr(1)), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '') AS p FROM documents)""")
def paragraphs(spark, d):
    return D.exploded(_table(spark, d, "documents"), X.paragraphs(F.col("text")), "paragraph")


@query("xml_escape", "SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM documents")
def xml_escape(spark, d):
    return _table(spark, d, "documents").select("doc_id", X.xml_escape(F.col("text")).alias("escaped"))


@query("html_escape", "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM pages")
def html_escape(spark, d):
    return _table(spark, d, "pages").select("page_id", X.html_escape(F.col("html")).alias("escaped"))


@query("comma_breaks", r"""SELECT page_id, array_to_string(list_transform(list_zip(list_transform(string_split_regex(html, '<[^>]*>'), lambda p: regexp_replace(p, '([,;:]) ', '\1<break time="400ms"/> ', 'g')), regexp_extract_all(html, '<[^>]*>')), lambda z: z[1] || coalesce(z[2], '')), '') AS ssml FROM pages""")
def comma_breaks(spark, d):
    return _table(spark, d, "pages").select("page_id", X.comma_breaks(F.col("html")).alias("ssml"))


SMALL = ", ".join(f"'{w}'" for w in X.SMALL_WORDS)
HEAD = "trim(string_split(text, chr(10))[1])"


@query("title_case", rf"""SELECT doc_id, array_to_string(list_transform(w, lambda x, i: CASE WHEN i = 1 OR lower(x) NOT IN ({SMALL}) THEN CASE WHEN left(x, 1) = 'ß' THEN 'Ss' ELSE upper(left(x, 1)) END || lower(substr(x, 2)) ELSE lower(x) END), ' ') AS title FROM (SELECT doc_id, list_filter(string_split_regex({HEAD}, '\s+'), lambda x: x <> '') AS w FROM documents)""")
def title_case(spark, d):
    return _table(spark, d, "documents").select("doc_id", X.title_case(X.first_line(F.col("text"))).alias("title"))


@query("phrase_trim", rf"""WITH t AS (SELECT doc_id, {HEAD} AS h FROM documents), c AS (SELECT *, left(h, 58) AS c FROM t), s AS (SELECT *, CASE WHEN contains(c, ' ') AND 58 - instr(reverse(c), ' ') > 29 THEN left(c, 58 - instr(reverse(c), ' ')) ELSE c END AS s FROM c)
SELECT doc_id, CASE WHEN length(h) <= 58 THEN h ELSE regexp_replace(regexp_replace(s, '(?i)\s+(?:{X.DANGLING})\s*$', ''), '[ ,;:-]+$', '') END AS phrase FROM s""")
def phrase_trim(spark, d):
    return _table(spark, d, "documents").select("doc_id", X.phrase_trim(X.first_line(F.col("text")), 58).alias("phrase"))


@query("pascal_case", rf"""SELECT doc_id, printf('%04d_', CAST(doc_id AS INTEGER)) || array_to_string(list_transform(w, lambda x: CASE WHEN left(x, 1) = 'ß' THEN 'Ss' ELSE upper(left(x, 1)) END || lower(substr(x, 2))), '') || '.txt' AS file_name FROM (SELECT doc_id, list_filter(string_split_regex(trim(regexp_replace(regexp_replace(left({HEAD}, 60), '[—–-]', ' ', 'g'), '[^\pL\pN_\s]', '', 'g')), '\s+'), lambda x: x <> '') AS w FROM documents)""")
def pascal_case(spark, d):
    return _table(spark, d, "documents").select("doc_id", X.numbered_name(F.col("doc_id"), F.left(X.first_line(F.col("text")), F.lit(60))).alias("file_name"))


RANGES = "(SELECT CAST(v AS INTEGER) AS volume, CASE WHEN v = 1 THEN 1 WHEN v <= 6 THEN 54 + 57 * (v - 2) ELSE 348 + 57 * (v - 7) END AS lo, CASE WHEN v = 6 THEN 347 WHEN v = 63 THEN 3563 WHEN v = 1 THEN 53 WHEN v < 6 THEN 54 + 57 * (v - 2) + 56 ELSE 348 + 57 * (v - 7) + 56 END AS hi FROM range(1, 64) t(v))"


@query("volume_range_join", f"SELECT o_orderkey, coalesce(volume, 63) AS volume FROM (SELECT o_orderkey, o_orderkey % 3700 AS n FROM orders) LEFT JOIN {RANGES} r ON n BETWEEN lo AND hi")
def volume_range_join(spark, d):
    items = _table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 3700).alias("n"))
    return D.assign_volume(items, "n").select("o_orderkey", "volume")


@query("pending_items", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_items(spark, d):
    return D.pending(_table(spark, d, "documents"), _table(spark, d, "labels"), "doc_id").select("doc_id", "source")


@query("ordered_concat", "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def ordered_concat(spark, d):
    return D.ordered_concat(_table(spark, d, "conversations"), "conv_id", ["turn"], "text")


@query("running_count", "SELECT conv_id, turn, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS seen FROM conversations")
def running_count(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return _table(spark, d, "conversations").select("conv_id", "turn", F.sum(F.length("text")).over(w).alias("seen"))


@query("modal_quantity", "SELECT l_orderkey, v AS mode FROM (SELECT l_orderkey, l_quantity AS v, count(*) AS n, min(l_linenumber) AS f FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f, v) = 1")
def modal_quantity(spark, d):
    return D.modal_value(_table(spark, d, "lineitem"), "l_orderkey", F.col("l_quantity"), "l_linenumber", 54.0)


@query("median_quantity", "SELECT l_orderkey, list_sort(list(l_quantity))[count(*) // 2 + 1] AS median FROM lineitem GROUP BY l_orderkey")
def median_quantity(spark, d):
    return D.upper_median(_table(spark, d, "lineitem"), "l_orderkey", F.col("l_quantity"), 16.0)


@query("allcaps_lines", r"""SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda l: len(regexp_extract_all(l, '\pL')) >= 3 AND len(regexp_extract_all(l, '\p{Lu}')) > 0.8 * len(regexp_extract_all(l, '\pL')))) AS INTEGER) AS n FROM documents""")
def allcaps_lines(spark, d):
    return _table(spark, d, "documents").select("doc_id", F.size(F.filter(X.lines(F.col("text")), X.allcaps)).alias("n"))


LEXICON = (("the", "ðə", False), ("of", "ɒv", False), ("De", "də", True))
TAGGED = {"the": ("(?i:the)", "ðə", 1), "of": ("(?i:of)", "ɒv", 2), "De": ("De", "də", 3)}
HEADER = "|".join(f"(?:{p})" for p in (r"^$", r"^[A-Z][A-Z\s,;:''\-—.!?&]+\s*$", r"^(?i:NO\.\s*\d+)", r"^(?i:A SERMON DELIVERED)", r"^(?i:A SERMON\s*,?\s*PREACHED)", r"^(?i:DELIVERED ON)", r"^(?i:AT\s+(?:THE\s+)?[A-Z])", r"^(?i:ON\s+(?:LORD[''’]?S[- ]DAY|SABBATH|SUNDAY|THURSDAY))"))
KEPT = ", ".join(f"'{w}'" for w in ("LORD", "GOD", "JEHOVAH", "CHRIST", "JESUS", "HOLY", "KING", "AMEN", "HALLELUJAH", "SELAH", "I", "II", "III", "IV", "V"))


KEEPS = f"AND x NOT IN ({KEPT})"
APART = r"(^|[^\pL\pN_\x01])"


def _fixed(column: str, opens: str, kept: str) -> str:
    """Words in capitals marked by chr(1), twice as marks share their separators; then every second piece is capitalised."""
    mark = lambda x: rf"regexp_replace({x}, '{opens}([A-Z]{{2,}})(\s)', '\1' || chr(1) || '\2' || chr(1) || '\3', 'g{'m' if opens.startswith('(?m)') else ''}')"
    word = "x[1] || lower(substr(x, 2))"
    return f"array_to_string(list_transform(string_split({mark(mark(column))}, chr(1)), lambda x, i: CASE WHEN i % 2 = 0 {kept} THEN {word} ELSE x END), '')"


def _said(column: str) -> str:
    x = f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    for pattern, _, k in TAGGED.values():
        for _ in range(2):  # names share their separators
            x = rf"regexp_replace({x}, '(^|[^\pL\pM\pN_</\x01-\x03])({pattern})($|[^\pL\pM\pN_>\x04])', '\1' || chr({k}) || '\2' || chr(4) || '\3', 'g')"
    for _, ipa, k in TAGGED.values():
        x = f"""replace({x}, chr({k}), '<phoneme alphabet="ipa" ph="{ipa}">')"""
    return f"replace({x}, chr(4), '</phoneme>')"


_WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
SPOKEN_DOCUMENT = rf"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS raw, list_transform(string_split(text, chr(10)), lambda x: trim(x, {_WS})) AS bare FROM documents),
n AS (SELECT *, list_position(list_transform(bare[2:5], lambda x: x <> ''), true) AS near FROM l),
m AS (SELECT *, CASE WHEN regexp_matches(bare[near + 1], '^\d+$') THEN bare[near + 1] WHEN regexp_matches(bare[near + 1], '^[Nn][Oo]\.?\s*\d+') THEN regexp_extract(bare[near + 1], '^[Nn][Oo]\.?\s*(\d+)', 1) END AS number FROM n),
s AS (SELECT *, CASE WHEN number IS NULL THEN 1 ELSE near + 1 END AS start FROM m),
b AS (SELECT doc_id, bare[1] AS title, number, array_to_string(raw[start + coalesce(nullif(list_position(list_transform(bare[start + 1:], lambda x: NOT regexp_matches(x, '{HEADER}')), true), 0), greatest(len(raw) - start, 0) + 1):], chr(10)) AS body FROM s),
c AS (SELECT doc_id, title, number, {_fixed("body", "(?m)^()", "")} AS body FROM b),
f AS (SELECT doc_id, title, number, {_fixed("body", APART, KEEPS)} AS body FROM c),
e AS (SELECT doc_id, {_said("title")} AS title, number, {_said("body")} AS body FROM f),
p AS (SELECT doc_id, title, number, list_filter(list_transform(string_split(regexp_replace(regexp_replace(body, '\r\n?', chr(10), 'g'), '\n\s*\n', chr(1), 'g'), chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS ps FROM e),
q AS (SELECT doc_id, title, number, list_transform(ps, lambda x: '<p>' || chr(10) || array_to_string(list_transform(string_split(regexp_replace(x, '([.!?])(?:[ ]*")?[ ]+([A-Z0-9"“])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda y: '<s>' || regexp_replace(y, '([,;:]) ', '\1<break time="400ms"/> ', 'g') || '</s>'), chr(10) || '<break time="750ms"/>' || chr(10)) || chr(10) || '</p>') AS ps FROM p)
SELECT doc_id, '<speak>' || chr(10) || '<prosody rate="slow" pitch="-8%" volume="soft">' || chr(10) || chr(10) || '<p>' || chr(10) || '<s><emphasis level="strong">' || title || '</emphasis></s>' || chr(10) || '<break time="1500ms"/>' || chr(10) || '</p>' || chr(10) || chr(10)
|| CASE WHEN number IS NULL THEN '' ELSE '<p>' || chr(10) || '<s><sub alias="Sermon number ' || number || '">No. ' || number || '</sub>.</s>' || chr(10) || '<break time="1200ms"/>' || chr(10) || '</p>' || chr(10) || chr(10) END
|| CASE WHEN len(ps) = 0 THEN '' ELSE array_to_string(ps, chr(10) || chr(10) || '<break time="1200ms"/>' || chr(10) || chr(10)) || chr(10) END || chr(10) || '</prosody>' || chr(10) || '</speak>' || chr(10) AS ssml FROM q"""


@query("ssml_render", SPOKEN_DOCUMENT)
def ssml_render(spark, d):
    return M.spoken_documents(_table(spark, d, "documents"), LEXICON)


@query("caps_fix", f"SELECT doc_id, {_fixed('text', APART, KEEPS)} AS fixed FROM (SELECT doc_id, {_fixed('text', '(?m)^()', '')} AS text FROM documents)")
def caps_fix(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", X.caps_to_title(F.col("text"), leading=True).alias("text"))
    return docs.select("doc_id", X.caps_to_title(F.col("text"), KEEP_UPPER).alias("fixed"))


@query("pronounce", f"SELECT doc_id, {_said('text')} AS ssml FROM documents")
def pronounce(spark, d):
    return _table(spark, d, "documents").select("doc_id", X.xml_escape(F.col("text")).alias("text")).select("doc_id", M.pronounce(F.col("text"), LEXICON).alias("ssml"))


MARKED = r"\b(?:the|of|and|to)\b"


@query("applications_tail", r"""WITH l AS (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS l FROM documents),
t AS (SELECT doc_id, array_to_string(list_filter(list_transform(l[len(l) - len(l) // 3 + 1:], lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '' AND NOT (regexp_matches(s, '\p{Lu}') AND NOT regexp_matches(s, '\p{Ll}')) AND NOT regexp_matches(s, '^[0-9]+$')), ' ') AS text FROM l),
s AS (SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS s FROM """ + SIMPLE.replace("FROM documents", "FROM t") + r"""),
k AS (SELECT doc_id, pos, CASE WHEN length(s) > 120 THEN left(s, 117) || '...' ELSE s END AS application FROM s WHERE length(s) BETWEEN 30 AND 130 AND regexp_matches(s, '(?i)\b(?:the|of|and|to)\b')),
u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, left(application, 25) ORDER BY pos) = 1)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, application FROM u QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) <= 4""")
def applications_tail(spark, d):
    return P.applications(_table(spark, d, "documents").select("doc_id", F.col("text").alias("body")), f"(?i){MARKED}")


@query("outline_render")
def outline_render(spark, d):
    docs = M.with_title_and_body(P.long_enough(_table(spark, d, "documents")))
    return P.render(docs, top_quotes(spark, d).select("doc_id", "rank", "sentence"))


@query("merge_tags", r"""SELECT page_id, regexp_replace(regexp_replace(replace(replace(html, '<b>', '<strong>'), '</b>', '</strong>'), '</em>\s*<em>', '', 'g'), '</strong>\s*<strong>', '', 'g') AS html FROM pages""")
def merge_tags(spark, d):
    strong = F.replace(F.replace(F.col("html"), F.lit("<b>"), F.lit("<strong>")), F.lit("</b>"), F.lit("</strong>"))
    return _table(spark, d, "pages").select("page_id", X.merge_tags(strong).alias("html"))


@query("rejoin_hyphen", r"""SELECT page_id, regexp_replace(html, '([a-z])-\s+([a-z])', '\1\2', 'g') AS html FROM pages""")
def rejoin_hyphen(spark, d):
    return _table(spark, d, "pages").select("page_id", X.rejoin_hyphen(F.col("html")).alias("html"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_quotes(spark, sf_dir)


from vellum.plans import shaped  # noqa: E402, F401 - registers its queries here
