"""Registered queries over rows of the shapes that documents, outlines and page layouts have, made from whole driver tables.

Each input is one SQL text that both engines read; the oracle computes what is expected from the parts that a row was made of, or by another
route than the operator's (a fold in order instead of windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import markup as M
from vellum.functions import outline as O
from vellum.functions import references as R
from vellum.functions import text as X
from vellum.operators import documents as D
from vellum.operators import outline as P
from vellum.plans.catalog import query
from vellum.sources import sinks as K
from vellum.sources import text as S

TABLES = ("nation", "region", "customer", "part", "orders", "conversations", "documents", "labels")


def rows(spark, d, sql: str) -> DataFrame:
    return spark.sql(sql.format(**{t: f"parquet.`{d}/{t}.parquet`" for t in TABLES}))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows of a table that one file may hold, over all cores: what is made of each costs far more than its move."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def told(sql: str, **inputs: str) -> str:
    """The oracle: sql after the inputs it names."""
    named = ", ".join(f"{name} AS ({text})" for name, text in inputs.items())
    return f"WITH {named} {sql}".format(**{t: t for t in TABLES}) if inputs else sql.format(**{t: t for t in TABLES})


def pick(values: str, key: str) -> str:
    return f"split_part('{values}', '|', CAST({key} % {values.count('|') + 1} AS INT) + 1)"


NL = "chr(10)"
# outlines: entries of volumes, from part
ENTRY = """SELECT CAST(p_partkey % 40 + 1 AS INT) AS volume, CAST((p_partkey - p_partkey % 40) / 40 AS INT) AS ord, CAST(p_partkey AS INT) AS n, CAST(p_partkey % 7 AS INT) AS form, p_name AS name,
CASE p_partkey % 7 WHEN 0 THEN p_partkey || ' - ' || p_name || '.' WHEN 1 THEN p_partkey || ', ' || (p_partkey + 1) || ' - ' || p_name WHEN 2 THEN '3O - ' || p_name WHEN 3 THEN p_partkey || ' ' || upper(p_name) || '.' WHEN 4 THEN p_partkey || 'A - ' || p_name WHEN 5 THEN p_name ELSE p_partkey || ', ' || (p_partkey + 1) || 'B,' || (p_partkey + 2) || '–' || p_name END AS title,
CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST((p_partkey - p_partkey % 80) / 40 AS INT) END AS start_page FROM {part}"""
NUMBERS = "CASE form WHEN 2 THEN [30] WHEN 1 THEN [n, n + 1] WHEN 5 THEN [] WHEN 6 THEN [n, n + 1, n + 2] ELSE [n] END"
NAMED = "CASE form WHEN 3 THEN upper(name) ELSE name END"


@query("bookmark_explode", told(f"SELECT volume, ord, CAST(unnest({NUMBERS}) AS INT) AS num, {NAMED} AS title FROM e", e=ENTRY))
def bookmark_explode(spark, d):
    e = rows(spark, d, ENTRY).withColumn("p", X.bookmark_numbers(F.col("title"))).where("p is not null")
    return e.select("volume", "ord", F.explode("p.nums").alias("num"), F.col("p.title").alias("title"))


@query("page_ranges", told("SELECT volume, ord, start_page, coalesce((SELECT arg_min(x.start_page, x.ord) FROM e x WHERE x.volume = e.volume AND x.ord > e.ord AND x.start_page IS NOT NULL), 900 + volume) AS end_page FROM e WHERE start_page IS NOT NULL", e=ENTRY))
def page_ranges(spark, d):
    totals = rows(spark, d, "SELECT DISTINCT CAST(p_partkey % 40 + 1 AS INT) AS volume, CAST(901 + p_partkey % 40 AS INT) AS total FROM {part}")
    return D.page_ranges(rows(spark, d, ENTRY).select("volume", "ord", "start_page"), totals).select("volume", "ord", "start_page", "end_page")


# a nested outline: entry k lies under k / 3
NESTED = "SELECT CAST(p_partkey % 5 AS INT) AS volume, CAST((p_partkey - p_partkey % 5) / 5 AS INT) AS id, CASE WHEN p_partkey < 15 THEN NULL ELSE CAST(((p_partkey - p_partkey % 5) / 5 - ((p_partkey - p_partkey % 5) / 5) % 3) / 3 AS INT) END AS parent, CAST((p_partkey * 7) % 1000 AS INT) AS pos, ' ' || p_name || ' ' AS title, CAST(p_partkey % 90 AS INT) AS page_no FROM {part}"


@query("flat_outline", told("""SELECT volume, CAST(row_number() OVER (PARTITION BY volume ORDER BY path) - 1 AS INT) AS ord, CAST(len(path) AS INT) AS level, trim(title) AS title, page_no - 1 AS page_no
FROM (WITH RECURSIVE t AS (SELECT *, [pos] AS path FROM e WHERE parent IS NULL UNION ALL SELECT e.*, list_append(t.path, e.pos) FROM e JOIN t ON e.volume = t.volume AND e.parent = t.id) SELECT * FROM t)""", e=NESTED))
def flat_outline(spark, d):
    return S.zero_based(S.flat_outline(rows(spark, d, NESTED)))


VOLUME_PAGES = "SELECT CAST(o_orderkey % 40 + 1 AS INT) AS volume, CAST((o_orderkey - o_orderkey % 40) / 40 AS INT) AS page_no, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'Volume ' || (o_orderkey % 40 + 1) || chr(10) || chr(10) || 'Sermon #' || o_orderkey || chr(10) || '12' || chr(10) || 'Body of ' || o_orderkey || '.' || chr(10) || 'By the grace of God' || CASE o_orderkey % 4 WHEN 0 THEN '' ELSE chr(10) || chr(10) || 'SPANISH translations' END END AS text FROM {orders}"


@query("volume_documents", told(f"""SELECT volume, CAST(unnest({NUMBERS}) AS INT) AS num, {NAMED} AS title, coalesce(body, '') AS body FROM (
SELECT r.*, (SELECT string_agg('Body of ' || (p.page_no * 40 + p.volume - 1) || '.' || CASE WHEN p.page_no = r.end_page - 1 THEN '' ELSE chr(10) || 'By the grace of God' || CASE WHEN (p.page_no * 40 + p.volume - 1) % 4 = 0 THEN '' ELSE chr(10) || chr(10) || 'SPANISH translations' END END, chr(10) ORDER BY p.page_no) FROM p WHERE p.volume = r.volume AND p.text <> '' AND p.page_no >= r.start_page AND p.page_no < r.end_page) AS body
FROM (SELECT *, coalesce(lead(start_page) OVER (PARTITION BY volume ORDER BY ord), 400) AS end_page FROM e WHERE start_page IS NOT NULL AND form <> 5) r)""", e=ENTRY, p=VOLUME_PAGES))
def volume_documents(spark, d):
    entries = rows(spark, d, ENTRY).select("volume", "ord", "title", F.col("start_page").alias("page_no"))
    return D.volume_documents(entries, rows(spark, d, VOLUME_PAGES), entries.select("volume").distinct().withColumn("total", F.lit(400)))


@query("document_files", told("SELECT printf('%04d_', p_partkey) || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), '') || '.txt' AS file_name, p_name || chr(10) || p_partkey || chr(10) || chr(10) || p_type || chr(10) AS content FROM {part}"))
def document_files(spark, d):
    return D.document_files(rows(spark, d, "SELECT CAST(p_partkey AS INT) AS num, p_name AS title, p_type AS body FROM {part}"))


FILES = "SELECT CASE o_orderkey % 4 WHEN 0 THEN lpad(CAST(o_orderkey % 3700 AS VARCHAR(9)), 4, '0') || '_Name.txt' WHEN 1 THEN o_orderkey || '.txt' WHEN 2 THEN o_orderkey || '_a_b.txt' ELSE o_orderkey || '_c.md' END AS file_name, ' ' || o_orderpriority || ' ' || chr(10) || '1' || chr(10) || CASE o_orderkey % 3 WHEN 0 THEN 'see John 3:' || (o_custkey % 30) || ' x' ELSE 'none' END AS text FROM {orders}"


@query("catalogue_entries", told(r"""SELECT num, title, file, scripture, CASE WHEN num < 1 OR num > 3563 THEN 63 WHEN num < 54 THEN 1 WHEN num < 348 THEN least(6, 2 + (num - 54) // 57) ELSE 7 + (num - 348) // 57 END AS volume
FROM (SELECT CAST(regexp_extract(file_name, '^([0-9]+)_', 1) AS INT) AS num, trim(string_split(text, chr(10))[1]) AS title, left(file_name, length(file_name) - 4) AS file, regexp_extract(text, 'John 3:[0-9]+') AS scripture FROM f WHERE regexp_matches(file_name, '^[0-9]+_.+\.txt$'))""", f=FILES))
def catalogue_entries(spark, d):
    return D.catalogue_entries(rows(spark, d, FILES))


@query("run_counts", told("SELECT source, count(*) AS processed, count(*) FILTER (WHERE n_chars > 2000) AS succeeded FROM {documents} GROUP BY source"))
def run_counts(spark, d):
    return D.counts_by(rows(spark, d, "SELECT source, CASE WHEN n_chars > 2000 THEN text WHEN n_chars > 500 THEN '' END AS text FROM {documents}"), "source", "text")


PRESENT = "SELECT 'volume' || lpad(CAST(n_nationkey * 3 AS VARCHAR(9)), 2, '0') || '.pdf' AS file_name FROM {nation}"


@query("present_volumes", told("SELECT CAST(v AS INT) AS volume, printf('volume%02d.pdf', v) AS file_name, CASE WHEN printf('volume%02d.pdf', v) IN (SELECT file_name FROM f) THEN NULL ELSE 'missing' END AS problem FROM range(1, 64) t(v)", f=PRESENT))
def present_volumes(spark, d):
    return S.present_volumes(S.volume_files(spark), rows(spark, d, PRESENT))


@query("base64_bytes", told("SELECT c_custkey, c_name || c_mktsegment AS content FROM {customer}"))
def base64_bytes(spark, d):
    coded = rows(spark, d, "SELECT c_custkey, base64(CAST(c_name || c_mktsegment AS BINARY)) AS content FROM {customer}")
    return K.decoded(coded, "content").select("c_custkey", F.col("content").cast("string").alias("content"))


NAMES = "SELECT CASE p_partkey % 5 WHEN 0 THEN lpad(CAST(p_partkey % 60 AS VARCHAR(9)), 2, '0') || upper(p_name) || '.txt' WHEN 1 THEN lpad(CAST(p_partkey % 60 AS VARCHAR(9)), 2, '0') || 'God' || chr(39) || 'sX.txt' WHEN 2 THEN p_partkey || '.md' ELSE lpad(CAST(p_partkey % 60 AS VARCHAR(9)), 2, '0') || 'Z' || p_partkey || '.txt' END AS file_name FROM {part}"


@query("manifest_dedupe", told("SELECT CAST(left(file_name, 2) AS INTEGER) AS num, min(file_name) AS file_name FROM n WHERE regexp_matches(file_name, '^[0-9][0-9][A-Z]') AND CAST(left(file_name, 2) AS INTEGER) BETWEEN 1 AND 50 AND NOT contains(file_name, '''') GROUP BY 1", n=NAMES))
def manifest_dedupe(spark, d):
    names = rows(spark, d, NAMES).withColumn("num", F.nullif(F.regexp_extract("file_name", r"^(\d{2})[A-Z]", 1), F.lit("")).cast("int"))
    return D.keep_first(names.where(F.col("num").between(1, 50) & ~F.contains("file_name", F.lit("'"))), ["num"], ["file_name"]).select("num", "file_name")


@query("manifest_nested", told(r"""SELECT '{{"first":[' || (SELECT string_agg('{{"num":' || n_nationkey || ',"title":"' || n_name || ' caf' || chr(92) || 'u00e9"}}', ',' ORDER BY n_nationkey) FROM {nation}) || '],"second":[' || (SELECT string_agg('{{"num":' || r_regionkey || ',"title":"' || r_name || '"}}', ',' ORDER BY r_regionkey) FROM {region}) || ']}}' AS json"""))
def manifest_nested(spark, d):
    first, second = rows(spark, d, "SELECT n_nationkey AS num, n_name || ' café' AS title FROM {nation}"), rows(spark, d, "SELECT r_regionkey AS num, r_name AS title FROM {region}")
    return D.manifest({"first": first, "second": second}, "num").select(O.escape_ascii(F.to_json(F.struct("first", "second"))).alias("json"))


@query("fallback_join", told("SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'good' WHEN d.lang = 'de' THEN '' ELSE d.lang END AS ref FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id"))
def fallback_join(spark, d):
    left = rows(spark, d, "SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE lang END AS ref FROM {documents}")
    return D.fallback(left, rows(spark, d, "SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE '' END AS ref FROM {labels}"), "doc_id", "ref").select("doc_id", "ref")


# book references, from orders
SPOKEN_BOOK, BOOK = pick("Romans|John|First John|Psalm||Second Corinthians", "o_orderkey"), pick("Rom.|John|1 John|Psalm|Nowhere|2 Cor.", "o_orderkey")
CHAPTER, VERSE = "(o_orderkey % 30 + 1)", "(o_custkey % 25 + 1)"
CITED = f"SELECT o_orderkey, {SPOKEN_BOOK} AS spoken, {BOOK} AS book, {CHAPTER} AS c, {VERSE} AS v, CAST((o_custkey + o_orderkey) % 5 AS INT) AS form FROM {{orders}}"
CITATION = "book || ' ' || c || CASE form WHEN 0 THEN '' WHEN 1 THEN ':' || v WHEN 2 THEN ':' || v || '-' || (v + 2) WHEN 3 THEN ':' || v || ', ' || (v + 2) ELSE ':' || v || '–' || (v + 1) || ', ' || (v + 4) || '-' || (v + 6) END"
IN_WORDS = "spoken || ' chapter ' || c || CASE form WHEN 0 THEN '' WHEN 1 THEN ', verse ' || v WHEN 2 THEN ', verses ' || v || ' through ' || (v + 2) WHEN 3 THEN ', verses ' || v || ', ' || (v + 2) ELSE ', verses ' || v || ' through ' || (v + 1) || ', ' || (v + 4) || ' through ' || (v + 6) END"


@query("scripture_expand", told(f"""SELECT o_orderkey, 'see ' || CASE WHEN spoken = '' THEN {CITATION} ELSE '<sub alias="' || {IN_WORDS} || '">' || {CITATION} || '</sub>' END || '. So' AS ssml FROM b""", b=CITED))
def scripture_expand(spark, d):
    return rows(spark, d, f"SELECT o_orderkey, 'see ' || {CITATION} || '. So' AS s FROM ({CITED})").select("o_orderkey", R.expand_references(F.col("s")).alias("ssml"))


QUOTED = f"SELECT o_orderkey, {pick('john|1 Corinthians|Psalms|Rom|1Peter|jn', 'o_orderkey')} || ' ' || {CHAPTER} || ':' || {VERSE} AS one, {pick('MARK|Gen|2 kings|Heb', 'o_custkey')} || {CHAPTER} || ' : ' || {VERSE} || ', ' || ({VERSE} + 1) AS two FROM {{orders}}"


@query("scripture_refs", told("SELECT o_orderkey, one || '|' || two AS refs FROM q", q=QUOTED))
def scripture_refs(spark, d):
    return rows(spark, d, f"SELECT o_orderkey, 'in ' || one || '; ' || two || '. Then ' || one AS s FROM ({QUOTED})").select("o_orderkey", F.array_join(R.references(F.col("s")), "|").alias("refs"))


KEYED = f"SELECT o_orderkey, {pick('Psalm|romans|1 John', 'o_orderkey')} || ' ' || {CHAPTER} || ':' || {VERSE} AS own, 'John ' || {CHAPTER} || ':' || {VERSE} AS noted, CAST(o_custkey % 3 AS INT) AS form FROM {{orders}}"


@query("scripture_fallback", told("SELECT o_orderkey, CASE WHEN form = 0 THEN noted WHEN own LIKE 'romans%' THEN 'Mark 1:1-3' ELSE own END AS ref FROM k", k=KEYED))
def scripture_fallback(spark, d):
    k = rows(spark, d, KEYED)
    own = k.select("o_orderkey", R.first_reference(F.concat(F.lit("T\nsee "), "own", F.lit(" x\nMark 1:1-3"))).alias("ref"))
    notes = k.where("form < 2").select("o_orderkey", R.noted_reference(F.when(F.col("form") == 0, F.concat(F.lit("x\n Scripture: "), "noted", F.lit(" \n"))).otherwise("no line")).alias("ref"))
    return D.fallback(own, notes, "o_orderkey", "ref")


# heads of documents, from orders
HEAD = f"SELECT o_orderkey, CAST(o_orderkey % 4 AS INT) AS form, o_orderkey + 1 AS n, o_orderpriority AS name, {pick('SABBATH MORNING|THURSDAY EVENING', 'o_custkey')} AS day, {pick('JANUARY|MAY|JUNE', 'o_orderkey')} || ' ' || (o_custkey % 28 + 1) || ', ' || (1850 + o_orderkey % 40) AS date, {pick('OLD HALL|NEW ROOMS, TOWN', 'o_orderkey')} AS place, 'John ' || {CHAPTER} || ':' || {VERSE} AS ref FROM {{orders}}"


@query("title_body", told(f"""SELECT o_orderkey, CASE form WHEN 3 THEN 'Fourth' ELSE 'My ' || name END AS title, CASE WHEN form IN (0, 2) THEN CAST(n AS VARCHAR) END AS number, CASE form WHEN 0 THEN 'Body ' || n || '.' WHEN 1 THEN 'Plain body' || {NL} || 'A SERMON DELIVERED x' WHEN 2 THEN '' ELSE 'Text' || {NL} || 'ON SUNDAY' END AS body FROM h""", h=HEAD))
def title_body(spark, d):
    text = F.when(F.col("form") == 0, F.concat_ws("\n", F.concat(F.lit("My "), "name"), "n", F.lit(""), F.lit("MY TITLE,"), F.concat(F.lit("NO. "), "n"), F.concat(F.lit("Body "), "n", F.lit("."))))
    text = text.when(F.col("form") == 1, F.concat(F.lit("My "), "name", F.lit("\nPlain body\nA SERMON DELIVERED x"))).when(F.col("form") == 2, F.concat(F.lit("My "), "name", F.lit("\n\nNo. "), "n")).otherwise(F.lit(" Fourth \n\nON SUNDAY x\nText\nON SUNDAY"))
    return rows(spark, d, HEAD).withColumn("n", F.col("n").cast("string")).select("o_orderkey", M.title_and_body(text).alias("p")).select("o_orderkey", "p.title", "p.number", "p.body")


@query("date_location", told("SELECT o_orderkey, CASE form WHEN 3 THEN '' WHEN 2 THEN 'THE ' || place ELSE day || ', ' || date || '; THE ' || place END AS v FROM h", h=HEAD))
def date_location(spark, d):
    line = F.concat(F.when(F.col("form") == 0, "PREACHED").otherwise("A TALK DELIVERED"), F.lit(" ON "), "day", F.lit(", "), "date", F.lit(","))
    text = F.concat_ws("\n", F.lit("T"), F.when(F.col("form") < 2, line), F.when(F.col("form") < 3, F.concat(F.lit("AT THE "), "place", F.lit("."))), F.lit("Body"))
    return rows(spark, d, HEAD).select("o_orderkey", O.date_and_place(text).alias("v"))


@query("opening_scripture", told("SELECT o_orderkey, CASE WHEN form < 2 THEN ref WHEN form = 2 THEN 'Mark 1:1' ELSE '' END AS ref FROM h", h=HEAD))
def opening_scripture(spark, d):
    text = F.concat_ws("\n", F.lit("T"), F.when(F.col("form").isin(0, 2), "Mark 1:1"), F.when(F.col("form") < 2, '"Some words'), F.when(F.col("form") < 2, F.concat(F.lit("of old. "), "ref")), F.lit("Body"))
    return rows(spark, d, HEAD).select("o_orderkey", O.opening_reference(text).alias("ref"))


@query("body_start", told("SELECT o_orderkey, CAST(CASE WHEN form = 3 THEN 4 ELSE 4 + form END AS INT) AS first_line FROM h", h=HEAD))
def body_start(spark, d):
    text = F.concat(F.lit("T\n"), F.when(F.col("form") < 3, F.col("ref")).otherwise("x"), F.lit("\n"), F.repeat(F.lit("\n"), F.when(F.col("form") < 3, F.col("form")).otherwise(0)), F.lit("NO. 5\nsmall words\nNow it starts"))
    return rows(spark, d, HEAD).select("o_orderkey", O.body_start(text).alias("first_line"))


@query("title_block", told(f"SELECT o_orderkey, CASE form WHEN 0 THEN '\"A word' || {NL} || 'of old.' WHEN 1 THEN 'Plain ' || name || {NL} || 'THE END' WHEN 2 THEN '' ELSE 'small ' || name || {NL} || {NL} || 'NO. 1' END AS body FROM h", h=HEAD))
def title_block(spark, d):
    head = F.concat(F.lit("THE GREAT THING\nNO. 3\n\nA SERMON DELIVERED ON "), "date", F.lit(",\nAT THE EXETER HALL.\nINTENDED FOR READING ON SUNDAY\n\n"))
    text = F.when(F.col("form") == 0, F.concat(head, F.lit('"A word\nof old.'))).when(F.col("form") == 1, F.concat(head, F.lit("Plain "), "name", F.lit("\nTHE END"))).when(F.col("form") == 2, head).otherwise(F.concat(F.lit("small "), "name", F.lit("\n\nNO. 1")))
    return rows(spark, d, HEAD).withColumn("ls", F.split(text, "\n", -1)).select("o_orderkey", F.array_join(X.strip_title_block(F.col("ls")), "\n").alias("body"))


# parts of outlines, from part
TOPIC = f"SELECT p_partkey AS doc_id, p_name AS name, lower(p_type) AS kind, 'John ' || (p_partkey % 20 + 1) || ':' || (p_size + 1) AS one, 'Mark 1:' || (p_size + 1) AS two, {pick('a|b|c', 'p_partkey')} AS letter FROM {{part}}"
INIT = "array_to_string(list_transform(string_split({}, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


@query("divisions_roman", told(f"SELECT doc_id, CAST(pos AS INT) AS pos, CASE pos WHEN 0 THEN 'I' ELSE 'II' END AS numeral, CASE pos WHEN 0 THEN {INIT.format('name')} ELSE {INIT.format('kind')} || ' Mark 1' END AS heading, CASE pos WHEN 0 THEN one ELSE two END AS refs FROM t, range(2) r(pos)", t=TOPIC))
def divisions_roman(spark, d):
    body = F.concat(F.lit("x\nI. "), "name", F.lit("\n\nsee "), "one", F.lit(" and "), "one", F.lit(".\nII. "), "kind", F.lit("\n"), "two")
    return P.divisions(dealt(rows(spark, d, TOPIC), "doc_id").select("doc_id", body.alias("body"))).select("doc_id", "pos", "numeral", "heading", F.array_join("refs", "|").alias("refs"))


@query("divisions_fallback", told(f"SELECT doc_id, CAST(pos AS INT) AS pos, CASE pos WHEN 0 THEN 'I' ELSE 'II' END AS numeral, CASE pos WHEN 0 THEN 'We See ' || {INIT.format('name')} ELSE {INIT.format('kind')} END AS heading FROM t, range(2) r(pos)", t=TOPIC))
def divisions_fallback(spark, d):
    body = F.concat(F.lit("x\nFirst, we see "), "name", F.lit(". More\nIn the second place, "), "kind")
    return P.divisions(dealt(rows(spark, d, TOPIC), "doc_id").select("doc_id", body.alias("body"))).select("doc_id", "pos", "numeral", "heading")


@query("divisions_topics", told(f"SELECT doc_id, CAST(0 AS INT) AS pos, 'I' AS numeral, 'Here is a ' || {INIT.format('name')} AS heading, length(name) + 573 AS section_length FROM t", t=TOPIC))
def divisions_topics(spark, d):
    body = F.concat(F.repeat(F.lit("a"), F.lit(501)), F.lit("\n\nHere is a "), "name", F.lit(" that stands long enough to count. And another one follows.\n"))
    parts = P.divisions(dealt(rows(spark, d, TOPIC), "doc_id").select("doc_id", body.alias("body")))
    return parts.select("doc_id", "pos", "numeral", "heading", F.length("section").cast("long").alias("section_length"))


@query("division_points", told("SELECT doc_id, 'Alpha ' || name || ' gamma delta.|Second point of ' || kind || ' and all.' AS points FROM t", t=TOPIC))
def division_points(spark, d):
    section = F.concat(F.lit("head\n1. Alpha "), "name", F.lit(" gamma delta.\n2. Second point of "), "kind", F.lit(" and all.\n3. Short one."))
    return dealt(rows(spark, d, TOPIC), "doc_id").select("doc_id", F.array_join(O.subpoints(section), "|").alias("points"))


@query("illustrations", told("SELECT doc_id, CAST(1 AS INT) AS pos, 'A ' || name || ' falls in his field' AS illustration FROM t", t=TOPIC))
def illustrations(spark, d):
    body = F.concat(F.lit("x\nSuppose a "), "name", F.lit(" falls in his field, then waits. So."))
    return P.illustrations(rows(spark, d, TOPIC).select("doc_id", body.alias("body")))


BROKEN = "SELECT p_partkey, split_part(p_name, ' ', 2) AS w, CAST(2 + p_partkey % 3 AS INT) AS n FROM {part}"


@query("broken_words", told("SELECT p_partkey, 'the ' || CASE WHEN length(w) > n THEN w ELSE w || ' ' END || ', so' AS line FROM b", b=BROKEN))
def broken_words(spark, d):
    words = rows(spark, d, "SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM {part} UNION SELECT 'the' UNION SELECT 'so'")
    lines = rows(spark, d, f"SELECT p_partkey, 'the ' || substr(w, 1, n) || ' ' || substr(w, n + 1) || ', so' AS line FROM ({BROKEN})")
    return P.join_broken_words(lines, "line", words)


@query("clean_text", told("SELECT p_partkey AS doc_id, 'the ' || CASE WHEN length(w) > n THEN w ELSE w || ' ' END || ', solid ' || w || chr(10) || 'end' AS text FROM b", b=BROKEN))
def clean_text(spark, d):
    words = rows(spark, d, "SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM {part} UNION SELECT 'the' UNION SELECT 'so'")
    docs = rows(spark, d, f"SELECT p_partkey AS doc_id, 'the ' || substr(w, 1, n) || ' ' || substr(w, n + 1) || ', so-' || chr(10) || ' lid ' || w || chr(10) || 'end' AS text FROM ({BROKEN})")
    return P.clean_text(docs, words)


HYPHENATED = "(SELECT doc_id, string_split(regexp_replace(text, '([a-z])e ', '\\1-' || chr(10), 'g'), chr(10)) AS l FROM documents)"


@query("dehyphenate", rf"""WITH x AS (SELECT doc_id, i, l[i] AS line, regexp_matches(l[i], '[A-Za-z]-$') AND i < len(l) AS h FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM {HYPHENATED})),
r AS (SELECT *, i - coalesce(max(CASE WHEN NOT h THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM x),
g AS (SELECT doc_id, i, line, h, CASE WHEN k % 2 = 0 THEN i - 1 ELSE i END AS g FROM r)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS INT) AS pos, line FROM (SELECT doc_id, g, CASE WHEN count(*) = 1 THEN min(line) ELSE rtrim(arg_min(line, i), '-') || ltrim(arg_max(line, i)) END AS line FROM g GROUP BY doc_id, g)""")
def dehyphenate(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", F.split(F.regexp_replace("text", "([a-z])e ", "$1-\n"), "\n", -1).alias("l")).transform(lambda x: D.exploded(x, X.dehyphenate(F.col("l")), "line"))


# page layouts: a document's lines, from orders
LAYOUT = """SELECT doc, line_no, CASE WHEN line_no > 12 THEN 2 ELSE 1 END AS page_no, k, CAST(CASE (k * 7) % 9 WHEN 0 THEN 160.0 WHEN 1 THEN 160.4 WHEN 2 THEN 68.0 WHEN 3 THEN 54.4 ELSE 54.0 END AS DOUBLE) AS x0,
CAST(line_no * 16 + CASE WHEN k % 13 = 0 THEN 40 ELSE 0 END - CASE WHEN line_no > 12 THEN 190 ELSE 0 END AS DOUBLE) AS y0, CAST(line_no * 16 + 10 + CASE WHEN k % 13 = 0 THEN 40 ELSE 0 END - CASE WHEN line_no > 12 THEN 190 ELSE 0 END AS DOUBLE) AS y1,
CAST(CASE k % 5 WHEN 0 THEN 12.0 WHEN 1 THEN 13.9 ELSE 14.0 END AS DOUBLE) AS size FROM (SELECT CAST((o_orderkey - o_orderkey % 23) / 23 AS INT) AS doc, CAST(o_orderkey % 23 + 1 AS INT) AS line_no, o_orderkey AS k FROM {orders})"""
@query("paragraph_islands", told("""SELECT doc, x.line_no, x.para_id, x.kind FROM (SELECT doc, unnest((list_reduce(ls, lambda s, x: {{para: s.para + CASE WHEN s.kind = '' OR x.y0 - s.y1 > 24 OR (x.y0 - s.y1 < -50 AND x.rx > 64) OR x.verse <> (s.kind = 'verse') OR (x.rx > 64 AND x.rx < 74 AND NOT x.verse AND x.size >= 13.5 AND s.kind = 'body') THEN 1 ELSE 0 END,
kind: CASE WHEN s.kind = '' OR x.y0 - s.y1 > 24 OR (x.y0 - s.y1 < -50 AND x.rx > 64) OR x.verse <> (s.kind = 'verse') OR (x.rx > 64 AND x.rx < 74 AND NOT x.verse AND x.size >= 13.5 AND s.kind = 'body') THEN CASE WHEN x.verse THEN 'verse' WHEN x.rx >= 154 THEN 'blockquote' ELSE 'body' END ELSE s.kind END, y1: x.y1,
o: list_append(s.o, {{line_no: x.n, para_id: s.para + CASE WHEN s.kind = '' OR x.y0 - s.y1 > 24 OR (x.y0 - s.y1 < -50 AND x.rx > 64) OR x.verse <> (s.kind = 'verse') OR (x.rx > 64 AND x.rx < 74 AND NOT x.verse AND x.size >= 13.5 AND s.kind = 'body') THEN 1 ELSE 0 END, kind: CASE WHEN s.kind = '' OR x.y0 - s.y1 > 24 OR (x.y0 - s.y1 < -50 AND x.rx > 64) OR x.verse <> (s.kind = 'verse') OR (x.rx > 64 AND x.rx < 74 AND NOT x.verse AND x.size >= 13.5 AND s.kind = 'body') THEN CASE WHEN x.verse THEN 'verse' WHEN x.rx >= 154 THEN 'blockquote' ELSE 'body' END ELSE s.kind END}})}}, {{para: 0, kind: '', y1: CAST(0 AS DOUBLE), o: CAST([] AS STRUCT(line_no INT, para_id INT, kind VARCHAR)[])}})).o) AS x
FROM (SELECT doc, list({{n: line_no, rx: round_even(x0, 0), y0: y0, y1: y1, size: size, verse: round_even(x0, 0) >= 154 AND size <= 13}} ORDER BY line_no) AS ls FROM l GROUP BY doc))""", l=LAYOUT))
def paragraph_islands(spark, d):
    lines = rows(spark, d, LAYOUT).select("doc", "line_no", "x0", "y0", "y1", "size")
    return D.paragraph_islands(lines, 54.0, 16.0).select("doc", "line_no", F.col("para_id").cast("int").alias("para_id"), "kind")


@query("layout_metrics", told("""SELECT doc, arg_min(v, (-n, f)) AS margin, any_value(spacing) AS spacing FROM (SELECT doc, round_even(x0, 0) AS v, count(*) AS n, min(line_no) AS f FROM l GROUP BY 1, 2) JOIN (SELECT doc, coalesce(list_sort(list(g) FILTER (WHERE g > 0 AND g < 30))[count(*) FILTER (WHERE g > 0 AND g < 30) // 2 + 1], 16.0) AS spacing FROM (SELECT doc, y0 - lag(y0) OVER (PARTITION BY doc ORDER BY line_no) AS g FROM l) GROUP BY doc) USING (doc) GROUP BY doc""", l=LAYOUT))
def layout_metrics(spark, d):
    return D.layout_metrics(rows(spark, d, LAYOUT), "doc")


WORDED = f"SELECT *, CASE WHEN line_no <= 2 + doc % 3 THEN 'HEAD' WHEN line_no = 6 AND doc % 2 = 0 THEN '“Words' WHEN k % 17 = 0 THEN ' ' ELSE 'Body' END AS text FROM ({LAYOUT})"


@query("layout_roles", told("""SELECT l.doc, line_no, CASE WHEN quote IS NOT NULL AND (start IS NULL OR quote <= start) THEN CASE WHEN line_no >= coalesce(stop, 1000) THEN 'body' WHEN line_no >= quote AND trim(text) <> '' THEN 'scripture' ELSE 'metadata' END WHEN line_no >= coalesce(start, 1) THEN 'body' ELSE 'metadata' END AS role
FROM l JOIN (SELECT doc, min(line_no) FILTER (WHERE text = '“Words') AS quote, min(line_no) FILTER (WHERE text <> 'HEAD' AND trim(text) <> '' AND size >= 13.5 AND round_even(x0, 0) <= 74) AS start FROM l GROUP BY doc) a ON a.doc = l.doc LEFT JOIN (SELECT x.doc, min(x.line_no) AS stop FROM l x JOIN l y ON x.doc = y.doc AND y.text = '“Words' AND x.line_no >= y.line_no WHERE trim(x.text) <> '' AND x.size >= 13.5 GROUP BY x.doc) b ON b.doc = l.doc""", l=WORDED))
def layout_roles(spark, d):
    lines = rows(spark, d, WORDED).select("doc", "line_no", "text", "size", "x0")
    return P.layout_roles(lines, F.col("text") == "HEAD", 54.0).select("doc", "line_no", "role")


PRINTED = f"SELECT doc, line_no, page_no, CAST(CASE WHEN line_no IN (12, 23) THEN 720 ELSE line_no * 10 END AS DOUBLE) AS y0, size, CASE WHEN line_no IN (1, 4, 13) THEN 'Volume ' || doc WHEN line_no IN (2, 12) THEN '12' WHEN line_no = 5 AND doc % 2 = 0 THEN 'on Volume 9' WHEN line_no IN (22, 11) THEN 'Spanish translations' WHEN line_no = 21 THEN 'By the GRACE of God' WHEN k % 13 = 0 THEN '  ' ELSE 'Body ' || k END AS text FROM (SELECT doc, line_no, page_no, k, CASE WHEN k % 19 = 0 THEN 10.5 ELSE size END AS size FROM ({LAYOUT}))"


@query("layout_scan", told("""SELECT doc, page_no, line_no, text FROM (SELECT *, min(CASE WHEN promo THEN 1 ELSE 0 END) OVER (PARTITION BY doc, page_no ORDER BY line_no DESC) AS tail, max(page_no) OVER (PARTITION BY doc) AS last FROM (SELECT *, sum(CASE WHEN header THEN 1 ELSE 0 END) OVER (PARTITION BY doc, page_no ORDER BY line_no) AS headers
FROM (SELECT *, regexp_matches(text, '^[0-9]+$|Volume [0-9]+') AS header, lower(text) IN ('spanish translations', 'by the grace of god') AS promo FROM l WHERE trim(text) <> '' AND size > 10.5) WHERE NOT (y0 > 712 AND size <= 12 AND (header OR promo))) WHERE NOT (header AND headers <= 3)) WHERE NOT (page_no = last AND tail = 1)""", l=PRINTED))
def layout_scan(spark, d):
    lines = rows(spark, d, PRINTED).withColumn("page_height", F.lit(792.0)).withColumn("spans", F.expr("array(named_struct('text', '', 'size', 30.0D), named_struct('text', text, 'size', double(size)))"))
    return D.layout_lines(lines.select("doc", "page_no", "line_no", "page_height", "y0", "spans"), "doc", X.header_line, X.promo_line).select("doc", "page_no", "line_no", "text")


TRIMMED = f"SELECT doc, line_no, CASE WHEN line_no <= doc % 5 THEN 'Volume ' || doc WHEN line_no > 23 - doc % 4 AND line_no % 2 = 0 THEN '' WHEN line_no > 23 - doc % 4 THEN 'Visit our site' ELSE 'Body ' || k END AS line FROM ({LAYOUT})"


@query("boilerplate_trim", told("SELECT doc, line_no, line FROM l WHERE line_no > least(2, doc % 5) AND line_no <= (SELECT max(x.line_no) FROM l x WHERE x.doc = l.doc AND x.line <> '' AND x.line <> 'Visit our site')", l=TRIMMED))
def boilerplate_trim(spark, d):
    return D.boilerplate_trim(rows(spark, d, TRIMMED), F.regexp_like("line", F.lit(r"(?i)^\d{1,4}\s*$|Volume\s*\d+")), F.contains(F.lower("line"), F.lit("visit our site")))


STYLED = f"SELECT doc, line_no, CASE WHEN k % 6 = 0 THEN ' ' ELSE 'a&' || k END AS text, CAST(CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 0 END AS INT) AS flags FROM ({LAYOUT})"
HTML = "CASE WHEN text = ' ' THEN text WHEN flags = 18 THEN '<strong><em>' || replace(text, '&', '&amp;') || '</em></strong>' WHEN flags = 2 THEN '<em>' || replace(text, '&', '&amp;') || '</em>' WHEN flags = 16 THEN '<strong>' || replace(text, '&', '&amp;') || '</strong>' ELSE replace(text, '&', '&amp;') END"


@query("span_html", told(f"SELECT doc, string_agg({HTML}, '' ORDER BY line_no) AS html FROM s GROUP BY doc", s=STYLED))
def span_html(spark, d):
    one = F.struct("line_no", "text", S.is_italic(F.col("flags")).alias("italic"), S.is_bold(F.col("flags")).alias("bold"))
    return rows(spark, d, STYLED).groupBy("doc").agg(F.array_sort(F.collect_list(one)).alias("s")).select("doc", M.spans_html(F.col("s")).alias("html"))


# lines of one span each, of which some end in a hyphen: a whole page to its markup
PAGE = f"SELECT doc, line_no, 1 AS page_no, k, CAST(line_no * 16 + CASE WHEN line_no > 14 THEN 80 WHEN line_no > 10 THEN 40 ELSE 0 END AS DOUBLE) AS y0, CAST(CASE WHEN line_no IN (3, 19) THEN 12 ELSE 14 END AS DOUBLE) AS size, CAST(CASE WHEN line_no IN (15, 19) THEN 160 WHEN line_no = 8 THEN 70 ELSE 54 END AS DOUBLE) AS x0, CASE WHEN line_no = 1 THEN 'THE HEAD' WHEN line_no = 2 THEN 'NO. 4' WHEN line_no = 3 THEN '“A word' WHEN line_no = 5 THEN 'bro-' WHEN line_no = 6 THEN 'ken & OLD thing' ELSE 'body ' || k END AS text FROM ({LAYOUT})"


@query("layout_html", told("""SELECT doc, CASE WHEN bool_or(p = 0) THEN '<h2>“A word</h2>' || chr(10) ELSE '' END || string_agg(h, chr(10) ORDER BY p) FILTER (WHERE p > 0) || chr(10) AS html FROM (SELECT doc, p, CASE p WHEN 4 THEN '<blockquote>' WHEN 5 THEN '<div class="verse">' ELSE '<p>' END || replace(replace(replace(string_agg(text, ' ' ORDER BY line_no), 'bro- ken', 'broken'), '&', '&amp;'), 'OLD thing', 'Old thing') || CASE p WHEN 4 THEN '</blockquote>' WHEN 5 THEN '</div>' ELSE '</p>' END AS h
FROM (SELECT *, CASE WHEN line_no = 3 THEN 0 WHEN line_no < 8 THEN 1 WHEN line_no < 11 THEN 2 WHEN line_no < 15 THEN 3 WHEN line_no < 19 THEN 4 WHEN line_no = 19 THEN 5 ELSE 6 END AS p FROM l WHERE line_no > 2) GROUP BY doc, p) GROUP BY doc""", l=PAGE))
def layout_html(spark, d):
    lines = rows(spark, d, PAGE).select("doc", "page_no", "line_no", F.lit(792.0).alias("page_height"), "x0", "y0", (F.col("y0") + 10).alias("y1"), F.expr("array(named_struct('text', text, 'italic', false, 'bold', false, 'size', size))").alias("spans"))
    return P.layout_html(lines, "doc")


BLOCKS = "SELECT CAST((o_orderkey - o_orderkey % 10) / 10 AS INT) AS document, CAST(o_orderkey % 10 AS INT) AS block_no, CAST(o_custkey % 3 AS INT) AS type, o_orderpriority AS text FROM {orders}"


@query("text_blocks", told("SELECT document, 1 AS page_no, block_no, CAST(k AS INT) AS line_no, CASE k WHEN 0 THEN text ELSE 'x' || text END AS text FROM b, range(2) r(k) WHERE type = 0", b=BLOCKS))
def text_blocks(spark, d):
    line = lambda *texts: F.struct(F.array(*[F.struct(t.alias("text")) for t in texts]).alias("spans"))
    lines = F.array(line(F.col("text"), F.lit("")), line(F.lit("x"), F.col("text")), line(F.lit("")))
    blocks = rows(spark, d, BLOCKS).select("document", F.lit(1).alias("page_no"), "block_no", "type", lines.alias("lines"))
    return S.text_blocks(blocks).select("document", "page_no", "block_no", "line_no", F.array_join(F.col("spans.text"), "").alias("text"))


# single lines, from orders; the patterns are rows too
LINES = "SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN CAST(o_orderkey AS VARCHAR(9)) WHEN 1 THEN 'Sermon #' || o_orderkey WHEN 2 THEN 'see volume ' || o_custkey || ' there' WHEN 3 THEN 'No. ' || o_orderkey WHEN 4 THEN 'A SERMON DELIVERED x' WHEN 5 THEN 'THE ' || o_orderpriority WHEN 6 THEN 'Plain ' || o_orderpriority WHEN 7 THEN ' ' WHEN 8 THEN 'on Sunday' WHEN 9 THEN 'They pray the Holy Spirit will' WHEN 10 THEN 'from www.example.org' ELSE 'The Old Pulpit, ' || o_orderkey END AS line FROM {orders}"
PATTERNS = r"SELECT explode(array('Sermon\\s*#\\s*\\d+', '(Old Pulpit|New Pulpit)', 'Volume\\s*\\d+', 'www\\.example\\.org')) AS pattern"


@query("header_filter", told(r"SELECT o_orderkey, regexp_matches(trim(line), '(?i)^[0-9]{{1,4}}$|Sermon\s*#\s*[0-9]+|Volume\s*[0-9]+|(old|new) pulpit|www\.example\.org') AS header, trim(line) = '' OR regexp_matches(line, '(?i)^\s*(NO\.\s*[0-9]|A\s+SERMON|ON\s+SUNDAY)') OR (length(regexp_replace(line, '[^A-Za-z]', '', 'g')) >= 3 AND length(regexp_replace(line, '[^A-Z]', '', 'g')) > 0.8 * length(regexp_replace(line, '[^A-Za-z]', '', 'g'))) AS metadata FROM l", l=LINES))
def header_filter(spark, d):
    from vellum.functions.lexicons import rows_of

    patterns = tuple(p for (p,) in rows_of(spark.sql(PATTERNS)))
    return rows(spark, d, LINES).select("o_orderkey", X.header_line(F.col("line"), patterns).alias("header"), X.metadata_line(F.col("line")).alias("metadata"))


@query("promo_filter", told("SELECT o_orderkey, line FROM l WHERE NOT contains(lower(line), 'pray the holy spirit') AND NOT contains(lower(line), 'www.example.org')", l=LINES))
def promo_filter(spark, d):
    return rows(spark, d, LINES).where(~X.promo_line(F.col("line"), (*X.PROMOTION, "WWW.example.org")))


# speech, from conversations
SPEECH = """SELECT conv_id, turn, '<speak><prosody rate="slow" pitch="-' || turn || '%"><p>' || repeat('<s>One,<break time="400ms"/> ' || role || '.</s>', CAST(turn AS INT) + 1) || '</p><break time="' || (turn * 100) || 'ms"/><p><s><sub alias="b">B</sub></s></p></prosody></speak>' AS ssml FROM {conversations}"""


@query("prosody_strip", told("SELECT conv_id, turn, regexp_replace(ssml, '<prosody[^>]*>|</prosody>', '', 'g') AS inner_ssml FROM s", s=SPEECH))
def prosody_strip(spark, d):
    return rows(spark, d, SPEECH).select("conv_id", "turn", X.prosody_inner(F.col("ssml")).alias("inner_ssml"))


@query("ssml_stats", told("SELECT conv_id, turn, 2 AS paragraphs, CAST(turn + 2 AS INT) AS sentences, CAST(turn + 2 AS INT) AS breaks, 1 AS aliases, CAST(400 * (turn + 1) + 100 * turn AS BIGINT) AS pause_ms FROM s", s=SPEECH))
def ssml_stats(spark, d):
    return rows(spark, d, SPEECH).select("conv_id", "turn", M.speech_stats(F.col("ssml")).alias("x")).select("conv_id", "turn", "x.*")


@query("tts_request", told("""SELECT conv_id, turn, '{{"text":"' || replace(inner_ssml, '"', '\\"') || '","model_id":"multilingual","voice_settings":{{"stability":0.75,"similarity_boost":0.85,"style":0.15,"use_speaker_boost":true,"speed":0.85}}}}' AS request FROM (SELECT conv_id, turn, regexp_replace(ssml, '<prosody[^>]*>|</prosody>', '', 'g') AS inner_ssml FROM s)""", s=SPEECH))
def tts_request(spark, d):
    return D.speech_requests(rows(spark, d, SPEECH), "ssml", "multilingual").select("conv_id", "turn", "request")
