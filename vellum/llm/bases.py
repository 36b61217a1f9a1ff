"""The parts of the operators' results that SQL can express, as queries of their own with their SQL: what the rules and fixed formats alone decide."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vellum.llm.licenses import BASE, op3_licenses
from vellum.llm.pii import op9_pii
from vellum.llm.secrets import secret_formats
from vellum.llm.urls import RULES, op1_urls

ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def url_rules(spark, sf_dir: str) -> DataFrame:
    return op1_urls(spark, sf_dir).select("page_id", "host", "path", "rule")


def _rule_cases() -> str:
    out = ""
    for _, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, rest = rule.partition("/")
        out += f" WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}') THEN '{rule}'"
    return f"CASE{out} END"


URL_SQL = f"""WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {ASCII}) AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r)
SELECT page_id, host, path, {_rule_cases()} AS rule FROM h"""


def license_phrases(spark, sf_dir: str) -> DataFrame:
    return op3_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def _phrase_places(phrase: str, label: str) -> str:
    words = phrase.split()
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_transform(list_filter(range(len(w) - {len(words) - 1}), lambda i: w[i + 1:i + {len(words)}] = [{listed}]), lambda i: {{'at': i, 'label': '{label}'}})"


LICENSE_SQL = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {ASCII}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
f AS (SELECT doc_id, w, list_concat({", ".join(_phrase_places(p, x) for p, x in list(BASE.items())[:2])}) AS a, {_phrase_places(*list(BASE.items())[2])} AS b FROM d),
s AS (SELECT doc_id, w, list_concat(a, b) AS f FROM f)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(f) AS BIGINT) AS n_base, CAST(list_min(list_transform(f, lambda x: x.at)) AS BIGINT) AS first_word, CAST(list_max(list_transform(f, lambda x: x.at)) AS BIGINT) AS last_word,
array_to_string(list_sort(list_distinct(list_transform(f, lambda x: x.label))), ',') AS base_labels FROM s"""


def _spans(rank: int, kind: str, pattern: str, good: str) -> tuple[str, str]:
    """(columns of pieces and hits, list of the spans) of a kind; good: a condition on the hit, written @V."""
    quoted = pattern.replace("'", "''")
    columns = f"string_split_regex(t, '{quoted}') AS p{rank}, regexp_extract_all(t, '{quoted}') AS h{rank}"
    before = f"list_sum(list_transform(p{rank}[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(h{rank}[1:k - 1], lambda x: length(x))), 0)"
    found = f"list_transform(range(1, len(h{rank}) + 1), lambda k: {{'at': CAST({before} AS BIGINT), 'rank': {rank}, 'kind': '{kind}', 'v': h{rank}[k]}})"
    return columns, f"list_filter({found}, lambda x: {good.replace('@V', 'x.v')})"


def _span_sql(kinds: list[tuple[str, str, str]], by_kind: bool) -> str:
    parts = [_spans(i, *k) for i, k in enumerate(kinds)]
    cte = "WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), c AS (SELECT doc_id, " + ", ".join(c for c, _ in parts) + " FROM t), "
    cte += "s AS (SELECT doc_id, " + ", ".join(f"{s} AS s{i}" for i, (_, s) in enumerate(parts)) + " FROM c), "
    cte += "a AS (SELECT doc_id, " + ", ".join(f"CAST(len(s{i}) AS BIGINT) AS n_{k[0]}" for i, k in enumerate(kinds)) + ", flatten([" + ", ".join(f"s{i}" for i in range(len(kinds))) + "]) AS f FROM s) "
    order = "{'a': x.rank, 'b': x.at, 'x': x}" if by_kind else "{'a': x.at, 'b': x.rank, 'x': x}"
    line = f"array_to_string(list_transform(list_sort(list_transform(f, lambda x: {order})), lambda y: y.x.kind || ':' || y.x.at || ':' || (y.x.at + length(y.x.v))), ',')"
    return cte + "SELECT doc_id, " + ", ".join(f"n_{k[0]}" for k in kinds) + f", sha256({line}) AS base_sha256 FROM a"


_NAME = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
SECRET_SQL = _span_sql([
    ("assign", _NAME + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(@V, '^{_NAME.replace(chr(39), chr(39) * 2)}', '')) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "length(@V) >= 16"),
    ("hex", "[0-9a-f]+", "length(@V) >= 32"),
], False)


def pii_formats(spark, sf_dir: str) -> DataFrame:
    return op9_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


_DIGITS = "regexp_replace(@V, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INT) ELSE (2 * CAST(substr(reverse({_DIGITS}), i, 1) AS INT)) % 10 + (2 * CAST(substr(reverse({_DIGITS}), i, 1) AS INT)) // 10 END)) % 10 = 0"
PII_SQL = _span_sql([
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(@V, '.'), lambda y: NOT (regexp_matches(y, '^0*[0-9]{1,3}$') AND CAST(right(y, 3) AS INT) <= 255))) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
], True)

QUERIES = {"url_rules": url_rules, "license_phrases": license_phrases, "secret_formats": secret_formats, "pii_formats": pii_formats}
ORACLES = {"url_rules": URL_SQL, "license_phrases": LICENSE_SQL, "secret_formats": SECRET_SQL, "pii_formats": PII_SQL}
