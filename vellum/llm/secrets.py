"""Secret scans: fixed credential formats, and a randomness test battery for everything else.

Maximal runs of 20 or more base-64 characters with at least one digit and one letter are candidates (runs of letters only are words, of digits only numbers). Each gets an inferred encoding (hex, base 32 or
base 64), and three tests against a uniformly random string of it: chi-squared uniformity over the alphabet
(Wilson-Hilferty), Wald-Wolfowitz runs about the alphabet's middle, and lag-1 serial correlation. Fisher's method
combines their p-values; a candidate may count only if that is RANDOM_P or more, so if it is not told from a random string.

That proves little for short strings, so false discoveries are controlled by length. All words of every text (and of the licence notices, so that no band is without), capitalised, joined, cut one after
another into strings whose lengths run through the bands, and given a number as in identifiers, are natural strings and go through the same tests; the cube roots of their Fisher sums are nearly normal. A
candidate's p-value is the chance that a natural string of its band is as random. The Benjamini-Hochberg rule over a band's candidates, at FALSE_SHARE and with Storey's estimate of how many are natural, picks
those that count: each on its own p-value, so a band is never dropped as a whole. p-values are counted in classes of a tenth of a power of ten, rounded up. Only DataFrame
functions are used; the bands and classes are tables of bounded size, joined back by broadcast.

Cases: a null text is empty and has no spans. Rows are told apart by doc_id and a hash of the text; rows that repeat
both give equal results. An empty table gives an empty result. Other columns may have any name. Ties: candidates of one class count or go together. Very long texts and
runs are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import empty_safe, keep, maybe_broadcast
from vellum.llm.licenses import TEMPLATES
from vellum.llm.spans import count_of, find, joined, labelled, overlaps

ASSIGN = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LIKELY = r"(?:[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
#: A run of the class that reaches the least length does so from its start, so the bounded forms match the same.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?:\G|(?<![0-9a-f]))[0-9a-f]{32,}+"
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9+/=_-]))[A-Za-z0-9+/=_-]{20,}+"
RANDOM_P = 0.01
FALSE_SHARE = 0.05
#: Least spread that natural strings of a band are held to have.
MIN_SPREAD = 0.3
BANDS = (20, 22, 24, 26, 28, 30, 32, 34, 36, 38, 40, 42, 44, 46, 48, 52, 56, 64, 80, 96)
#: Letters of the natural strings cut from a text, in turn: 16 to 115, each once, short and long ones mixed. Where each begins in a round, and the letters of a round.
LETTERS = [16 + 37 * k % 100 for k in range(100)]
STARTS, ROUND = [sum(LETTERS[:k]) for k in range(100)], sum(LETTERS)
#: Most classes of p-values.
CLASSES = 300
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the fixed formats, in the listing order of kinds."""
    assign = find(text, ASSIGN, F.regexp_like(text, F.lit(ASSIGN_LIKELY)))
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    return {
        "assign": F.filter(assign, lambda s: F.length(value(s)) >= 8),
        "access": find(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": find(text, HEX, F.lit(True)),
    }


def normal_tail(z: Column) -> Column:
    """P(Z > |z|), by a rational approximation of absolute error under 1e-7."""
    a = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + a * 0.2316419)
    poly = t * (t * (t * (t * (t * 1.330274429 - 1.821255978) + 1.781477937) - 0.356563782) + 0.319381530)
    return F.exp(-a * a / 2) * poly / math.sqrt(2 * math.pi)


def battery(df: DataFrame, value: Column) -> DataFrame:
    """df with column t, struct(encoding, p_chi, p_runs, p_serial, p, h): the tests of strings of 20 characters or more.

    Strings are coded with the alphabet's places as characters; the stages below keep each a column of its own."""
    rest = df.columns
    body = F.rtrim(value, F.lit("="))
    df = df.select(*rest, F.when(F.regexp_like(body, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$")), "hex").when(F.regexp_like(body, F.lit("^[A-Z2-7]+$")), "base32").otherwise("base64").alias("__enc"), body.alias("__body"))
    enc = F.col("__enc")
    pick = lambda make: F.when(enc == "hex", make("hex")).when(enc == "base32", make("base32")).otherwise(make("base64"))
    spelt = {name: (abc + {"hex": "ABCDEF", "base32": "", "base64": "-_="}[name], list(range(1, len(abc) + 1)) + {"hex": list(range(11, 17)), "base32": [], "base64": [63, 64, 63]}[name]) for name, abc in ALPHABETS.items()}
    coded = lambda code: pick(lambda name: F.translate("__body", spelt[name][0], "".join(code(v, len(ALPHABETS[name])) for v in spelt[name][1])))
    df = df.select(*rest, "__enc", pick(lambda name: F.lit(float(len(ALPHABETS[name])))).alias("__k"), coded(lambda v, _: chr(v)).alias("__codes"), coded(lambda v, k: "h" if v > k / 2 else "l").alias("__ups"))
    df = df.select(*rest, "__enc", "__k", "__codes", "__ups", F.split("__codes", "").alias("__chars"))

    place = lambda c: F.ascii(c).cast("long")
    left = lambda text, c: F.octet_length(text) - F.octet_length(F.replace(F.col(text), c, F.lit("")))
    total = lambda values, of: F.aggregate(values, F.lit(0).cast("long"), lambda t, x: t + of(x))
    counted = F.aggregate(F.array_distinct("__chars"), F.lit(0.0), lambda t, c: t + F.pow(left("__codes", c), F.lit(2.0)))
    runs = 1 + (left("__ups", F.lit("hl")) + left("__ups", F.lit("lh"))) / 2
    df = df.select(*rest, "__enc", "__k", "__codes", left("__ups", F.lit("h")).cast("double").alias("__high"), runs.alias("__runs"), counted.alias("__counted"), F.transform("__chars", place).alias("__v"))
    v = F.col("__v")
    lagged = F.zip_with(F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, F.lit(2), F.size(v)), lambda x, y: x * y)
    sums = {"n": F.size(v), "sum": total(v, lambda x: x), "squares": total(v, lambda x: x * x), "lagged": total(lagged, lambda x: x), "high": F.col("__high"), "runs": F.col("__runs"), "last": place(F.substring("__codes", -1, 1)), "first": place(F.col("__codes"))}
    df = df.select(*rest, "__enc", "__k", F.struct(*[x.cast("double").alias(name) for name, x in sums.items()]).alias("__f"), "__counted")
    f, k = (lambda x: F.col(f"__f.{x}")), F.col("__k")
    n = F.greatest(f("n"), F.lit(1.0))
    chi, free = k / n * F.col("__counted") - n, k - 1
    z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    mean_runs = 2 * f("high") * (n - f("high")) / n + 1
    spread = (mean_runs - 1) * (mean_runs - 2) / F.greatest(n - 1, F.lit(1.0))
    mean = f("sum") / n
    variance = f("squares") - n * mean * mean
    covariance = f("lagged") - mean * (2 * f("sum") - f("first") - f("last")) + (n - 1) * mean * mean
    df = df.select(*rest, "__enc", z_chi.alias("__zc"), F.when(spread > 1e-9, (f("runs") - mean_runs) / F.sqrt(spread)).otherwise(F.lit(9.0)).alias("__zr"), F.when(variance > 1e-9, covariance / variance * F.sqrt(n)).otherwise(F.lit(9.0)).alias("__zs"))
    p_chi = F.when(F.col("__zc") > 0, normal_tail(F.col("__zc"))).otherwise(1 - normal_tail(F.col("__zc")))
    least = lambda p: F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-12))
    df = df.select(*rest, "__enc", least(p_chi).alias("p_chi_"), least(2 * normal_tail(F.col("__zr"))).alias("p_runs_"), least(2 * normal_tail(F.col("__zs"))).alias("p_serial_"))
    df = df.select(*rest, "__enc", "p_chi_", "p_runs_", "p_serial_", (-F.ln("p_chi_") - F.ln("p_runs_") - F.ln("p_serial_")).alias("__h"))
    h = F.col("__h")  # half of Fisher's statistic, of six degrees of freedom
    t = F.struct(enc.alias("encoding"), F.col("p_chi_").alias("p_chi"), F.col("p_runs_").alias("p_runs"), F.col("p_serial_").alias("p_serial"), (F.exp(-h) * (1 + h + h * h / 2)).alias("p"), h.alias("h"))
    return df.select(*rest, t.alias("t"))


def band_of(value: Column) -> Column:
    band = F.lit(0)
    for least in BANDS:
        band = F.when(F.length(value) >= least, F.lit(least)).otherwise(band)
    return band


def natural_strings(docs: DataFrame) -> DataFrame:
    """(value): natural strings of all words of every text, and some of the licence notices.

    Each ASCII letter of a text is in a string, if it has the 16 that the shortest takes; only its last 16 may be in two. A text's first length is given by its hash,
    so that short texts serve all bands. Rounds are cut first, and strings from their bytes, so that no string is looked for from its text's start."""
    text = empty_safe(F.col("text").cast("string"))
    letters = F.replace(F.initcap(F.regexp_replace(text, "[^A-Za-z]+", " ")), F.lit(" "), F.lit(""))
    cuts = F.array(*[F.lit(x) for x in STARTS])
    rows = docs.select(letters.alias("letters"), F.element_at(cuts, (1 + F.pmod(F.xxhash64(text), F.lit(len(LETTERS)))).cast("int")).alias("skipped"))
    least = min(LETTERS)
    rounds = F.regexp_extract_all(F.concat(F.repeat(F.lit("_"), F.col("skipped")), "letters"), F.lit(f".{{{ROUND}}}(?=.{{{least}}})|.{{1,{ROUND + least - 1}}}"), F.lit(0))
    rows = rows.select(F.explode(rounds.cast("array<binary>")).alias("round"))
    places = F.array(*[F.struct(F.lit(at).alias("at"), F.lit(n).alias("n")) for at, n in zip([*STARTS, ROUND], [*LETTERS, least], strict=True)])
    rows = rows.select("round", F.octet_length("round").alias("size"), F.explode(places).alias("cut")).where(F.col("cut.at") < F.col("size"))
    # what is left at the end, if too short for a string, is taken with letters before it
    part = F.substring(F.col("round"), F.least(F.col("cut.at"), F.col("size") - least) + 1, F.col("cut.n")).cast("string")
    rows = rows.select(part.alias("part")).where((F.length("part") >= least) & ~F.startswith(F.col("part"), F.lit("_")))
    found = rows.select(F.concat("part", F.lpad(F.pmod(F.xxhash64("part"), F.lit(10_000)).cast("string"), 4, "0")).alias("value"))
    return found.unionByName(_of_notices(docs.sparkSession))


def _of_notices(spark: SparkSession) -> DataFrame:
    notices = [text.split() for _, text, _ in TEMPLATES if len(text) > 120]
    letters = ["".join(c for w in words[k:] + words[:k] for c in w.capitalize() if c.isascii() and c.isalpha()) for words in notices for k in range(0, len(words), 7)]
    return spark.createDataFrame([(f"{x[: least - 4]}{(k * 7919 + least) % 10_000:04d}",) for least in BANDS for k, x in enumerate(letters)], "value string")


def natural_levels(docs: DataFrame) -> DataFrame:
    """(band, mean, spread) of the cube roots of the Fisher sums of natural strings."""
    tested = battery(natural_strings(docs), F.col("value")).select(band_of(F.col("value")).alias("band"), F.cbrt("t.h").alias("r"))
    return tested.groupBy("band").agg(F.avg("r").alias("mean"), F.greatest(F.stddev("r"), F.lit(MIN_SPREAD)).alias("spread"))


def base_of(text: Column) -> Column:
    """The spans of the fixed formats as one array of (start, end, rank, kind)."""
    return F.concat(*[labelled(spans, kind, k) for k, (kind, spans) in enumerate(base_spans(text).items())])


def base_columns() -> list[Column]:
    """What is told of column base: counts and a digest."""
    return [*[count_of(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(joined(F.col("base"), False).cast("binary"), 256).alias("base_sha256")]


def secret_formats(spark, sf_dir: str) -> DataFrame:
    """The fixed formats of op5_secrets alone: no row needs another, so no string is tested and nothing shuffled."""
    text = empty_safe(F.col("text").cast("string"))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.alias("text"))
    return rows.select("doc_id", base_of(F.col("text")).alias("base")).select("doc_id", *base_columns())


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row of docs: arrays of (start, end, rank, kind); spans adds those of kind random."""
    text = empty_safe(F.col("text").cast("string"))
    rows = docs.select("doc_id", text.alias("text"))
    base = base_of(F.col("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), base.alias("base"), find(F.col("text"), CANDIDATE, F.lit(True)).alias("candidates"))
    mixed = lambda s: F.regexp_like(s["value"], F.lit("[0-9]")) & F.regexp_like(s["value"], F.lit("[A-Za-z]"))
    rows = keep(rows.withColumn("candidates", F.filter("candidates", mixed)))
    tested = rows.select("doc_id", "text_hash", "base", F.explode("candidates").alias("s"))
    tested = battery(tested, F.col("s.value")).select("doc_id", "text_hash", F.col("s.start").alias("start"), F.col("s.end").alias("end"), band_of(F.col("s.value")).alias("band"), (F.col("t.p") >= RANDOM_P).alias("passes"), F.cbrt("t.h").alias("r"), overlaps(F.col("s"), F.col("base")).alias("known"))
    levels = F.broadcast(keep(natural_levels(docs), len(BANDS)))
    z = (F.col("mean") - F.col("r")) / F.col("spread")
    power = -F.log10(F.greatest(F.when(z > 0, normal_tail(z)).otherwise(1 - normal_tail(z)), F.lit(1e-30)))
    tested = keep(tested.join(levels, "band").select("doc_id", "text_hash", "start", "end", "band", "passes", "known", F.least(F.floor(power * 10), F.lit(CLASSES)).alias("class")))
    classes = keep(tested.groupBy("band", "class").agg(F.count("*").alias("n")), len(BANDS) * (CLASSES + 1))  # at most as many rows
    most = Window.partitionBy("band")
    ranked = classes.withColumn("k", F.sum("n").over(most.orderBy(F.desc("class")))).withColumn("all", F.sum("n").over(most))
    # natural ones among a band's candidates: half of them and no others have p-values above a half (class 3)
    natural = F.least("all", (1 + F.sum(F.when(F.col("class") < 3, F.col("n")).otherwise(F.lit(0))).over(most)) / (1 - 10**-0.3))
    ranked = ranked.withColumn("natural", natural)
    least = F.broadcast(ranked.where(F.pow(F.lit(10.0), -F.col("class") / 10) * F.col("natural") <= FALSE_SHARE * F.col("k")).groupBy("band").agg(F.min("class").alias("least")))
    found = tested.where("passes and not known").join(least, "band").where("class >= least")
    one = F.struct(F.col("start"), F.col("end"), F.lit(3).alias("rank"), F.lit("random").alias("kind"))
    more = keep(found.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.collect_set(one).alias("more")), rows.count())
    size = more.agg(F.count("*"), F.sum(F.size("more"))).first()
    out = rows.join(maybe_broadcast(more, (size[0] or 0) + (size[1] or 0), 64), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return out.select("doc_id", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")).alias("spans"))


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    found = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", *base_columns(), joined(F.col("spans"), False).alias("spans"))
