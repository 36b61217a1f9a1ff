import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from vellum.llm import secrets as S

ASSIGN = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


def brute(text):
    text = text or ""
    a = [(m.start(), 0, m.end(), "assign") for m in re.finditer(ASSIGN, text) if len(m[1]) >= 8]
    b = [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    c = [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    line = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(a + b + c))
    return len(a), len(b), len(c), hashlib.sha256(line.encode()).hexdigest()


def test_base_spans_and_random_finds(spark, tmp_path):
    r = random.Random(4)
    hexes = lambda n: "".join(r.choices("0123456789abcdef", k=n))
    b64 = lambda n: "".join(r.choices(string.ascii_letters + string.digits + "+/", k=n))
    texts = [None, "", "token=secret:abcdefgh", "token=secret=abcdefghij", "API_KEY: 'abcd1234'", 'x "password" : "hunter2hunter2" y', "AKIA" + "ABCD1234ABCD", "AKIAAKIAABCDEFGH", "AKIAABC", "é𝒳 passwd = short", "tokentoken: abcdefgh", "secret\t=abcdefgh"]
    texts += [f"é𝒳 ßa {hexes(n)}{'g'} and {hexes(31)}." for n in (31, 32, 33, 64, 200)] + [hexes(32)] * 2 + ["a" * 3000, "ab cd " * 20_000 + "token = " + hexes(40)]
    planted = [(f"value {b64(44)} end", 6) for _ in range(60)]
    words = ["".join(r.choices(["th", "ing", "er", "an", "tion", "st"], k=12)) for _ in range(400)]
    texts += [t for t, _ in planted] + [" ".join(words[i : i + 20]) for i in range(0, 400, 20)]
    rows = [(i, t, "base") for i, t in enumerate(texts)] + [(None, texts[4], ""), (3, texts[3], "")]
    spark.createDataFrame(rows, "doc_id long, text string, base string").write.parquet(f"{tmp_path}/documents.parquet")
    got = S.op5_secrets(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for g in got:
        text = texts[4] if g.doc_id is None else texts[g.doc_id]
        assert (g.n_assign, g.n_access, g.n_hex, g.base_sha256) == brute(text), text
    found = [g for g in got if "random:" in g.spans]
    hit = [g for g in found if g.doc_id is not None and texts[g.doc_id].startswith("value ")]
    assert len(hit) >= 55 and all(g.spans.startswith("random:6:50") for g in hit)
    # what else is found are the random hex strings one short of the fixed format
    assert all(texts[g.doc_id].startswith("é𝒳 ßa ") for g in found if g not in hit)


def test_battery_levels(spark):
    r = random.Random(9)
    rows = [("random", "".join(r.choices("0123456789abcdef", k=40))) for _ in range(1000)] + [("text", "".join(r.choices(["the", "tion", "ing", "er"], k=14))) for _ in range(200)]
    df = S.battery(spark.createDataFrame(rows, "kind string, v string"), F.col("v"))
    share = {k: n for k, n in df.groupBy("kind").agg(F.avg((F.col("t.p") >= S.RANDOM_P).cast("int"))).collect()}
    assert share["random"] > 0.96 and share["text"] < 0.01


def test_empty(spark):
    assert S.secret_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain_sum(value):
    """Half of Fisher's statistic of the three tests, by plain formulas."""
    import math

    tail = lambda z: math.erfc(abs(z) / math.sqrt(2)) / 2
    body = re.sub("=+$", "", value)
    name = "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", body) else "base32" if re.fullmatch("[A-Z2-7]+", body) else "base64"
    body = body.lower() if name == "hex" else body.translate(str.maketrans("-_=", "+/+"))
    abc = S.ALPHABETS[name]
    v, k, n = [abc.find(c) + 1 for c in body], len(abc), len(body)
    chi = sum((v.count(x) - n / k) ** 2 for x in range(1, k + 1)) * k / n
    free = k - 1
    z = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    p = [tail(z) if z > 0 else 1 - tail(z)]
    up = [x > k / 2 for x in v]
    runs, high = 1 + sum(a != b for a, b in zip(up, up[1:], strict=False)), sum(up)
    mean = 2 * high * (n - high) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    p.append(2 * tail((runs - mean) / math.sqrt(spread) if spread > 1e-9 else 9))
    m = sum(v) / n
    variance = sum((x - m) ** 2 for x in v)
    p.append(2 * tail(sum((a - m) * (b - m) for a, b in zip(v, v[1:], strict=False)) / variance * math.sqrt(n) if variance > 1e-9 else 9))
    return sum(-math.log(min(1, max(x, 1e-12))) for x in p)


def band(value):
    return max(b for b in S.BANDS if b <= len(value))


def plain_random(texts, natural):
    """The spans of kind random of every text by the whole rule, in plain Python; natural: the natural strings."""
    import math
    import statistics

    levels = {}
    for b in S.BANDS:
        own = [plain_sum(v) ** (1 / 3) for v in natural if band(v) == b]
        levels[b] = (statistics.mean(own), max(statistics.stdev(own), S.MIN_SPREAD))
    tested = []
    for i, t in enumerate(texts):
        known = []
        for rx, ok in ((ASSIGN, lambda m: len(m[1]) >= 8), ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("[0-9a-f]+", lambda m: len(m[0]) >= 32)):
            known += [m.span() for m in re.finditer(rx, t or "") if ok(m)]
        for m in re.finditer("[A-Za-z0-9+/=_-]{20,}", t or ""):
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]):
                h = plain_sum(m[0])
                mean, spread = levels[band(m[0])]
                p = math.erfc((mean - h ** (1 / 3)) / spread / math.sqrt(2)) / 2
                over = any(a < m.end() and m.start() < b for a, b in known)
                tested.append((band(m[0]), min(math.floor(-math.log10(max(p, 1e-30)) * 10), S.CLASSES), math.exp(-h) * (1 + h + h * h / 2) >= S.RANDOM_P and not over, i, m.span()))
    out = {}
    for b in S.BANDS:
        own = sorted((x for x in tested if x[0] == b), key=lambda x: -x[1])
        n = min(len(own), (1 + sum(x[1] < 3 for x in own)) / (1 - 10**-0.3))
        good = [c for _, c, *_ in own if 10 ** (-c / 10) * n <= S.FALSE_SHARE * sum(x[1] >= c for x in own)]
        for _, c, passes, i, span in own:
            if good and passes and c >= min(good):
                out.setdefault(i, set()).add(span)
    return out


def slug(r):
    words = ["release", "notes", "autumn", "update", "kitchen", "garden", "project", "invoice", "meeting", "summary"]
    return "-".join(r.choices(words, k=r.randrange(3, 8))) + f"-{r.randrange(2100)}"


def test_random_spans_against_plain_python(spark):
    r = random.Random(14)
    key = lambda n: "".join(r.choices(string.ascii_letters + string.digits, k=n))
    words = ["".join(r.choices(["th", "ing", "er", "an", "tion", "st"], k=3)) for _ in range(300)]
    texts = [" ".join(r.choices(words, k=80)) + f" see {slug(r)} and {slug(r)}" for _ in range(250)]
    keys = {i: key(r.choice([60, 64, 100])) for i in range(0, 250, 50)}
    texts = [t + (f" with {keys[i]}." if i in keys else "") for i, t in enumerate(texts)] + [None, "token = abcd1234abcd1234abcd1234", key(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    natural = [x.value for x in S.natural_strings(docs).collect()]
    assert len(natural) > 450 and all(20 <= len(v) < 120 and re.fullmatch("[A-Za-z]+[0-9]{4}", v) for v in natural)
    got = {}
    for x in S.secret_spans(docs).collect():
        for s in x.spans:
            if s.kind == "random":
                got.setdefault(x.doc_id, set()).add((s.start, s.end))
    want = plain_random(texts, natural)
    assert got == want
    # the keys are found among many slugs, the slugs are not
    assert {texts[i][a:b] for i, spans in got.items() for a, b in spans} >= set(keys.values())
    assert sum(len(spans) for spans in got.values()) <= len(keys) + 2


def test_one_key_in_a_small_table(spark):
    r = random.Random(15)
    key = "".join(r.choices(string.ascii_letters + string.digits, k=64))
    docs = spark.createDataFrame([(1, f"use {key} here"), (2, f"see {slug(r)}")], "doc_id long, text string")
    assert {(x.doc_id, s.start, s.end) for x in S.secret_spans(docs).collect() for s in x.spans} == {(1, 4, 68)}


def test_natural_strings_hold_every_word_of_every_text(spark):
    r = random.Random(16)
    word = lambda: "".join(r.choices(string.ascii_letters, k=r.randrange(1, 12)))
    text = lambda n: r.choice(["", "é "]) + "".join(word() + r.choice([" ", ", ", "-7 ", "ß\n"]) for _ in range(n))
    texts = [text(n) for n in (10, 40, 41, 300, 900, 1101, 1102, 2000, 4000)] + [text(r.randrange(20, 1300)) for _ in range(40)]
    short = [None, "", "12 é", "abcdefghij klmno"]
    ends = ["abcdefghij klmnop", "abcdefghij klmnop q"]
    docs = spark.createDataFrame([(t,) for t in short + texts + ends], "text string").coalesce(1)
    own = [x.value for x in S.natural_strings(docs).collect()][: -S._of_notices(spark).count()]
    bands = {band(v) for v in own}
    for t in texts + ends:  # strings come in the order of the texts
        letters, at = "".join(w.capitalize() for w in re.findall("[A-Za-z]+", t)), 0
        turns = []
        while at < len(letters):
            v = own.pop(0)
            assert 20 <= len(v) < 120 and re.fullmatch("[A-Za-z]+[0-9]{4}", v)
            at = min(at, len(letters) - 16)
            assert letters[at : at + len(v) - 4] == v[:-4]
            at += len(v) - 4
            turns.append(len(v) - 4)
        k = S.LETTERS.index(turns[0]) if len(turns) > 1 else 0
        assert len(turns) < 2 or turns[:-1] == [S.LETTERS[(k + j) % 100] for j in range(len(turns) - 1)]
    assert not own and bands == set(S.BANDS)


def test_battery_against_plain_formulas(spark):
    r = random.Random(17)
    kinds = ["0123456789abcdef", "0123456789ABCDEF", S.ALPHABETS["base32"], S.ALPHABETS["base64"], S.ALPHABETS["base64"] + "-_=", "ab", "aB1"]
    values = ["".join(r.choices(k, k=n)) for k in kinds for n in (20, 27, 64, 119, 5000)] + ["a1" * 15 + "==", "a" * 40]
    got = S.battery(spark.createDataFrame([(v,) for v in values], "v string"), F.col("v")).collect()
    assert len(got) == len(values)
    for g in got:
        assert abs(g.t.h - plain_sum(g.v)) < 1e-4 * max(1, plain_sum(g.v)), g.v


def test_the_fixed_formats_alone_test_no_string(spark, monkeypatch):
    """secret_formats equals op5_secrets in what both tell, and needs neither natural strings nor a shuffle."""
    from vellum.llm import bases

    sf, columns = "/root/testdata/sf0.001", ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = sorted(tuple(r) for r in S.op5_secrets(spark, sf).select(*columns).collect())

    def fail(*_):
        raise AssertionError("natural strings are not needed")

    monkeypatch.setattr(S, "natural_levels", fail)
    got = bases.QUERIES["secret_formats"](spark, sf)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
