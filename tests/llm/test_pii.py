import hashlib
import random
import re

from vellum.llm import pii as P


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c)) % 10 + (2 * int(c)) // 10 for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    out = [[] for _ in range(4)]
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out[0].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out[1].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out[2].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out[3].append(m.span())
    line = ",".join(f"{k}:{a}:{b}" for k, spans in zip(P.KINDS, out) for a, b in spans)
    return (*map(len, out), hashlib.sha256(line.encode()).hexdigest())


def card(r):
    d = "".join(r.choices("0123456789", k=15))
    return next(d + c for c in "0123456789" if luhn(d + c))


def test_base_and_discovered(spark, tmp_path):
    r = random.Random(8)
    texts = [None, "", "a.b@c x a@b.cc_x@d.ee a@b. é𝒳 q%w@x-y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.00000000000000000000000001 1.2.3 9999999999999999999999999999999999999999999.1.1.1", "+1 (743) 555-3824, +1  +12345678( +1234567 +1+2 345 678 901", "4111 1111-1111 1111 4111111111111112 41111111111111110", "x" * 5000 + "@", "1 2 3 " * 4000 + "@+", "@" * 3000 + "a@b.c"]
    texts += ["".join(r.choices("01.+@a -()é", k=r.randrange(60))) for _ in range(300)]
    texts += [f"my card number {card(r)} here {k}" for k in range(12)] + [f"my card number AB-{r.randrange(10**6):06d}-77 ok" for _ in range(1)]
    texts += [f"page {k} of the book and number {k * 7} only" for k in range(30)]
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)] + [(None, texts[4], 0, ""), (2, texts[2], 0, "")]
    spark.createDataFrame(rows, "doc_id long, text string, start int, kind string").write.parquet(f"{tmp_path}/documents.parquet")
    got = P.op9_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for g in got:
        text = texts[4] if g.doc_id is None else texts[g.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone, g.base_sha256) == brute(text), text
        n = g.spans.count(":") // 2
        extra = n - (g.n_email + g.n_ip + g.n_card + g.n_phone)
        assert extra == (1 if "AB-" in (text or "") else 0), (text, g.spans)
    masked = {x.doc_id: x.text for x in P.mask_pii(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect() if x.doc_id is not None}
    assert masked[4].startswith("<PHONE>, +1  <PHONE>( +1234567") and masked[1] == "" and masked[0] is None
    hit = next(i for i, t in enumerate(texts) if t and "AB-" in t)
    assert masked[hit] == "my card number <CARD> ok"


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert P.pii_spans(empty).count() == 0 and P.mask_pii(empty).columns == empty.columns


def test_grouped_identifiers(spark):
    r = random.Random(9)
    texts = [f"my card number {card(r)} here {k}" for k in range(12)]
    grouped = {
        "my card number DE89 3704 0044 0532 0130 00 ok": "my card number <CARD> ok",
        "my card number 1234 5678 9012, or 77": "my card number <CARD> or 77",
        "my card number AB-12 34-56  78": "my card number <CARD>  78",
        "in 2024 my card number DE89 3704 10.0.0.1 5": "in 2024 my card number <CARD> <IP> 5",
        "my card number X1 x2:10.0.0.1:80 5": "my card number <CARD> x2:<IP>:80 5",
        f"my card number {card(r)} 3704 0044": "my card number <CARD>",
        "1 2 3 4 " * 3000: "1 2 3 4 " * 3000,
    }
    docs = spark.createDataFrame(list(enumerate([*texts, *grouped])), "doc_id long, text string")
    masked = {x.doc_id: x.text for x in P.mask_pii(docs).collect()}
    for k, (text, want) in enumerate(grouped.items(), len(texts)):
        assert masked[k] == want, text[:80]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def base_of(text):
    """(start, end, kind) of the fixed formats, by plain expressions."""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [(*m.span(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return out


def plain_occurrences(text):
    """(start, end, value, kind, patterns) of seeds and candidates."""
    base, m = base_of(text), list(text)
    for a, b, _ in base:
        m[a:b] = "￿" * (b - a)
    m = "".join(m)
    runs = []
    for x in re.finditer(r"￿+|(?<![^\x00-\x20])[^\x00-\x20￿]*[0-9][^\x00-\x20￿]*(?![^\x00-\x20])", m):
        a, b = x.span()
        kinds = sorted((P.KINDS.index(k), text[s:e]) for s, e, k in base if a <= s < b)
        kind, value = (P.KINDS[kinds[0][0]], kinds[0][1]) if m[a] == "￿" else (None, x[0])
        if kind is None and runs and runs[-1][3] is None and runs[-1][1] + 1 == a and m[a - 1] == " " and re.match("[A-Za-z0-9]", m[a - 2]) and re.match("[A-Za-z0-9]", m[a]):
            runs[-1] = (runs[-1][0], b, m[runs[-1][0] : b], None)
        else:
            runs.append((a, b, value, kind))
    out = []
    for a, b, value, kind in runs:
        blur = lambda w: "#" if re.search("[0-9￿]", w) else w
        left, right = [blur(w) for w in re.findall(WORD, lower(m[:a]))][-2:], [blur(w) for w in re.findall(WORD, lower(m[b:]))][:1]
        found = []
        if left and left[-1] != "#":
            found += [f"2 {left[0]} {left[1]}"] if len(left) == 2 else []
            found += [f"1 {left[-1]} {right[0]}"] if right and right[0] != "#" else []
            found.append(f"s {left[-1]} " + re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", value))))
        out.append((a, b, value, kind, found))
    return out


def plain_loop(texts):
    """All spans of every text by the whole loop, in plain Python."""
    import math
    from collections import defaultdict

    seen = [plain_occurrences(t or "") for t in texts]
    seed, slots, words = {}, defaultdict(set), defaultdict(set)
    for occurrences in seen:
        for _, _, value, kind, found in occurrences:
            if kind:
                seed[value] = min(seed.get(value, kind), kind, key=P.KINDS.index)
            for p in found:
                slots[p].add(value)
    for t in texts:
        w = re.findall(WORD, re.sub(r"(?<![^\x00-\x20])[^\x00-\x20]*[0-9@][^\x00-\x20]*", " 0 ", lower(t or "")))
        for k, x in enumerate(w):
            if x != "0" and k and w[k - 1] != "0":
                if k > 1:
                    words[f"2 {w[k - 2].replace('0', '#')} {w[k - 1]}"].add(x)
                if k + 1 < len(w):
                    words[f"1 {w[k - 1]} {w[k + 1]}"].add(x)
    accepted, good = {}, {}
    for _ in range(P.ROUNDS):
        good = {}
        for p, values in slots.items():
            for kind in P.KINDS:
                known = {v: (seed[v], 1.0) if v in seed else accepted[v] for v in values if v in seed or v in accepted}
                weight = sum(w for k, w in known.values() if k == kind)
                others = sum(k != kind for k, _ in known.values())
                trust = weight / (weight + others + len(words[p]) + (len(values) - len(known)) / 2 + 1)
                if weight >= P.MIN_SEEDS and trust >= P.MIN_TRUST:
                    good[p] = (kind, trust)
        scores = defaultdict(float)
        for p, (kind, trust) in good.items():
            for v in slots[p] - set(seed):
                scores[v, kind] += math.log(1 - trust)
        accepted = {}
        for (v, kind), s in sorted(scores.items(), key=lambda x: (-x[1], -P.KINDS.index(x[0][1]))):
            accepted[v] = (kind, 1 - math.exp(s))
    out = []
    for t, occurrences in zip(texts, seen, strict=True):
        spans = {(P.KINDS.index(k), a, b) for a, b, k in base_of(t or "")}
        for a, b, _, kind, found in occurrences:
            if kind is None and (best := [(good[p][1], -P.KINDS.index(good[p][0])) for p in found if p in good]):
                spans.add((-max(best)[1], a, b))
        out.append(",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)))
    return out


def bootstrap_corpus(seed):
    """Identifiers of no fixed format, reachable over several rounds, among numbers and words that are none."""
    r = random.Random(seed)
    phone, mail = lambda: f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}", lambda: f"u{r.randrange(10**5)}@mail.example.com"
    member = [f"MB-{r.randrange(10**6):06d}" for _ in range(40)]
    handle = [f"user{r.randrange(10**5):05d}" for _ in range(40)]
    texts = [f"please call our desk {phone()} before noon {k}" for k in range(40)] + [f"write to inbox {mail()} for help" for k in range(40)]
    texts += [f"please call our desk {m} before noon" for m in member[:9]]  # round 1: the two words, and the words around
    texts += [f"a client known under member code {m} joined" for m in member[:9] + member[20:22]]  # round 2: induced by the finds of round 1
    texts += [f"the file of holder {m} is shut" for m in member[20:22] + member[:8]]  # and by their shape
    texts += [f"write to inbox {h} for help" for h in handle[:8]] + [f"our forum alias {h}, active" for h in handle[:10]]
    texts += [f"on page {r.randrange(10**4)} of volume {r.randrange(99)} the desk was old" for _ in range(80)]
    texts += [f"the {phone()} and the {r.randrange(10**6)} by the road" for _ in range(30)] + ["the desk the road the inn the sea the sky"] * 3
    texts += ["call # our # desk x # 7 before #"] * 3
    texts += [f"sold for {r.randrange(10**5)} to {r.choice(['him', 'her', 'them'])}" for _ in range(60)]
    r.shuffle(texts)
    return texts, set(member), set(handle)


def test_bootstrap_against_plain_python(spark):
    for seed in (1, 2):
        texts, member, handle = bootstrap_corpus(seed)
        texts += [None, "", "x" * 300 + " call our desk MB-000000 before", "desk " + "y" * 4000 + " +1 (555) 555-5555 1 2 A3"]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {x.doc_id: x.s for x in P.pii_spans(docs).select("doc_id", P.joined(P.F.col("spans"), True).alias("s")).collect()}
        want = plain_loop(texts)
        assert [got[i] for i in range(len(texts))] == want
        # precision and recall of what is discovered
        found = [texts[i][int(a) : int(b)].rstrip(",") for i, s in got.items() for _, a, b in (x.split(":") for x in s.split(",") if x)]
        found = [v for v in found if not base_of(v)]
        right = [v for v in found if v in member or v in handle or v == "MB-000000"]
        planted = sum((v in t) for t in texts if t for v in member | handle)
        print(len(right), len(found), planted)
        assert len(right) >= 0.9 * len(found) and len(right) >= 0.8 * planted


def test_finds_of_a_round_induce_patterns(spark):
    texts, member, _ = bootstrap_corpus(1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = P.keep(P.extract(docs))
    patterns = [{x.pattern for x in P.discover(docs, rows, rounds).collect()} for rounds in (1, 2, 3)]
    assert "2 our desk" in patterns[0] and "2 member code" not in patterns[0]
    assert "2 member code" in patterns[1] and "2 and the" not in patterns[2]


def test_clashing_columns_and_repeats(spark):
    schema = "doc_id long, text string, marked_id int, MARKED_HASH string, d int, h string, n_chars int"
    rows = [(1, "mail a@b.cd now", 5, "x", 1, "", 15), (1, "mail a@b.cd now", 5, "x", 1, "", 15), (1, "other", 5, None, 1, "", 5), (None, "at 1.2.3.4", 0, "", 0, "", 10)]
    got = P.mask_pii(spark.createDataFrame(rows, schema))
    assert got.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted((x.text, x.n_chars) for x in got.collect()) == [("at <IP>", 7), ("mail <EMAIL> now", 16), ("mail <EMAIL> now", 16), ("other", 5)]
