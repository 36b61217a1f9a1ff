import random

import numpy as np

import corpus_pipeline as C
from vellum.llm import near as N


def sets_of(texts):
    out = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def roots(n, linked):
    comp = list(range(n))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(j, i):
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    return [find(i) for i in range(n)]


def groups(rows):
    """(id, smallest id of its group) by comparing all pairs of fingerprints."""
    fps = [N.wide_fingerprint(N.shingles(t)) for _, t in rows]
    blank = [not len(N.shingles(t)) for _, t in rows]
    root = roots(len(rows), lambda i, j: blank[i] == blank[j] and int(np.bitwise_count(fps[i] ^ fps[j]).sum()) <= 102)
    least = {}
    for (i, _), c in zip(rows, root, strict=True):
        least[c] = min(least.get(c, i), i)
    return [(i, least[c]) for (i, _), c in zip(rows, root, strict=True)]


def corpus():
    r = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    base = [r.choices(words, k=r.choice([6, 12, 40, 120, 300])) for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for changes in (1, 2, 3, 5):  # about 5 shingles a change: similarities on both sides of the bound
            c = list(b)
            for _ in range(changes):
                c[r.randrange(len(c))] = r.choice(words)
            texts.append(" ".join(c))
    near = [r.choices(words, k=60) for _ in range(1)] * 60  # one large group, not all of it linked to one member
    texts += [" ".join(w if r.random() > 0.03 else r.choice(words) for w in b) for b in near]
    line = " ".join(r.choices(words, k=14))
    texts += [f"{' '.join(r.choices(words, k=5))} {line} {' '.join(r.choices(words, k=r.randrange(4)))}" for _ in range(60)]
    return texts + ["", None, " \n", "one two", "One  two", texts[0].upper(), texts[1], "?! ...", "?! ..", " ".join(r.choices(words, k=20_000))]


def test_stage_against_all_pairs_of_fingerprints(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    kept = {x.doc_id for x in dict(C.STAGES)["near_duplicates"](spark, docs, "").collect()}
    want = groups(list(enumerate(texts)))
    assert kept == {i for i, c in want if i == c}
    # no two texts with a Jaccard similarity of 0.8 are in different groups
    sets, name = sets_of(texts), dict(want)
    for i in range(len(sets)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                assert name[i] == name[j]


def test_links_are_similar():
    """Cosine against agreement: texts far below the bound do not link, texts above it do."""
    r = random.Random(9)
    for _ in range(300):
        common, own = r.randrange(1, 400), r.randrange(400)
        h = np.array([r.getrandbits(64) for _ in range(common + 2 * own)], np.uint64)
        x, y = h[: common + own], np.concatenate([h[:common], h[common + own :]])
        agree = 1 - int(np.bitwise_count(N.wide_fingerprint(x) ^ N.wide_fingerprint(y)).sum()) / N.BITS
        cosine = common / (common + own)
        assert abs(agree - (1 - np.arccos(cosine) / np.pi)) < 0.1
    assert N.wide_fingerprint(np.empty(0, np.uint64)).tolist() == [0] * 8


def test_fingerprint_in_blocks(monkeypatch):
    h = np.random.default_rng(2).integers(0, 1 << 63, 1000, dtype=np.uint64)
    mixed = N._mixed(h, slice(0, 8))
    bits = np.unpackbits(np.ascontiguousarray(mixed.T).view(np.uint8), axis=1)
    want = np.packbits(2 * bits.sum(axis=0, dtype=int) > 1000).view(np.uint64).tolist(), N.bands(h).tolist()
    monkeypatch.setattr(N, "BLOCK", 7)
    assert (N.wide_fingerprint(h).tolist(), N.bands(h).tolist()) == want


def test_forest_and_full_shards_against_all_pairs(spark):
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, (4, 8), dtype=np.uint64)
    values = []
    for k in range(300):
        bits = np.unpackbits(base[k % 4].view(np.uint8))
        bits[r.integers(0, 512, r.integers(20, 90))] ^= 1
        values.append(np.packbits(bits).view(np.uint64))
    values = np.unique(np.array(values), axis=0)
    want = roots(len(values), lambda i, j: int(np.bitwise_count(values[i] ^ values[j]).sum()) <= 102)

    def same(edges):
        root = roots(len(values), lambda i, j: (i, j) in edges)
        assert len(set(zip(root, want, strict=True))) == len(set(root)) == len(set(want))

    same({tuple(sorted(e)) for e in N.wide_forest(values, 102)})
    met = spark.createDataFrame([(7, i) for i in range(len(values))] + [(8, 0), (8, 1)], "shard long, node long")
    fps = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(values)], "node long, fp binary")
    for members in (10, 100, 10_000):
        same({tuple(sorted(e)) for e in N.shard_links(met, fps, 102, members).collect()})


def test_empty_nulls_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, node int, u int, shard string, fp string"
    assert N.one_of_each_group(spark.createDataFrame([], schema)).count() == 0
    rows = [(3, "a b c", 1, 1, "", ""), (3, "a b c", 1, 1, "", ""), (None, "a b c", None, 0, "", ""), (5, "A b  c", 0, 0, "", ""), (7, "q", 0, 0, None, None), (8, None, 0, 0, "", ""), (9, "", 0, 0, "", "")]
    got = N.one_of_each_group(spark.createDataFrame(rows, schema))
    assert got.columns == schema.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted((x.doc_id for x in got.collect()), key=str) == [3, 3, 7, 8, None]
