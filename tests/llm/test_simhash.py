import random

import numpy as np
import xxhash

from vellum.llm import simhash as S
from vellum.llm.common import components


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                comp[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted((rows[i][0], f"{fps[i]:016x}", min(groups[find(i)])) for i in range(len(rows)))


def texts():
    r = random.Random(5)
    words = ["alpha", "béta", "Gamma", "delta", "eps", "zeta", "Eta", "theta", "ÀB"]
    base = [" ".join(r.choices(words, k=r.choice([1, 2, 3, 5, 40, 300]))) for _ in range(60)]
    near = [b + r.choice(["", " x", "\tEND"]) for b in base for _ in range(3)]
    return list(enumerate([*base, *near, "", None, "  \n", "x\xa0y z", base[0].upper()], 7))


def test_matches_brute_force(spark, tmp_path):
    rows = texts()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in S.op4_simhash(spark, str(tmp_path)).collect())
    assert got == brute(rows)


def test_fingerprint_is_sparks_xxhash64(spark):
    row = spark.sql("select xxhash64('one two three') h").first()
    assert S.fingerprint("One two\nTHREE") == row.h % (1 << 64)


def test_empty_nulls_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, fp string, u int, key int"
    assert S.simhash_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(3, "a b c", "x", 1, 1), (3, "a b c", "x", 1, 1), (None, "a b c", None, None, None), (None, "q r s t", "", 0, 0)]
    got = [tuple(r) for r in S.simhash_components(spark.createDataFrame(rows, schema)).select("doc_id", "component_id").collect()]
    assert sorted(got, key=str) == sorted([(3, 3), (3, 3), (None, 3), (None, None)], key=str)


def test_bk_tree_finds_all_within_radius():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << r.integers(0, 64, (3, 400)).astype(np.uint64)
    values = np.unique(np.concatenate([base, base[r.integers(0, 40, 400)] ^ flips[0] ^ flips[1] ^ flips[2]]))
    found = {(n, int(q)) for n, hit in S.BKTree(values).search(values, 3) for q in hit}
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 3}
    assert found == want


def test_large_shards_are_split_exactly(spark):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = np.uint64(1) << r.integers(0, 64, (4, 900)).astype(np.uint64)
    values = np.unique(np.concatenate([base, base[r.integers(0, 6, 900)] ^ flips[0] ^ flips[1] ^ flips[2] ^ flips[3]]))
    nodes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")

    def groups(members):
        root = {r.u: r.v for r in components(S.near_links(nodes, 3, members)).collect()}
        return [root.get(int(v), int(v)) for v in values.view(np.int64)]

    label = np.arange(len(values))
    for i in range(len(values)):
        near = np.unique(label[np.bitwise_count(values ^ values[i]) <= 3])
        label[np.isin(label, near)] = near[0]
    want = [int(x) for x in label]
    for members in (4, 40, 16_384):
        got = groups(members)
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[i] == 1000 for i in range(1001, 1300))
