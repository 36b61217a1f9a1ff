import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from vellum.llm import decontaminate as D

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(t):
    return re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = [(str(i), w[k : k + 10]) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - 9))]
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, win in wins:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    ids.add(i)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_matches_brute_force(spark, tmp_path):
    r = random.Random(3)
    vocabulary = ["the", "of", "É", "é", "x1", "rare", "Kelvin", "Kelvin", "and", "to"]
    items = [(k, " ".join(r.choices(vocabulary, k=n))) for k, n in enumerate([25, 12, 10, 3, 2, 11, 40])]
    items += [(7, items[0][1]), (8, None), (9, "..."), (10, items[1][1].upper())]
    docs = []
    for k in range(120):
        parts = [" ".join(r.choices(vocabulary, k=r.randrange(30)))]
        if k % 3 == 0:
            parts.append(r.choice([",", " ", "\n--"]).join(r.choice(items[:7])[1].split()[: r.choice([9, 10, 12, 40])]))
        parts.append(" ".join(r.choices(vocabulary, k=r.randrange(30))))
        docs.append((k, ". ".join(parts)))
    docs += [(500, None), (500, ""), (None, items[0][1]), (3, docs[3][1]), (3, "other text"), (600, "the of " * 3000 + items[0][1])]
    spark.createDataFrame([(d, t, 1, "w") for d, t in docs], "doc_id long, text string, place int, words string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = D.op8_decontamination(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
    kept = D.drop_contaminated(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    assert sorted((x.doc_id, x.text) for x in kept.where("doc_id is not null").collect() if x.text) == sorted(t for t, b in zip(sorted(docs, key=str), [None] * len(docs)) if t[0] is not None and t[1] and not brute([t], items)[0][5])


def test_sql_agrees(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.execute(D.OP8_SQL).fetchall()
    got = D.op8_decontamination(spark, d).collect()
    assert sorted(map(tuple, got)) == sorted(want) and any(r.contaminated for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [tuple(r)[:4] for r in D.contamination(docs, items.limit(0)).collect()] == [(1, 3, 0, 0)]
    assert D.contamination(docs.limit(0), items).count() == 0


def pieces(docs, items, **options):
    windows, window_items = D.windows_of(items)
    anchors = D.keep(D.rare_terms(windows, docs))
    return windows, anchors, D.keep(D.index(docs, anchors, **options))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "zz one two extra three four yy"), (2, "one two three four"), (3, "one x x x x x x x x two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    windows, anchors, indexed = pieces(docs, items)
    got = sorted({(r.doc_id, r.kind) for r in D.matches(docs, windows, indexed, anchors, slop=2).collect()})
    assert got == [(1, "proximity"), (2, "phrase")]
    rows = {r.doc_id: (r.n_hit, r.item_ids, r.near_ids) for r in D.contamination(docs, items, slop=2).collect()}
    assert rows == {1: (0, [], ["1"]), 2: (4, ["1"], []), 3: (0, [], [])}
    assert [r.doc_id for r in D.drop_contaminated(docs, items, slop=2).collect()] == [3]


def corpus(spark):
    r = random.Random(6)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.choice([1, 2, 5, 12, 30])))) for k in range(12)]
    docs = [(k, " ".join(r.choices(vocabulary, k=60) + items[k % 12][1].split()[: r.choice([8, 10, 30])] + r.choices(vocabulary, k=20))) for k in range(150)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs, items


def test_joined_index_equals_the_one_in_rows(spark):
    docs, items, plain_docs, plain_items = corpus(spark)
    sorted_lists = lambda x: sorted((r.doc_id, r.n_words, sorted(r.postings), sorted(r.firsts)) for r in x.collect())
    assert sorted_lists(pieces(docs, items)[2]) == sorted_lists(pieces(docs, items, literal_terms=0)[2])
    got = D.contamination(docs, items, literal_terms=0).collect()
    want = {w[0]: w[1:4] for w in brute(plain_docs, plain_items)}
    assert {g.doc_id: (g.n_words, g.n_hit, g.n_items) for g in got} == want


def test_index_and_intersection_against_brute_force(spark):
    """Candidates are the starts at which the three rarest terms of a window stand at their offsets, no more and no fewer."""
    docs, items, plain_docs, _ = corpus(spark)
    windows, anchors, indexed = pieces(docs, items)
    rare = {r.window_id: [(x.offset, x.term) for x in r.rare] for r in anchors.collect()}
    counts = {t: sum(t in words(d) for _, d in plain_docs) for x in rare.values() for _, t in x}
    for r in anchors.collect():
        order = sorted(range(len(r.window)), key=lambda k: (sum(r.window[k] in words(d) for _, d in plain_docs), k))[:3]
        assert [x.offset for x in r.rare] == order and [x.n for x in r.rare] == [counts[x.term] for x in r.rare]
    got = {(r.doc_id, r.window_id, r.start) for r in D.intersect(indexed, anchors).collect()}
    want = set()
    for d, t in plain_docs:
        w = words(t)
        for k, lists in rare.items():
            want |= {(d, k, s) for s in range(len(w)) if all(0 <= s + o < len(w) and w[s + o] == x for o, x in lists)}
    assert got == want
    exact = {(r.doc_id, r.window_id, r.start) for r in D.matches(docs, windows, indexed, anchors).collect()}
    assert exact < got  # the comparison of the other words is needed too


def test_without_the_lists_nothing_is_found(spark):
    docs, items, _, _ = corpus(spark)
    windows, anchors, indexed = pieces(docs, items)
    bare = indexed.withColumn("postings", F.array().cast("array<long>"))
    long = windows.where("size(window) = 10").select("window_id")
    assert D.matches(docs, windows, indexed, anchors).join(long, "window_id").count() > 0
    assert D.matches(docs, windows, bare, anchors).join(long, "window_id").count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "x", 2, 3), (2, "c d", 1, None, 2, 3)], "doc_id long, text string, leaked_id int, LEAKED_HASH string, d int, h int")
    items = spark.createDataFrame([(1, "c D", 5)], "item_id long, text string, window_id int")
    assert [tuple(r) for r in D.drop_contaminated(docs, items).collect()] == [(1, "a b", 1, "x", 2, 3)]
