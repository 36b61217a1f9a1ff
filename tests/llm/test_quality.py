import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from vellum.llm import quality as Q


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op10_quality(spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    held = [(r.quality, got[r.doc_id]) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(g.held_out for _, g in held) and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) for g in got.values())
    right = {q: np.mean([g.predicted == q for p, g in held if p == q]) for q in (0, 1)}
    print(right)
    assert right[1] > 0.97 and right[0] > 0.9


def test_compiled_rules_equal_the_model(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(400, len(Q.STATISTICS)))
    y = ((x[:, 2] > 0.3) & (x[:, 5] <= 0.5)).astype(float)
    model = Q.fit_rules(x, y)
    assert model.rules and len(model.rules) < 200 and str(model.rules[0])
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i long, s array<double>")
    got = [v.p for v in df.select("i", model.score(F.col("s")).alias("p")).orderBy("i").collect()]
    assert np.allclose(got, model.predict(x)) and ((np.array(got) >= 0.5) == y).mean() > 0.95


def test_cases(spark):
    schema = "doc_id long, text string, stats int, quality string"
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, None, 1, "x"), (1, "", 1, "x"), (None, "a b", None, None), (2, "word " * 50_000, 2, "")], schema)
    rows = Q.quality_scores(docs, empty).collect()
    assert len(rows) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    kept = Q.keep_good(docs, empty)
    assert kept.columns == docs.columns and kept.count() == 4
    assert Q.quality_scores(docs.limit(0), empty).count() == 0
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (2, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert all(0.5 < r.score < 1 for r in Q.quality_scores(docs, one).collect())
    random.seed(1)


def plain_statistics(text):
    """The statistics by counting, one at a time."""
    import math

    raw = list((text or "").encode())
    n, words = max(len(raw), 1), (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if x.strip()]
    w, share = max(len(words), 1), lambda ok: sum(ok(b) for b in raw) / n
    out = [math.log(1 + len(raw)), math.log(1 + len(words)), sum(len(x) for x in words) / w, max([len(x) for x in words], default=0)]
    out += [share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in b" \t"), share(lambda b: b in b"\n\r"), share(lambda b: b in b".,;:?'\"-()")]
    out += [share(lambda b: b in b"#$%&*+/<=>@[\\]^_`{|}~"), share(lambda b: b == 33), share(lambda b: b == 124), share(lambda b: b >= 128)]
    out += [len(set(words)) / w, 1 - len(set(lines)) / max(len(lines), 1), sum(x.decode()[-1:] in set("!#$%&*|") for x in words) / w, sum(len(x) < 20 for x in lines) / max(len(lines), 1), len(set(raw))]
    return out


def test_query_against_plain_python(spark, tmp_path):
    """Scores of the query: counted statistics, the fitted rules evaluated one by one; a score of 0.5 is predicted 1."""
    r = random.Random(2)
    good = [" ".join(r.choices(["the", "inn", "was", "old,", "and", "Été", "calm."], k=r.randrange(5, 60))) for _ in range(120)]
    bad = [x.upper().replace(" ", "!! ") for x in good[:90]]
    texts = [*good, *bad, None, "", "\n\n", "x" * 30_000, "line\nline\nline"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(good) + len(bad))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {x.doc_id: x for x in Q.op10_quality(spark, str(tmp_path)).collect()}
    x = np.array([plain_statistics(t) for t in texts])
    used = [i for i in range(len(good) + len(bad)) if zlib.crc32(str(i).encode()) % 3 != 1]
    model = Q.fit_rules(x[used], np.array([float(i < len(good)) for i in used]))
    for i in range(len(texts)):
        total = model.intercept + sum(w for rule, w in zip(model.rules, model.weights, strict=True) if all((x[i][k] > c) == g for k, g, c in rule.terms))
        assert abs(got[i].score - 1 / (1 + np.exp(-total))) < 1e-9 and got[i].predicted == int(got[i].score >= 0.5)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, stats int, STATS_ int")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert Q.keep_good(empty, labels).columns == ["doc_id", "text", "stats", "STATS_"] and Q.keep_good(empty, labels).count() == 0
