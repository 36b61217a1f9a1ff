import random

from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near import groups
from tests.llm.test_packing import check
from tests.llm.test_pii import brute as private
from vellum.llm import quality as Q

import corpus_pipeline as C


def test_stages_against_brute_force(spark, tmp_path):
    r = random.Random(11)
    words = ["".join(r.choices(["th", "ing", "er", "an", "tion", "st", "ou"], k=r.randrange(1, 4))) for _ in range(400)]
    text = lambda n: " ".join(r.choices(words, k=n))
    items = [(i, text(30)) for i in range(5)]
    good = [text(r.randrange(20, 400)) for _ in range(150)]
    good += [g + " x" for g in good[:20]] + good[:10] + [f"{text(30)} {items[i % 5][1]} {text(9)}" for i in range(10)] + [f"{text(40)} me{i}@mail{i}.example.com {text(20)}" for i in range(15)]
    bad = [" ".join(w.upper() + "!!" for w in text(r.randrange(20, 90)).split()) for _ in range(60)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*good, *bad])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(rows))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d, now, outs = str(tmp_path), docs, []
    for name, stage in C.STAGES:
        stage(spark, now, d).write.parquet(f"{tmp_path}/out/{name}")
        now = spark.read.parquet(f"{tmp_path}/out/{name}")
        outs.append(now.collect())
        if name != "packing":
            assert now.columns == docs.columns
    pairs = lambda x: [(v.doc_id, v.text) for v in x]
    assert {v.doc_id for v in outs[0]} == set(range(len(good)))
    scores = {v.doc_id: v.predicted for v in Q.quality_scores(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    assert {k for k, p in scores.items() if p} == {v.doc_id for v in outs[0]}
    assert {v.doc_id for v in outs[1]} == {i for i, c in groups(pairs(outs[0])) if i == c}
    assert {v.doc_id for v in outs[2]} == {x[0] for x in leaks(pairs(outs[1]), items) if not x[5]}
    before = dict(pairs(outs[2]))
    assert {v.doc_id for v in outs[3]} == set(before)
    for v in outs[3]:
        assert sum(private(v.text)[:4]) == 0 and v.n_chars == len(v.text)
        assert v.text == before[v.doc_id] or sum(private(before[v.doc_id])[:4]) > 0
    check(pairs(outs[3]), outs[4])
    assert sorted(map(tuple, C.run(spark, d).drop("sequence_id", "offset").collect())) == sorted(tuple(v)[:5] for v in outs[4])


def stages(spark, docs, folder):
    now, outs = docs, []
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, now, folder).write.parquet(f"{folder}/out-{k}")
        now = spark.read.parquet(f"{folder}/out-{k}")
        if name != "packing":
            assert now.columns == docs.columns
        outs.append(now)
    return outs


def tables(spark, folder, labelled, items):
    spark.createDataFrame(labelled, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_nulls_long_texts_repeats_and_other_columns(spark, tmp_path):
    r = random.Random(4)
    words = [f"{a}{b}" for a in ("th", "ing", "er", "an") for b in ("st", "ou", "re", "al", "en")]
    text = lambda n: " ".join(r.choices(words, k=n))
    leak, long = text(30), text(30_000)
    texts = {1: None, 2: "", 3: long, 4: long + " x", 5: text(50), 6: f"{text(20)} {leak} {text(5)}", 7: "mail me at a@b.cde now"}
    rows = [(i, t, "en", 1, "m", 0, "s") for i, t in texts.items()]
    rows += [(5, texts[5], "en", 1, "m", 0, "s"), (5, texts[5], "en", 1, "m", 0, "s"), (8, texts[5], "en", 1, "m", 0, "s"), (None, text(40), None, None, None, None, None), (9, text(60), None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, node int, marked_id string, stats int, leaked_hash string")
    tables(spark, str(tmp_path), [(1, None, 0)], [(1, leak), (2, None)])
    outs = [o.collect() for o in stages(spark, docs, str(tmp_path))]
    ids = lambda o: sorted((x.doc_id for x in o), key=str)
    # without usable labels all stay; 2 goes as 1 has no text either, 4 with 3, 8 with 5, whose rows stay together
    assert len(outs[0]) == len(rows)
    assert ids(outs[1]) == sorted([1, 3, 5, 5, 5, 6, 7, 9, None], key=str)
    assert ids(outs[2]) == sorted([1, 3, 5, 5, 5, 7, 9, None], key=str)
    assert ids(outs[3]) == ids(outs[2]) and {x.doc_id: x.text for x in outs[3]}[7] == "mail me at <EMAIL> now"
    check([(x.doc_id, x.text) for x in outs[3]], outs[4])


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    tables(spark, str(tmp_path), [], [])
    assert [o.count() for o in stages(spark, docs, str(tmp_path))] == [0] * 5


def test_run_leaves_its_last_stage_only(spark, tmp_path):
    import os

    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tables(spark, str(tmp_path), [(1, 1, 0)], [(1, "x y")])
    out = C.run(spark, str(tmp_path))
    assert out.count() == 1
    folder = os.path.dirname(out.inputFiles()[0].removeprefix("file://"))
    assert os.path.basename(folder) == "packing" and os.listdir(os.path.dirname(folder)) == ["packing"]
