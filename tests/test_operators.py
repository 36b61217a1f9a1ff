import random
import re

import pytest
from pyspark.sql import functions as F

from vellum.functions import markup as M
from vellum.functions import text as X
from vellum.operators import documents as D
from vellum.operators import outline as P
from vellum.sources import sinks as K
from vellum.sources import text as S


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "s string").select(make(F.col("s")).alias("v")).first().v


def test_spoken_document_with_references_and_names(spark):
    text = "Of Job &c\nNo. 7\n\nOF JOB AND OTHERS\nIT was LORD IT.\n\nSo Job, see Rom. 8:28, 30; go. \"Yes.\" AND job! Naomi's\n \nLORD knows.\n\n"
    docs = spark.createDataFrame([(1, text), (2, "T"), (3, ""), (4, None)], "doc_id int, text string")
    got = {r.doc_id: r.ssml for r in M.spoken_documents(docs).collect()}
    job, nay = '<phoneme alphabet="ipa" ph="dʒoʊb">Job</phoneme>', '<phoneme alphabet="ipa" ph="neɪˈoʊ.mi">Naomi</phoneme>'
    assert got[1] == (
        f'<speak>\n<prosody rate="slow" pitch="-8%" volume="soft">\n\n<p>\n<s><emphasis level="strong">Of {job} &amp;c</emphasis></s>\n<break time="1500ms"/>\n</p>\n\n'
        '<p>\n<s><sub alias="Sermon number 7">No. 7</sub>.</s>\n<break time="1200ms"/>\n</p>\n\n<p>\n<s>It was LORD IT.</s>\n</p>\n\n<break time="1200ms"/>\n\n'
        # the point of the abbreviation ends a sentence, inside the mark too; a name in a mark opens none
        f'<p>\n<s>So {job},<break time="400ms"/> see <sub alias="Romans chapter 8, verses 28, 30">Rom.</s>\n<break time="750ms"/>\n<s>8:28,<break time="400ms"/> 30</sub>;<break time="400ms"/> go.</s>\n<break time="750ms"/>\n<s>"Yes.</s>\n<break time="750ms"/>\n<s>And job! {nay}\'s</s>\n</p>\n\n'
        '<break time="1200ms"/>\n\n<p>\n<s>Lord knows.</s>\n</p>\n\n</prosody>\n</speak>\n'
    )
    assert got[2].endswith("</p>\n\n\n</prosody>\n</speak>\n") and got[4] is None


def test_repaired_speech(spark):
    docs = spark.createDataFrame([(1, "T\n\nSee Rom. 8:28, 30; A &; then & so, on. End")], "doc_id int, text string")
    got = M.spoken_documents(docs, compat=False).first().ssml
    pause = '<break time="400ms"/>'
    assert f'<s>See <sub alias="Romans chapter 8, verses 28, 30">Rom. 8:28, 30</sub>;{pause} A &amp;;{pause} then &amp; so,{pause} on.</s>\n<break time="750ms"/>\n<s>End</s>' in got
    assert f"&amp;{pause} so" in M.spoken_documents(docs).first().ssml


def test_title_block(spark):
    strip = lambda text: one(spark, text, lambda s: F.array_join(X.strip_title_block(F.split(s, "\n", -1)), "\n"))
    assert strip("THE HEAD\nNO. 3\n\n‘Quote\nNO. 4") == "‘Quote\nNO. 4"
    assert strip("\n\nplain\nNO. 4") == "\n\nplain\nNO. 4" and strip("") == "" and strip("NO. 4\n\n") == ""
    assert strip("A SERMON x\n  \n  body") == "  body"


def test_paragraphs_of_a_page(spark):
    span = "struct<text:string,italic:boolean,bold:boolean,size:double>"
    lines = [[("bro-", True, False, 1.0)], [("ken IT ", False, False, 1.0), ("x", False, True, 1.0)], [("Up-", False, True, 1.0)], [("Per <a>", False, False, 1.0)], []]
    df = spark.createDataFrame([(k, lines) for k in ("scripture", "verse", "blockquote", "body")], f"kind string, ls array<array<{span}>>")
    got = {r.kind: r.h for r in df.select("kind", M.paragraph_html(F.col("kind"), F.col("ls")).alias("h")).collect()}
    whole = "<em>bro</em>ken It <strong>xUp-</strong> Per &lt;a&gt;"  # white space between tags goes with them
    assert got["scripture"] == f"<h2>{whole}</h2>" and got["blockquote"] == f"<blockquote>{whole}</blockquote>" and got["body"] == f"<p>{whole}</p>"
    assert got["verse"] == '<div class="verse"><em>bro-</em><br>\nken It <strong>x</strong><br>\n<strong>Up-</strong><br>\nPer &lt;a&gt;<br>\n</div>'


def plain_mend(line, words):
    """Pieces joined from the left where one blank parts them."""
    def broken(left, right):
        core = right.rstrip(".,;:!?\"')]}—–-")
        if not (left.isalpha() and core.isalpha() and (left + core).lower() in words):
            return False
        return not (left.lower() in words and core.lower() in words) or min(len(left), len(core)) <= 3

    pieces = re.split("( +)", line)
    out, word = [], pieces[0]
    for gap, following in zip(pieces[1::2], pieces[2::2], strict=True):
        if gap == " " and word and following and word[-1].islower() and following[0].islower() and broken(word, following):
            word += following
        else:
            out += [word, gap]
            word = following
    return "".join([*out, word])


def test_broken_words_against_plain_python(spark):
    r = random.Random(5)
    words = ["gospel", "go", "father", "fat", "her", "into", "in", "to", "it", "gos", "motherland", "mother", "land", "éclair", "the", "theme"]
    lines = []
    for _ in range(300):
        parts = []
        for w in r.choices(words, k=r.randrange(6)):
            cut = r.randrange(len(w) + 1)
            w = r.choice([w, w[:cut] + " " + w[cut:], w.capitalize(), w + r.choice([",", ".", "!'", "-"])])
            parts.append(w)
        lines.append(r.choice([" ", " ", "  "]).join(parts))
    df = spark.createDataFrame([*enumerate(lines), (-1, None)], "known int, line string")
    got = {x.known: x.line for x in P.join_broken_words(df, "line", spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert [got[i] for i in range(len(lines))] == [plain_mend(x, set(words)) for x in lines] and got[-1] is None


def plain_quotes(text, words, artifacts):
    lines = [x.strip() for x in (text or "").split("\n")]
    flat = " ".join(" ".join(x for x in lines if x and not x.isupper() and not any(a in x.lower() for a in artifacts) and not re.match(r"^\d+$", x)).split())
    scored = []
    for pos, s in enumerate(x.strip() for x in re.split(r"(?<=[.!?])\s+(?=[A-Z])", flat) if x.strip()):
        n = len(re.findall(rf"(?i)\b({'|'.join(words)})\b", s))
        if 30 <= len(s) <= 120 and s[-1] in ".!?" and s[0].isupper() and n >= 2 + bool(re.match(D.WEAK, s)):
            scored.append((-round(n * 10 - len(s) * 0.08 + 3 * ("!" in s), 6), pos, s))
    seen, out = set(), []
    for low, pos, s in sorted(scored):
        if s[:30] not in seen:
            seen.add(s[:30])
            out.append((pos, -low, s))
    return out[:8]


def test_top_sentences_against_plain_python(spark):
    r = random.Random(6)
    bits = ["the", "of", "grace", "And", "But", "house", "stood", "upon", "Volume", "hill.", "sea!", "rock?", "12", "\n", "\nALL CAPS\n", "\n77\n", "\nsee example.org\n", "Now", "Then"]
    texts = [" ".join(r.choices(bits, k=r.randrange(120))) for _ in range(120)] + [None, ""]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3])], "doc_id int, text string")
    got = {}
    for x in D.top_sentences(docs, ("the", "of", "grace"), artifacts=("example.org",)).collect():
        got.setdefault(x.doc_id, []).append((x.rank, x.pos, x.score, x.sentence))
    for i, t in enumerate(texts):
        want = [(k + 1, *x) for k, x in enumerate(plain_quotes(t, ("the", "of", "grace"), ("example.org",)))]
        assert sorted(got.get(i, [])) == sorted(want * (2 if i == 3 else 1))  # rows that repeat are ranked each


def test_outlines(spark):
    rows = [(1, 1, None, 2, " B ", 5), (1, 2, None, 1, "A", 1), (1, 3, 1, 1, "B1", None), (1, 4, 3, 9, "B1x", 7), (2, 1, None, 1, "Z", 1)]
    df = spark.createDataFrame(rows, "volume int, id int, parent int, pos int, title string, page_no int")
    got = [tuple(r) for r in S.zero_based(S.flat_outline(df)).orderBy("volume", "ord").collect()]
    assert got == [(1, 0, 1, "A", 0), (1, 1, 1, "B", 4), (1, 2, 2, "B1", None), (1, 3, 3, "B1x", 6), (2, 0, 1, "Z", 0)]
    assert S.flat_outline(df.limit(0)).count() == 0


def test_no_level_of_an_outline_is_made_twice(spark):
    df = spark.createDataFrame([(1, k, k - 1 if k else None, k, f"T{k}", k) for k in range(9)], "volume int, id int, parent int, pos int, title string, page_no int")
    got = S.flat_outline(df)
    assert [(r.ord, r.level, r.title) for r in got.orderBy("ord").collect()] == [(k, k + 1, f"T{k}") for k in range(9)]
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()  # the levels lie there, written


def test_volume_documents_meet_in_stretches(spark):
    """Starts in any order, ranges that overlap or hold nothing, a total far beyond the pages; against plain Python. The join has a key within the volume."""
    r = random.Random(4)
    entries = [(v, k, f"{v * 1000 + k} - Name", r.choice([None, *range(300)])) for v in (1, 2, 3) for k in range(60)] + [(4, 0, "4000 - Alone", 5)]
    pages = [(v, p, f"Body {v} {p}" if r.random() < 0.9 else "") for v in (1, 2, 3) for p in range(0, 280, v)]
    want = {}
    for v in (1, 2, 3, 4):
        own = [e for e in entries if e[0] == v and e[3] is not None]
        for e, after in zip(own, [*own[1:], None], strict=True):
            end = after[3] if after else 2**31 - 1
            want[int(e[2].split()[0])] = "\n".join(t for w, p, t in pages if w == v and t and e[3] <= p < end)
    totals = spark.sql("SELECT explode(array(1, 2, 3, 4)) AS volume, 2147483647 AS total")
    got = D.volume_documents(spark.createDataFrame(entries, "volume int, ord int, title string, page_no int"), spark.createDataFrame(pages, "volume int, page_no int, text string"), totals)
    assert {x.num: x.body for x in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, .*stretch#\d+L? = at#\d+|Join LeftOuter, .*at#\d+L? = stretch#\d+", plan)


def test_a_layout_task_is_dealt_a_bounded_number_of_lines(spark, monkeypatch):
    monkeypatch.setattr(D, "LINES_A_TASK", 10, raising=False)
    spans = "array(named_struct('text', concat('Body ', id), 'italic', false, 'bold', false, 'size', 14.0D)) AS spans"
    lines = spark.range(400).selectExpr("id div 4 AS doc", "1 AS page_no", "int(id % 4) AS line_no", "792.0D AS page_height", "54.0D AS x0", "double(id % 4) * 16 AS y0", "double(id % 4) * 16 + 10 AS y1", spans)
    got = P.layout_html(lines, "doc")
    assert {x.doc: x.html for x in got.collect()} == {k: f"<p>{' '.join(f'Body {4 * k + i}' for i in range(4))}</p>\n" for k in range(100)}
    assert got.rdd.getNumPartitions() == 40


def test_listing_volumes_and_pages(spark, tmp_path):
    for name in ("b.txt", "a.TXT", "c.md", "volume01.pdf"):
        (tmp_path / name).write_text("x")
    names = lambda df: [r.file_name for r in df.collect()]
    assert names(S.listing(spark, str(tmp_path))) == ["b.txt"] and names(S.listing(spark, str(tmp_path), any_case=True)) == ["a.TXT", "b.txt"]
    found = S.present_volumes(S.volume_files(spark, 2), S.listing(spark, str(tmp_path), ".pdf"))
    assert sorted(map(tuple, found.collect())) == [(1, "volume01.pdf", None), (2, "volume02.pdf", "missing")]
    assert {r.word for r in S.word_list(spark, str(tmp_path / "none"), ("a", "")).collect()} == {"a"}

    def read(volume, content):
        if volume == 2:
            raise ValueError("torn")
        return enumerate(bytes(content).decode().split("|"))

    volumes = spark.createDataFrame([(1, b"one||three"), (2, b"")], "volume int, content binary")
    pages = sorted((tuple(r) for r in S.pages_of(volumes, read).collect()), key=str)
    assert pages == [(1, 0, "one"), (1, 2, "three"), (2, None, "ValueError: torn")]


def test_files_are_written_one_a_row(spark, tmp_path):
    docs = spark.createDataFrame([(7, "God's Word", "é"), (12, "Other", "b")], "num int, title string, body string")
    for _ in range(2):
        K.write_files(D.document_files(docs), str(tmp_path / "out"))
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {"0007_GodsWord.txt": "God's Word\n7\n\né\n", "0012_Other.txt": "Other\n12\n\nb\n"}
    coded = spark.createDataFrame([("a.mp3", "AAEC")], "file_name string, content string")
    K.write_files(K.decoded(coded, "content"), f"file://{tmp_path}/out")
    assert (tmp_path / "out" / "a.mp3").read_bytes() == b"\x00\x01\x02"
    skipped = spark.createDataFrame([("a.txt", None), ("b.txt", "x")], "name string, ssml string")
    assert [tuple(r) for r in K.rendered_files(skipped, "name", "ssml", ".ssml").collect()] == [("b.ssml", "x")]


def test_short_documents_get_no_outline(spark):
    docs = spark.createDataFrame([(1, "T\n5"), (2, "T\n5\n\nbody of it")], "doc_id long, text string").select("doc_id", "text", M.title_and_body(F.col("text")).alias("p")).select("doc_id", "text", "p.title", "p.number", "p.body")
    quotes = spark.createDataFrame([], "doc_id long, rank int, sentence string")
    assert [r.doc_id for r in P.render(P.long_enough(docs), quotes).collect()] == [2]


def test_layout_metrics_defaults_and_ties(spark):
    rows = [(1, 1, 1, 72.0, 10.0), (1, 1, 2, 54.4, 26.0), (1, 1, 3, 54.0, 43.0), (1, 2, 1, 72.0, 9.0), (2, 1, 1, 60.5, 10.0)]
    got = sorted(tuple(r) for r in D.layout_metrics(spark.createDataFrame(rows, "doc int, page_no int, line_no int, x0 double, y0 double"), "doc").collect())
    assert got == [(1, 72.0, 17.0), (2, 60.0, 16.0)]


def test_counts_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "x"), (1, ""), (2, None)], "volume int, text string")
    assert sorted(map(tuple, D.counts_by(df, "volume", "text").collect())) == [(1, 2, 1), (2, 1, 0)]
    clash = spark.createDataFrame([(1, "a", 5), (1, "b", 6)], "k int, r string, r_ int")
    assert [tuple(r) for r in D.keep_first(clash, ["k"], ["r"]).collect()] == [(1, "a", 5)]
    left = spark.createDataFrame([(1, None, "o")], "k int, ref string, other string")
    assert [tuple(r) for r in D.fallback(left, left.select("k", F.lit("z").alias("ref")), "k", "ref").collect()] == [(1, "z", "o")]


@pytest.mark.parametrize(("text", "refs"), [("1Peter 2 : 3,4 and jn3:16-18; Proverb 1:2", ["1Peter 2 : 3,4", "jn3:16-18", "Proverb 1:2"]), ("no 3:4", [])])
def test_short_names_and_spacing(spark, text, refs):
    from vellum.functions import references as R

    assert one(spark, text, R.references) == refs


def test_outline_is_cut_at_sixty_lines():
    import pandas as pd

    part = {"numeral": "I", "heading": "A heading " * 9, "points": ["point " * 20] * 3, "refs": ["John 3:4"]}

    def outline(n_parts, notes):
        rows = pd.DataFrame([{"doc_id": 1, "title": "t", "number": "7", "reference": "", "date_place": "", "parts": [part] * n_parts, "notes": notes}])
        return next(P._wrap(iter([rows])))["outline"][0].split("\n")[:-1]

    rule = "─" * 55
    long = [["note " * 30] * 3, ["quote " * 30] * 3, ["use " * 40] * 2]
    whole = outline(2, long)
    assert len(whole) < 60 and whole.count(rule) == 2 and "Application:" in whole
    cut = outline(4, long)  # the notes are cut, and the rule closes
    assert len(cut) == 60 and cut[-1] == rule and cut.count(rule) == 2 and "Application:" not in cut and "Key Illustrations:" in cut
    crowded = outline(9, long)  # the divisions alone fill the page
    assert len(crowded) == 60 and crowded[-1] == rule and crowded.count(rule) == 1


def test_json_records_with_tags(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"id": "a", "location": null, "tags": ["x", "y"]},\n {"id": "b", "location": "here", "tags": []}]')
    rows = S.json_records(spark, str(tmp_path / "x.json"))
    got = rows.select("id", "location", F.explode_outer("tags").alias("tag")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", None, "x"), ("a", None, "y"), ("b", "here", None)], key=str)


def test_clean_text(spark):
    docs = spark.createDataFrame([(1, "the go spel-\nly go\nend"), (2, None), (2, "")], "doc_id int, text string")
    got = [tuple(r) for r in P.clean_text(docs, spark.createDataFrame([("gospel",), ("go",), ("the",)], "word string")).collect()]
    assert sorted(got, key=str) == sorted([(1, "the go spelly go\nend"), (2, ""), (2, "")], key=str)
