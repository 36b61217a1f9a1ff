import pytest
from pyspark.sql import functions as F

from vellum.functions import outline as O
from vellum.operators import outline as P


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "s string").select(make(F.col("s")).alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "n", "want"),
    [
        ("Go now. Then stay.", 75, "Go now."),
        ("one two", 75, "one two"),
        ("aaaa bbbb cccc, dddd eeee ffff", 20, "aaaa bbbb cccc"),
        ("aaaa bbbb cccc dddd eeee ffff", 20, "aaaa bbbb cccc dddd "),
        ("aaaa bbbb cccc; dd, ee ffff gggg", 20, "aaaa bbbb cccc"),
    ],
)
def test_complete_phrase(spark, text, n, want):
    assert one(spark, text, lambda s: O.complete_phrase(s, n)) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("First, THE GREAT WORK'S END, and so on", "The Great Work'S End"),
        ("We now come to the second matter of hope; and more", "The Second Matter of Hope"),
        ("and the plain thing which follows Volume 3", "The Plain Thing"),
    ],
)
def test_heading(spark, text, want):
    assert one(spark, text, O.heading) == want


def test_head_of_a_document(spark):
    text = 'T\nA TALK DELIVERED ON SABBATH MORNING, JANUARY 7, 1855,\nAT THE OLD HALL, TOWN.\n"Some words\nof old." Romans 1:2\nBody starts here.'
    assert one(spark, text, O.date_and_place) == "SABBATH MORNING, JANUARY 7, 1855; THE OLD HALL, TOWN"
    assert one(spark, text, O.opening_reference) == "Romans 1:2"
    assert one(spark, text, O.body_start) == 5
    assert one(spark, "x\ny", O.date_and_place) == "" and one(spark, "x\nJohn 3:4", O.opening_reference) == "John 3:4"
    assert one(spark, "x\ny", O.body_start) == 1


def test_divisions(spark):
    roman = "Intro\nI. First the theme\nGOES ON\n\nsee John 3:4 and John 3:4.\nII. The next matter of the long and plain day is here now.\nMark 1:1"
    ordinal = "x\nFirst, we see light. More\nIn the second place, dark Luke 2:2"
    topics = "a" * 501 + "\n\n" + "Here is a sentence long enough to count. And another one follows it.\n"
    rows = P.divisions(spark.createDataFrame([(1, roman), (2, ordinal), (3, topics), (4, None), (5, "")], "doc_id int, body string")).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.numeral, r.heading, r.refs) for r in rows] == [
        (1, "I", "First the Theme Goes on", ["John 3:4"]),
        (1, "II", "The Next Matter of the Long and Plain Day is Here Now", ["Mark 1:1"]),
        (2, "I", "We See Light", []),
        (2, "II", "Dark Luke 2", ["Luke 2:2"]),
        (3, "I", "Here is a Sentence Long Enough to Count", []),
    ]
    assert rows[2].section == "First, we see light. More\n" and rows[4].section == topics


def test_illustrations_and_applications(spark):
    body = "x\nHe stood. Faith here, holding firm like a ship upon the sea, sails. So.\nSuppose a farmer sows his field, then waits for long.\nplain line without any mark at all in it\n\nTHE END IS ALL CAPS HERE AND NOW\nLet us go up together to the hill today. Nothing here to keep at all, friends. Let us go up together to the hill again."
    docs = spark.createDataFrame([(1, body), (2, None)], "doc_id int, body string")
    assert [r.illustration for r in P.illustrations(docs).orderBy("pos").collect()] == ["like a ship upon the sea -- Holding Firm", "A farmer sows his field"]
    assert [r.application for r in P.applications(docs).orderBy("pos").collect()] == ["Let us go up together to the hill today."]


def test_subpoints(spark):
    assert one(spark, "I. head\n1. Alpha beta gamma delta.\n2. Epsilon zeta eta theta\n3. Tiny", O.subpoints) == ["Alpha beta gamma delta.", "Epsilon zeta eta theta 3."]
    assert one(spark, "head\n\nThe grace of all the days is near. More text here.\n\nNothing strong in this sentence. More.", O.subpoints) == ["The grace of all the days is near."]


def test_render(spark):
    docs = spark.createDataFrame([(1, "Title", "7", "Title\nJohn 1:1", "I. A theme of light\n1. A first point of it."), (2, None, None, None, None)], "doc_id int, title string, number string, text string, body string")
    quotes = spark.createDataFrame([(1, 2, "Second."), (1, 1, "First.")], "doc_id int, rank int, sentence string")
    got = {r.doc_id: r.outline.split("\n") for r in P.render(docs, quotes).collect()}
    assert got[1][:4] == ["TITLE", "Sermon #7", "Scripture: John 1:1", "═" * 55]
    assert got[1][5:] == ["I. A Theme of Light", "   • A first point of it.", "", "─" * 55, "Key Quotes:", '   • "First."', '   • "Second."', "", "─" * 55, ""]
    assert "[No clear structural divisions detected]" in got[2]


def test_broken_words(spark):
    words = spark.createDataFrame([(w,) for w in ("gospel", "father", "fat", "her", "go", "continued", "into", "in", "to")], "word string")
    lines = spark.createDataFrame([(1, "the go spel, Fat her and con tin ued"), (2, None), (3, "God's elect  in to"), (4, "")], "i int, line string")
    got = {r.i: r.line for r in P.join_broken_words(lines, "line", words).collect()}
    assert got == {1: "the gospel, Father and con tin ued", 2: None, 3: "God's elect  into", 4: ""}


def test_layout_roles(spark):
    rows = [(1, 1, "HEAD", 14.0, 54.0), (1, 2, "“Words", 12.0, 54.0), (1, 3, " ", 12.0, 54.0), (1, 4, "ref", 12.0, 54.0), (1, 5, "Body", 13.9, 54.0), (2, 1, "HEAD", 14.0, 54.0), (2, 2, "Text", 14.0, 60.0), (2, 3, "\"late", 12.0, 60.0), (3, 1, "HEAD", 9.0, 0.0)]
    lines = spark.createDataFrame(rows, "doc int, line_no int, text string, size double, x0 double")
    got = [r.role for r in P.layout_roles(lines, F.col("text") == "HEAD", 54.0).orderBy("doc", "line_no").collect()]
    assert got == ["metadata", "scripture", "metadata", "scripture", "body", "metadata", "body", "body", "body"]


def test_escape_ascii(spark):
    import json

    for text in ("plain", "é—x", "a😀b"):
        assert one(spark, text, O.escape_ascii) == json.dumps(text)[1:-1]


def times(spark, make, what):
    """How often the expression that make gives names what."""
    return spark.range(1).selectExpr("string(id) AS s").select(make(F.col("s")).alias("v"))._jdf.queryExecution().analyzed().toString().count(what)


def test_points_are_searched_once(spark):
    assert times(spark, O.subpoints, "regexp_extract_all(") == 1
    assert times(spark, lambda s: O.complete_phrase(s, 75), "regexp_replace(s#") == 1


def test_topic_sentences_are_found_once(spark):
    assert times(spark, lambda s: P.topic_parts(s, F.split(s, "\n", -1)), "aggregate(") == 1
    assert times(spark, lambda s: P.paragraph_from(F.split(s, "\n", -1), F.lit(0)), "array_position(") == 1


def test_roman_marks_are_found_once(spark):
    assert times(spark, lambda s: P.roman_parts(F.split(s, "\n", -1)), "filter(transform(split(") == 1


def test_ordinal_marks_are_found_once(spark):
    assert times(spark, P.ordinal_parts, "regexp_extract_all(") == 1
    body = "First, a b. x\nSecondly, c d\nIn the third place, e. y"
    got = one(spark, body, P.ordinal_parts)
    assert [(p.numeral, p.text, p.section) for p in got] == [("I", "a b", "First, a b. x\n"), ("II", "c d\nIn the third place, e", "Secondly, c d\n"), ("III", "e", "In the third place, e. y")]


def test_a_head_is_searched_for_references_once(spark):
    assert times(spark, O.opening_reference, "regexp_extract_all(") == 1
