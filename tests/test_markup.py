from pyspark.sql import functions as F

from vellum.functions import markup as M
from vellum.functions import references as R
from vellum.functions import text as X


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "s string").select(make(F.col("s")).alias("v")).first().v


def test_speech(spark):
    got = one(spark, "A. Bc, d.\n\nE.", lambda s: M.speech(F.lit("T"), F.lit("9"), X.comma_breaks(M.marked_body(s))))
    assert got == (
        '<speak>\n<prosody rate="slow" pitch="-8%" volume="soft">\n\n<p>\n<s><emphasis level="strong">T</emphasis></s>\n<break time="1500ms"/>\n</p>\n\n'
        '<p>\n<s><sub alias="Sermon number 9">No. 9</sub>.</s>\n<break time="1200ms"/>\n</p>\n\n'
        '<p>\n<s>A.</s>\n<break time="750ms"/>\n<s>Bc,<break time="400ms"/> d.</s>\n</p>\n\n<break time="1200ms"/>\n\n<p>\n<s>E.</s>\n</p>\n\n</prosody>\n</speak>\n'
    )


def test_sentences_lose_the_closing_quote(spark):
    assert one(spark, 'He said "go." Then he left. 3 men', X.sentences) == ['He said "go.', "Then he left.", "3 men"]


def test_small_functions(spark):
    assert one(spark, "the love of god", X.title_case) == "The Love of God"
    assert one(spark, "God's Word—A Light", X.pascal_case) == "GodsWordALight"
    assert one(spark, "a, b; c", X.comma_breaks) == 'a,<break time="400ms"/> b;<break time="400ms"/> c'
    assert one(spark, "con- tinue <em>a</em> <em>b</em>", lambda s: X.merge_tags(X.rejoin_hyphen(s))) == "continue <em>ab</em>"  # the white space between tags goes with them
    assert one(spark, "Contents", X.bookmark_numbers) is None
    assert one(spark, "<speak><prosody rate='x'>Hi</prosody></speak>", X.prosody_inner) == "<speak>Hi</speak>"
    assert one(spark, "x\n  Scripture:  John 3:16 \n", R.noted_reference) == "John 3:16"
    assert one(spark, None, R.expand_references) is None


def test_volume_ranges(spark):
    from vellum.operators.documents import assign_volume, volume_ranges

    rows = spark.createDataFrame([(n,) for n in (1, 53, 54, 347, 348, 3563, 0, 9999)], "n int")
    assert [r.volume for r in assign_volume(rows, "n").collect()] == [1, 1, 2, 6, 7, 63, 63, 63]
    ranges = sorted((r.lo, r.hi) for r in volume_ranges(spark).collect())
    assert len(ranges) == 63 and all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:])) and ranges[-1][1] == 3563


def test_weak_openings_need_one_more_strong_word(spark):
    from vellum.operators.documents import top_sentences

    text = "And the rest of it went down there. The rest of it went down there. But the rest of the house fell. The rest of it went down there. The rest of it Went up at last."
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    best = lambda n: [r.sentence for r in top_sentences(rows, ("the", "of"), prefix=19, at_least=n).orderBy("rank").collect()]
    # equal scores keep their order; a prefix counts once, and case matters in it
    assert best(2) == ["But the rest of the house fell.", "The rest of it went down there.", "The rest of it Went up at last."]
    assert best(1) == [*best(2), "And the rest of it went down there."]
