from vellum.sources import sinks, text


def test_text_files_and_words(spark, tmp_path):
    (tmp_path / "b.txt").write_text("Title.\n\nBody é\n")
    (tmp_path / "c.md").write_text("no")
    assert [tuple(r) for r in text.text_files(spark, str(tmp_path)).collect()] == [("b.txt", "Title.\n\nBody é\n")]
    (tmp_path / "w").write_text("One\n\ntwo\nThree\nthree\nPaul\n1st\n")
    assert {r.word for r in text.word_list(spark, str(tmp_path / "w"), ("gospel",)).collect()} == {"two", "three", "gospel"}
    assert text.volume_files(spark).count() == 63


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("07_a.txt", "é", 1)], "name string, body string, volume int")
    assert tuple(sinks.rendered_files(df, "name", "body", ".ssml").first()) == ("07_a.ssml", "é")
    for _ in range(2):
        sinks.write_table(df, str(tmp_path / "t"), "volume")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    assert "\\u00e9" in sinks.catalogue_json(df)
