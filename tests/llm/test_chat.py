import duckdb

from vellum.llm import chat as C


def test_views(spark):
    rows = [(1, 1, "bob", "hi <|x|>", 0), (1, 0, "system", "rules", 0), (1, 2, "amy", "é𝒳", 0), (1, 600, "bob", None, 0), (2, 0, "system", "s", 0), (None, None, None, "z", 0), (None, None, None, "z", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, name int")
    got = {(r.conv_id, r.part, r.participant): r for r in C.rotate(df).collect()}
    assert set(got) == {(1, 0, "bob"), (1, 0, "amy"), (1, 1, "bob"), (1, 1, "amy"), (None, -1, "unknown")}
    bob = got[1, 0, "bob"]
    assert bob.text == '<|system|>\nrules\n<|assistant|>\nhi < |x|>\n<|user name="amy"|>\né𝒳\n'
    a, b = map(int, bob.mask.split(":"))
    assert bob.text[a:b] == "hi < |x|>" and got[1, 1, "amy"].mask == "" and got[1, 1, "bob"].mask == "14:14"
    assert got[None, -1, "unknown"].n_turns == 2
    assert C.rotate(df.limit(0)).count() == 0


def test_sql_agrees(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    got = C.op7_chat(spark, d)
    cols = ", ".join(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"SELECT {cols} FROM ({C.OP7_SQL})").fetchall())
