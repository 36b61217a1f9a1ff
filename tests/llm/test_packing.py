import struct
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from vellum.llm import packing as P

SCHEMA = "doc_id long, text string, piece int, shard int"


def check(rows, got, capacity=1024):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        at, k = 0, 0
        while at < len(ids):
            n = capacity if at or len(ids) % capacity == 0 else len(ids) % capacity
            part = ids[at : at + n]
            want.append((d, k, at, n, zlib.crc32(struct.pack(f"<{n}I", *part))))
            at, k = at + n, k + 1
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans), -(-sum(r.length for r in got) // capacity)


def test_pieces_and_sequences(spark, tmp_path):
    rows = [(i, f"Word{i % 7} été  it's 12٣4 <|endoftext|>\n\n x" * (i % 90)) for i in range(300)]
    rows += [(None, None), (1, ""), (1, ""), (5, "a" * 30000), (6, "Straße ½² ﬁ    end "), (7, "x y " * 1024)]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], SCHEMA)
    got = P.pack_documents(df).collect()
    sequences, bound = check(rows, got)
    assert sequences <= bound * 1.03 + 1


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_shards_stay_valid(spark):
    rows = [(i, "lorem ipsum " * (i % 400)) for i in range(400)]
    got = P.pack(P.tokenised_pieces(spark.createDataFrame(rows, "doc_id long, text string")), shard_pieces=100).collect()
    check(rows, got)


def test_sum_of_squares_prefers_the_smaller_sum():
    # after 600, 600, 724 the gaps are 424 twice and 300 once: from 424 the squares change by 1 - 4 + 1, from 300 by 1 - 1
    sequence, offset = P.sum_of_squares(np.array([600, 600, 724, 100]))
    assert sequence.tolist()[:3] == [0, 1, 2] and sequence[3] in (0, 1) and offset[3] == 600


def test_ties_take_the_smallest_gap():
    # after 600, 600, 700 the gaps are 424 twice and 324 once: either way the sum stays
    sequence, offset = P.sum_of_squares(np.array([600, 600, 700, 100]))
    assert sequence.tolist() == [0, 1, 2, 2] and offset[3] == 700


def test_sum_of_squares_against_plain_python():
    r = np.random.default_rng(3)
    lengths = r.integers(1, 64, 400)
    got, offsets = P.sum_of_squares(lengths, 64)
    level: list[int] = []
    for i, s in enumerate(lengths.tolist()):
        def total(k, level=level, s=s):
            gaps = [64 - x for x in level]
            gaps[k] -= s
            return sum(gaps.count(g) ** 2 for g in set(gaps) if 0 < g < 64)

        fit = [k for k, x in enumerate(level) if x + s <= 64 and x < 64]
        if fit:
            best = min((total(k), 64 - level[k]) for k in fit)
            assert (total(int(got[i])), 64 - level[got[i]]) == best and offsets[i] == level[got[i]]
            level[got[i]] += s
        else:
            assert got[i] == len(level) and offsets[i] == 0
            level.append(s)


def test_repeated_rows_are_dealt_apart(spark):
    df = spark.createDataFrame([(1, "same words here")] * 400, "doc_id long, text string")
    got = P.pack(P.tokenised_pieces(df), shard_pieces=50).collect()
    assert len(got) == 400 and len({r.sequence_id >> 32 for r in got}) == 8


def test_fast_ids_on_whole_documents(spark):
    e, t = P.DocumentEncoder(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sum(not e.slow(x) for x in texts) > 100
    assert [np.frombuffer(e.ids(x), "<u4").tolist() for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_cut():
    assert P.cut(1) == [(0, 1)] and P.cut(1024) == [(0, 1024)] and P.cut(2050) == [(0, 2), (2, 1024), (1026, 1024)]


def test_fast_ids_equal_the_tokenizers():
    e, t = P.DocumentEncoder(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    chars = [chr(c) for c in range(0x250)]
    texts = [f"{a}{c}{c}{b}" for c in chars for a, b in (("a", "b"), (" ", " "), ("'", "s1"), ("\n", "")) if c]
    texts += [c * 3 for c in chars] + ["".join(chars), "don't  I'LL \t\n 12½3"]
    assert [np.frombuffer(e.ids(x), "<u4").tolist() for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]
