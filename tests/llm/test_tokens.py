"""Token counts, token files and SentencePiece against the libraries."""

import itertools
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import pieces, token_counts, token_files

ODD = ["it's 'tis a''s DON'T we'll", "<|startoftext|>Hello<|endoftext|> <|endoftext|> there", "é Éa 'é's", "a b c\x85d\x1cx", "ΣΑΣ İstanbul K ſ",
       "  lead and trail  ", "\n\n a\n b\t\tc", "1234abc12.5--x_y", "日本語テキスト、。😀😀a", "a\x0bb\x0cc", "▁ literal ▁", "</s><s><unk>", " " * 300, "x" * 400, "ab" * 100]


@pytest.fixture
def odd(spark, documents):
    more = spark.createDataFrame([(100 + i, t, None, None, 0, "x") for i, t in enumerate(ODD)], documents.schema)
    return documents.unionByName(more).coalesce(2)


def test_counts_equal_the_librarys(odd):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(odd, P.path("word_bpe_49k.json")).collect())
    assert got == sorted((str(r.doc_id), len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())


def test_counts_of_nothing(nothing):
    assert token_counts.count_tokens(nothing, P.path("word_bpe_49k.json")).collect() == []


def test_files_hold_the_librarys_ids(odd, spark):
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    manifest = token_files.write_ids(odd, path, 50257, slice_bytes=300)
    got = sorted(token_files.read_ids(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in odd.collect()), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    expected = []
    for r in odd.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 0]
        expected.append((str(r.doc_id), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(expected)


def test_files_of_nothing(nothing, spark):
    assert token_files.read_ids(spark, token_files.write_ids(nothing, P.path("byte_bpe_50k.json"), 50257)).collect() == []


def test_pieces_equal_the_librarys_and_decode(odd):
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = odd.withColumn("whole", F.col("text"))
    for r in pieces.decode(pieces.encode(plain, path, ["doc_id", "whole"]), path, ["doc_id", "whole"], with_ids=True).collect():
        assert r.ids == sp.encode(r.whole or ""), r.whole
        assert r.text == (r.whole or "").replace("▁", " ") and r.n_ids == len(r.ids)


def test_pieces_of_nothing(nothing):
    path = P.path("piece_bpe_32k.model")
    assert pieces.encode(nothing, path, ["doc_id"]).collect() == []


def test_viterbi_takes_the_best_path(spark):
    table = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -3.5, "aba": -6.0, "bab": -4.0, "c": -1.0, "abc": -5.5}
    rows = [(p, i, s, 0) for i, (p, s) in enumerate(table.items())] + [("", 0, 0.0, 0)]
    units = ["abab", "cab", "abcab", "a", "zab", "babab", "ccz"]
    df = spark.createDataFrame([(u,) for u in units], "unit string")
    edges = pieces.lattice(df, spark.createDataFrame(rows, "piece string, id int, score double, rank int"), 3, pieces.scored_edge())
    cuts = pieces.best_path(F.length("unit"), F.map_from_entries("edges"), -20.0, 3)

    def best(u):
        ways = []
        for k in range(len(u)):
            for at in itertools.combinations(range(1, len(u)), k):
                parts = [u[a:b] for a, b in zip((0, *at), (*at, len(u)), strict=True)]
                if all(p in table or len(p) == 1 for p in parts):
                    ways.append(sum(table.get(p, -20.0) for p in parts))
        return max(ways)

    for r in edges.select("unit", cuts.alias("cuts")).collect():
        parts = [r.unit[a:b] for a, b in itertools.pairwise(r.cuts)]
        assert sum(table.get(p, -20.0) for p in parts) == pytest.approx(best(r.unit)), r


def test_units_of_pieces_are_dealt_once(spark, tmp_path):
    """Without adaptive plans, whose reuse shows at run time only: one exchange of units, and others that reuse it."""
    spark.createDataFrame([(i, "some words " * 3 + "x" * 300) for i in range(5)], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.read.parquet(str(tmp_path / "docs"))
        plan = pieces.encode(docs, P.path("piece_bpe_32k.model"), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    dealt = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_NUM" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1 and len(dealt) == 3, plan
