"""The pipeline's stages: columns, decisions, whole results; and every registered query at the smallest scale."""

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_jaccard import brute
from tidemark.llm.common import stored
from tidemark.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, stages = {}, dict(corpus_pipeline.STAGES)
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SF), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        kept[name] = after.collect()
        before = after
    assert list(stages) == ["quality", "near-duplicates", "surrogates", "mixing", "sentencepiece"]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(quality.get(r.doc_id) != 0 for r in kept["quality"])
    assert {i for i, q in quality.items() if q == 1} <= {r.doc_id for r in kept["quality"]}
    rows = sorted(kept["quality"], key=lambda r: r.doc_id)
    _, roots = brute([r.text for r in rows])
    assert sorted(r.doc_id for r in kept["near-duplicates"]) == [r.doc_id for k, r in enumerate(rows) if roots[k] == k]
    assert len(kept["surrogates"]) == len(kept["near-duplicates"]) and not any("@mail" in r.text for r in kept["surrogates"])
    assert all(r.n_chars == len(r.text) for r in kept["mixing"])
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r.doc_id, r.ids) for r in kept["sentencepiece"]) == sorted((r.doc_id, sp.encode(r.text)) for r in kept["mixing"])
    assert all(r.round_trip for r in kept["sentencepiece"])


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert queries().keys() >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    df = queries()[name](spark, SF)
    table = {"op3": "pages", "op7": "embeddings", "op10": "embeddings", "op13": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    if name.startswith("op13"):
        rows = rows.select("conv_id").distinct()
    assert df.count() == (5 * rows.where(F.col("vec_id") % 50 == 0).count() if name.startswith("op10") else rows.count())
    if name in oracle_sql():
        con = duckdb.connect()
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
        key = lambda r: tuple((x is not None, x) for x in r)
        expected = con.sql(oracle_sql()[name]).select(*df.columns).fetchall()
        assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)
