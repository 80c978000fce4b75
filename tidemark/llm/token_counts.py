"""Tokens per document without making ids: pieces are counted once per distinct pre-token.

The tokenizer splits a text at white space, then into runs of letters, single digits and runs of other
characters, lower-cased; no piece crosses such a border. Here texts are cut at those of the borders
that lie between ASCII characters (and not behind an apostrophe, which may begin a contraction); a
unit is one pre-token or a few. Texts that hold a special token's opening ``<|`` are cut at white space only and
keep their case, as special tokens are matched in the text as it stands. Each distinct unit goes through
the tokenizer once; the counts are joined to the documents' frequencies and summed.

Defined cases: a null or blank text has 0 tokens; rows with equal or null ids are all counted; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import spread, tokenizer
from tidemark.llm.vocabulary import by_unit, distinct_units, meet, packed_documents, require, unpacked
from tidemark.llm.words import BYTE_KIND, LOWER, Spans, raw

COUNTED = "doc_id long, n_bytes long, n_tokens long"


def pre_tokens(column: pa.Array) -> Spans:
    """The units of each text (see above)."""
    data, offsets = raw(column)
    whole = pc.fill_null(pc.match_substring(column, "<|"), False).to_numpy(zero_copy_only=False)
    fine = ~np.repeat(whole, np.diff(offsets))
    kind = BYTE_KIND[data]
    n = len(data)
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    a, b = kind[:-1], kind[1:]
    border[1:n] |= (a == 0) != (b == 0)
    inner = (a != 4) & (b != 4) & ((a != b) | (a == 2)) & (data[:-1] != 0x27)
    border[1:n] |= inner & fine[1:]
    edges = np.flatnonzero(border)
    start, end = edges[:-1], edges[1:]
    keep = (kind[start] != 0) if n else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    return Spans(np.where(fine, LOWER[data], data), start, end, np.searchsorted(offsets, start, side="right") - 1, len(column))


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of docs(doc_id, text) as the library counts them."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(vocabulary)
        for batch in batches:
            n = [len(x) for x in t.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)]
            yield pa.RecordBatch.from_pydict({"unit": batch.column(0), "pieces": pa.array(n, pa.int32())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                n, place, freq = unpacked(row["units"].as_py(), row["at"].as_py(), row["freq"].as_py(), False)
                require(row, place)
                totals = np.zeros(len(n), dtype=np.int64)
                if len(place):
                    found = row["values"].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    sums = np.concatenate([[0], np.cumsum(found[place] * freq)])
                    ends = np.cumsum(n)
                    totals = sums[ends] - sums[ends - n]
                yield pa.RecordBatch.from_pydict({"doc_id": row["doc_id"].values.cast(pa.int64()), "n_bytes": row["n_bytes"].values, "n_tokens": pa.array(totals, pa.int64())})

    docs = docs.select("doc_id", "text")
    units, checks = distinct_units(docs, "text", pre_tokens)
    dealt, distinct = by_unit(units, max(spread(docs, 16), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    per_unit = distinct.mapInArrow(pieces, "unit string, pieces int")
    return meet(packed_documents(docs, "text", pre_tokens, ["doc_id"], sequence=False), dealt, checks, per_unit, "pieces").mapInArrow(add, COUNTED)
