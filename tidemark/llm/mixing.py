"""Mixing sources to target weights, by blocks of a fixed number of words.

The documents of a source, laid end to end in a fixed pseudorandom order, are cut into blocks of
block_words words. Each source gets as many slots as its target asks for. They are dealt to output
shards by a multinomial draw for each source, and slot k of a source takes block P(k), where P is a
pseudorandom permutation of the source's blocks (another one in each pass over them). Slots and the
pieces of documents that lie in a block meet in a join by (source, block).

Targets: sources weigh by ``weights`` in turn, in code point order, null last. They share
share * all words; what exceeds most times the source's words goes to the others by weight, until no
target does. So no block is taken more than ceil(most) times.

All draws are keyed by seed and source, and the order of documents by their ids: reruns agree.

Defined cases: null and blank texts have size 0 and are never taken; a null source is a source of its
own; a null id sorts first; repeated rows are separate documents; sources without words get target 0;
an empty table gives no rows; other columns are ignored unless named in keep.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import aside, mark_hot, put_back, slices, split_join, stored
from tidemark.llm.words import mix as mixed_bits
from tidemark.llm.words import words

#: Documents of one source that one window sorts, about.
CHUNK_ROWS = 2_000


def with_sizes(docs: DataFrame) -> DataFrame:
    """docs with the long column size: words of text."""
    schema = StructType([*docs.schema.fields, StructField("size", LongType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", 4 << 20):
            spans = words(rows["text"].combine_chunks())
            yield from rows.append_column("size", pa.array(np.bincount(spans.row, minlength=spans.rows), pa.int64())).combine_chunks().to_batches()

    return docs.mapInArrow(measure, schema)


def targets(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, weight, target) of each source; as many rows as sources."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), ((rank - 1) % len(weights) + 1).cast("int")))
    # sources in the order in which a growing common rate reaches their limits
    per = per.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("reached", F.col("limit") / F.col("weight"))
    order = Window.orderBy("reached", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    rate = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("rate", rate)
    per = per.withColumn("rate", F.min(F.when(F.col("rate") <= F.col("reached"), F.struct("reached", "source", "rate"))).over(whole)["rate"])
    target = F.when(F.col("rate").isNull() | (F.col("weight") * F.col("rate") > F.col("limit")), F.col("limit")).otherwise(F.col("weight") * F.col("rate"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: four Feistel rounds over the next even power of two,
    repeated while the value lies outside."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            left, right = right, left ^ (mixed_bits(right, key * 4 + r) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= np.uint64(n))):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _key(source: str | None, *salt: int) -> int:
    text = f"{salt}|{'n' if source is None else 's' + source}"
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=7).digest(), "big")


def slots(sources: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, source, pass, block) for each slot of the mix; slots count within the source."""
    per = sources.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block_words))
    per = per.withColumn("slots", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))
    per = per.withColumn("shards", F.ceil(F.sum("slots").over(Window.partitionBy(F.lit(1))) / shard_slots))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = max(int(row["shards"]), 1)
                drawn = np.random.Generator(np.random.PCG64(_key(row["source"], seed))).multinomial(row["slots"], np.full(n, 1 / n))
                first = np.cumsum(drawn) - drawn
                for lo in range(0, n, 10_000):
                    d = drawn[lo:lo + 10_000]
                    yield pa.RecordBatch.from_pydict({
                        "source": pa.array([row["source"]] * len(d), pa.string()), "shard": pa.array(np.arange(lo, lo + len(d)), pa.int64()),
                        "first": pa.array(first[lo:lo + len(d)], pa.int64()), "n": pa.array(d, pa.int64()), "blocks": pa.array(np.full(len(d), row["blocks"]), pa.int64())})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for lo in range(row["first"], row["first"] + row["n"], 50_000):
                    slot = np.arange(lo, min(lo + 50_000, row["first"] + row["n"]))
                    turn, at = np.divmod(slot, row["blocks"])
                    block = np.empty(len(slot), dtype=np.int64)
                    for t in np.unique(turn).tolist():
                        block[turn == t] = permute(at[turn == t], row["blocks"], _key(row["source"], seed, t + 1))
                    yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(slot), row["shard"]), pa.int64()), "slot": pa.array(slot, pa.int64()),
                                                      "source": pa.array([row["source"]] * len(slot), pa.string()), "pass": pa.array(turn, pa.int64()), "block": pa.array(block, pa.int64())})

    dealt = per.select("source", "slots", "shards", "blocks").mapInArrow(deal, "source string, shard long, first long, n long, blocks long")
    return dealt.repartition("source", "shard").mapInArrow(fill, "shard long, slot long, source string, pass long, block long")


def laid_out(sized: DataFrame, rows: int) -> DataFrame:
    """sized with start: the words of the source before the document, in a fixed pseudorandom order.

    Each source is split by a hash of the id into chunks; running sums in a chunk and over the chunks'
    totals meet, so that the largest source is no single sort.
    """
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-rows // CHUNK_ROWS))))
    sized = sized.withColumn("_chunk", chunk)
    inside = Window.partitionBy("source", "_chunk").orderBy("doc_id", "_tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    totals = sized.groupBy("source", "_chunk").agg(F.sum("size").alias("_words"))
    before = F.sum("_words").over(Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(F.col("source").alias("_source"), F.col("_chunk").alias("_at"), F.coalesce(before, F.lit(0)).alias("_before"))
    placed = sized.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    met = placed.join(totals, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_chunk") == F.col("_at")))
    return met.withColumn("start", F.col("_in") + F.col("_before")).drop("_in", "_before", "_source", "_at", "_chunk")


def spans(placed: DataFrame, slot_rows: DataFrame, block_words: int) -> DataFrame:
    """The mix as pieces of documents: (shard, slot, source, pass, block, start, first_word, n_words).

    first_word counts in the document that starts at word start of its source.
    """
    b = F.lit(block_words)
    pieces = placed.where("size > 0").select("source", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))).alias("block"))
    low, high = F.greatest(F.col("start"), F.col("block") * b), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
    pieces = pieces.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "start", (low - F.col("start")).alias("first_word"), (high - low).alias("n_words"))
    # slots are made from a few rows each: Spark would take them for small and broadcast them
    return slot_rows.hint("merge").join(pieces.hint("merge"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))).drop("_source", "_block")


class Mix:
    """A mix of docs(doc_id, text, source) and the tables it is made of.

    documents: doc_id, source, size, start and the columns of keep; sources: targets(); spans: the mix.
    """

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                 block_words: int = 128, shard_slots: int = 4096, seed: int = 1, keep: tuple[str, ...] = ()):
        columns = list(dict.fromkeys(["doc_id", "text", "source", *keep]))
        rows = docs.select(*columns).withColumn("_tie", F.xxhash64("text"))
        sized = with_sizes(rows)
        self.keep = keep
        sized = stored(sized.select(*[c for c in sized.columns if c != "text" or c in keep]), "sized")
        self.sources = stored(targets(sized, weights, share, most), "targets")
        self.documents = stored(laid_out(sized, sized.count()), "placed")
        self.spans = spans(self.documents, slots(self.sources, block_words, shard_slots, seed), block_words)

    def rows(self, docs: DataFrame) -> DataFrame:
        """The mix as rows of docs, with _pass: of each document the words that the mix takes in a pass.

        Words next to each other keep the white space between them; a line end stands where words are left out.
        """
        columns = list(docs.columns)
        # copies of a row are numbered within their source, so that each gets words of its own source
        same = Window.partitionBy("doc_id", "_tie", "source")
        pieces = self.spans.groupBy("source", "start", "pass").agg(F.array_sort(F.collect_list(F.struct("first_word", "n_words"))).alias("_words"))
        pieces = pieces.select(F.col("source").alias("_source"), F.col("start").alias("_start"), F.col("pass").alias("_pass"), "_words")
        placed = self.documents.where("size > 0").withColumn("_copy", F.row_number().over(same.orderBy("start"))).select("doc_id", "_tie", "_copy", "source", "start")
        placed = placed.join(pieces, F.col("source").eqNullSafe(F.col("_source")) & (F.col("start") == F.col("_start")))
        placed = placed.select(F.col("doc_id").alias("_id"), F.col("_tie").alias("_t"), F.col("_copy").alias("_c"), "_source", "_pass", "_words")
        own = docs.select("doc_id", "text", F.col("source"), aside(docs, "doc_id", "text")).withColumn("_tie", F.xxhash64("text"))
        own = own.withColumn("_copy", F.row_number().over(same.orderBy(F.xxhash64("_row"))))
        met = own.join(placed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t")) & (F.col("_copy") == F.col("_c")) & F.col("source").eqNullSafe(F.col("_source")))
        met = met.select(*put_back(columns, "doc_id", "text"), "_pass", "_words")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = words(batch.column("text"))
                at, data = found.per_row(), found.data.tobytes()
                texts = []
                for i, pieces in enumerate(batch.column("_words").to_pylist()):
                    runs: list[list[int]] = []
                    for p in pieces:
                        if runs and runs[-1][1] == p["first_word"]:
                            runs[-1][1] += p["n_words"]
                        else:
                            runs.append([p["first_word"], p["first_word"] + p["n_words"]])
                    texts.append(b"\n".join(data[found.start[at[i] + a]:found.end[at[i] + b - 1]] for a, b in runs).decode())
                made = {c: batch.column(c) for c in [*columns, "_pass"]} | {"text": pa.array(texts, pa.string())}
                yield pa.RecordBatch.from_pydict(made)

        return met.mapInArrow(cut, StructType([*docs.schema.fields, StructField("_pass", LongType())]))

    def taken(self) -> DataFrame:
        """documents with source_size, target and taken: the words the mix takes, repeats counted."""
        per = self.spans.groupBy("source", "start").agg(F.sum("n_words").alias("taken"))
        per = per.select(F.col("source").alias("_source"), F.col("start").alias("_start"), "taken")
        same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
        met = self.documents.join(per, same, "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
        rows = self.documents.groupBy("source").agg(F.count("*").alias("_rows"))
        wide = self.sources.select(F.col("source").alias("_name"), "source_size", "target")
        wide = rows.join(wide, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
        return split_join(met.drop("_source", "_start", "_tie"), mark_hot(wide, "_rows"), ["source"]).drop("_rows")
