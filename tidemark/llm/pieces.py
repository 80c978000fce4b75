"""SentencePiece encoding and decoding as a relational lattice.

A text is cut where no piece of the model can reach across, into units; distinct units are encoded
once. For those, bounded-length substrings are exploded and joined to the piece table, the
edges found are grouped by unit, and the best segmentation is folded from them by Spark's higher-order
functions. Ids come back to the documents through ``vocabulary``.

The model's type says what best means. UNIGRAM: the path of the highest summed score (Viterbi, folded
over end positions). BPE: the library merges the highest-scored neighbouring pair first, again and
again; a path of summed scores gives other pieces, so for such a model the same edges are folded by
that rule instead. Characters without a piece become their bytes' pieces, or the unknown id where the model has no byte pieces.

Defined cases: null and empty texts have no ids; a text's own U+2581 counts as a space, as in the
library; a unit of over LONG characters without any border is encoded by the library itself, since the fold's
time is quadratic in a unit's length; equal rows are all encoded; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import spread
from tidemark.llm.vocabulary import by_unit, distinct_units, listed, meet_lists, packed_documents, unpacked
from tidemark.llm.words import Spans, raw

# Fixed values of the model format.
SPACE = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNIGRAM, BPE = 1, 2

LONG = 128
#: Code points whose own pieces are looked up in a list.
SINGLES = 0x250


@dataclass(frozen=True)
class Model:
    kind: int
    pieces: tuple[tuple[str, int, float], ...]
    first_byte: int | None
    unknown: int
    prefix: bool

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    """The piece table of a model file without normalisation rules of its own."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    rules = proto.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with identity normalisation are supported")
    normal = tuple((p.piece, i, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL)
    bytes_ = [i for i, p in enumerate(proto.pieces) if p.type == BYTE]
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
    return Model(proto.trainer_spec.model_type, normal, bytes_[0] if bytes_ else None, unknown, rules.add_dummy_prefix)


@functools.lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


# ---- borders ----

@functools.lru_cache(maxsize=2)
def _joints(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Number of each character that occurs in a longer piece, and which pairs stand together in one."""
    long = [p for p, _, _ in model(path).pieces if len(p) > 1]
    chars = sorted({c for p in long for c in p})
    number = np.zeros(0x110000, dtype=np.int32)
    number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
    together = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
    for p in long:
        n = number[[ord(c) for c in p]]
        together[n[:-1], n[1:]] = True
    return number, together


def normalised(column: pa.Array, prefix: bool) -> pa.Array:
    """Spaces escaped; a prefix space in front of every text that isn't empty."""
    out = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), " ", SPACE)
    if not prefix:
        return out
    return pc.if_else(pc.equal(out, ""), "", pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), out, pa.scalar("", pa.large_string())))


def cutter(path: str):
    """Cuts texts wherever no piece holds the two characters side by side."""
    def cut(column: pa.Array) -> Spans:
        number, together = _joints(path)
        data, offsets = raw(normalised(column, model(path).prefix))
        begin = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        n = number[points]
        first = np.ones(len(points), dtype=bool)
        if len(points) > 1:
            first[1:] = ~together[n[:-1], n[1:]]
            rows = np.searchsorted(begin, offsets[:-1])
            first[rows[rows < len(points)]] = True
        start = begin[first]
        end = np.append(start[1:], len(data)) if len(start) else start
        return Spans(data, start, end, np.searchsorted(offsets, start, side="right") - 1, len(column))

    return cut


# ---- lattice ----

def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """(piece, id, score, rank): as many rows as the model has pieces, rank counting from the best score.

    The row of the empty piece gives every unit an edge, also those in which no piece occurs.
    """
    m = model(path)
    rank = {s: i for i, s in enumerate(sorted({s for _, _, s in m.pieces}, reverse=True))}
    rows = [(p, i, s, rank[s]) for p, i, s in m.pieces]
    return spark.createDataFrame([*rows, ("", 0, 0.0, 0)], "piece string, id int, score double, rank int")


def lattice(units: DataFrame, pieces: DataFrame, longest: int, edge: Column, singles: bool = False) -> DataFrame:
    """(unit, edges): an edge for each place in a distinct unit where a piece stands.

    edge says what an edge holds, from the columns at (begin * 256 + length), id, score and rank. With
    singles, characters below SINGLES have no edges of their own.
    """
    n = F.length("unit")
    begins = units.select("unit", n.alias("n"), F.explode_outer(F.sequence(F.lit(0), n - 1)).alias("begin"))  # never empty; for explode() Spark adds a filter in front of the units' exchange
    # the ids of single characters below SINGLES come from a list, they need no edge
    least = F.when(F.lit(singles) & (F.ascii(F.expr("substring(unit, begin + 1, 1)")) < SINGLES), F.lit(2)).otherwise(F.lit(1))
    lengths = F.filter(F.sequence(F.lit(0), F.least(F.lit(longest), F.col("n") - F.col("begin"))), lambda k: (k >= least) | (k + F.col("begin") == 0))
    parts = begins.select("unit", "begin", F.explode(lengths).alias("length"))
    parts = parts.select("unit", (F.col("begin") * 256 + F.col("length")).alias("at"), F.expr("substring(unit, begin + 1, length)").alias("piece"))
    edges = parts.join(F.broadcast(pieces), "piece")  # the model's table, fixed in size
    return edges.groupBy("unit").agg(F.collect_list(edge).alias("edges"))


def packed_edge() -> Column:
    """An edge of a BPE lattice: place, rank and id in one number."""
    return F.shiftleft(F.col("at").cast("long"), 40) + F.shiftleft(F.col("rank").cast("long"), 20) + F.col("id")


def scored_edge() -> Column:
    return F.struct(F.col("at").cast("long").alias("at"), F.struct("score", "id").alias("edge"))


def _packed_index(edges: Column) -> Column:
    """Packed edges by place: rank and id."""
    return F.map_from_arrays(F.transform(edges, lambda e: F.shiftright(e, 40)), F.transform(edges, lambda e: e.bitwiseAND(2**40 - 1)))


def merged(n: Column, index: Column) -> Column:
    """Borders of the BPE segmentation of n characters: best-ranked neighbours merge first, leftmost of equals."""
    def step(cuts: Column, _: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(1), F.size(cuts) - 2), lambda i: F.struct(
            F.shiftright(F.try_element_at(index, (F.get(cuts, i - 1) * 255 + F.get(cuts, i + 1)).cast("long")), 20).alias("rank"), i.alias("i")))
        best = F.array_min(F.filter(inner, lambda x: x["rank"].isNotNull()))
        # a cut that stays put ends the merging: -1 in front marks it
        one = F.transform(F.array(best), lambda b: F.when(b.isNull(), F.concat(F.array(F.lit(-1)), cuts)).otherwise(F.filter(cuts, lambda c, j: j != b["i"])))
        return F.when((F.get(cuts, F.lit(0)) < 0) | (F.size(cuts) < 3), cuts).otherwise(F.get(one, F.lit(0)))

    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.sequence(F.lit(0), n), step)
    return F.filter(folded, lambda c: c >= 0)


def best_path(n: Column, index: Column, unknown: float, longest: int) -> Column:
    """Borders of the segmentation of n characters with the highest summed score (Viterbi).

    A character without a piece costs unknown; of equal sums the one with the shorter last piece wins.
    """
    first = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("back")))

    def step(state: Column, end: Column) -> Column:
        ways = F.transform(F.sequence(F.lit(1), F.least(end, F.lit(longest))), lambda k: F.struct(
            (F.get(state, end - k)["total"] + F.coalesce(F.try_element_at(index, ((end - k) * 256 + k).cast("long"))["score"], F.when(k == 1, F.lit(unknown)))).alias("total"), (end - k).alias("back")))
        return F.concat(state, F.array(F.array_max(F.filter(ways, lambda w: w["total"].isNotNull()))))

    state = F.aggregate(F.sequence(F.lit(1), n), first, step)
    back = F.transform(F.array(state), lambda s: F.aggregate(F.sequence(F.lit(1), n), F.array(n), lambda path, _: F.when(
        F.get(path, F.lit(0)) == 0, path).otherwise(F.concat(F.array(F.get(s, F.get(path, F.lit(0)))["back"]), path))))
    return F.get(back, F.lit(0))


def _ids(unit: Column, cuts: Column, found: Callable[[Column], Column], m: Model) -> Column:
    """Ids of the segments between cuts; segments without a piece are single characters."""
    own = {p: i for p, i, _ in m.pieces if len(p) == 1}
    single = F.lit([own.get(chr(c)) for c in range(SINGLES)]).cast("array<int>")

    def segment(i: Column) -> Column:
        a, b = F.get(cuts, i - 1), F.get(cuts, i)
        id_ = found((a * 255 + b).cast("long"))
        if m.first_byte is None:
            spelt = F.array(F.lit(m.unknown))
        else:
            code = F.hex(F.encode(F.substr(unit, a + 1, F.lit(1)), "UTF-8"))
            spelt = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: (F.conv(F.substr(code, k, F.lit(2)), 16, 10).cast("int") + m.first_byte))
        if m.kind == BPE:
            id_ = F.coalesce(id_, F.when(b - a == 1, F.get(single, F.ascii(F.substr(unit, a + 1, F.lit(1))))))
        return F.when(id_.isNotNull(), F.array(id_)).otherwise(spelt)

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), segment))


def encode_units(units: DataFrame, path: str) -> DataFrame:
    """(unit, ids) of distinct units of LONG characters at most."""
    m, spark = model(path), units.sparkSession
    # more groups at a time than Spark would keep before it turns to sorting; each has a few dozen edges
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "50000")
    bpe = m.kind == BPE
    met = lattice(units, piece_table(spark, path), m.longest, packed_edge() if bpe else scored_edge(), singles=bpe)
    met = met.withColumn("n", F.length("unit")).withColumn("index", _packed_index(F.col("edges")) if bpe else F.map_from_entries("edges"))
    n, index = F.col("n"), F.col("index")
    cuts = merged(n, index) if bpe else best_path(n, index, min(s for _, _, s in m.pieces) - 10.0, m.longest)

    def found(at: Column) -> Column:
        edge = F.try_element_at(index, at)
        return edge.bitwiseAND(2**20 - 1).cast("int") if bpe else edge["id"]

    return met.withColumn("cuts", cuts).select("unit", _ids(F.col("unit"), F.col("cuts"), found, m).alias("ids"))


def _encode_long(units: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _processor(path)
        lead = len(p.encode("\n"))  # a border, so what follows is encoded without a prefix
        for batch in batches:
            units = batch.column(0).to_pylist()
            ids = [p.encode("\n" + u.replace(SPACE, " "))[lead:] for u in units]
            yield pa.RecordBatch.from_pydict({"unit": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return units.mapInArrow(run, "unit string, ids array<int>")


# ---- documents ----

def encode(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The kept columns, n_bytes (of text) and ids of docs(text)."""
    schema = StructType([*[docs.schema[c] for c in keep], StructField("n_bytes", LongType()), StructField("ids", ArrayType(IntegerType()))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                n, place, _ = unpacked(row["units"].as_py(), row["at"].as_py(), row["freq"].as_py(), True)
                size, flat = listed(row, place)
                at = np.cumsum(size) - size
                begins, ends = np.cumsum(n) - n, np.cumsum(n)
                for lo in range(0, len(n), 500):
                    hi = min(lo + 500, len(n))
                    here = place[begins[lo]:ends[hi - 1]]
                    k = size[here]
                    ids = flat[np.repeat(at[here] - (np.cumsum(k) - k), k) + np.arange(k.sum())] if len(here) else flat[:0]
                    total = np.concatenate([[0], np.cumsum(k)])[np.concatenate([[0], ends[lo:hi] - begins[lo]])]
                    made = {c: row[c].values.slice(lo, hi - lo) for c in keep}
                    made["n_bytes"] = row["n_bytes"].values.slice(lo, hi - lo)
                    made["ids"] = pa.ListArray.from_arrays(pa.array(total, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_pydict(made)

    cut = cutter(path)
    units, checks = distinct_units(docs, "text", cut)
    partitions = max(spread(docs, 16), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt, short = by_unit(units, partitions, lambda unit: F.length(unit) <= LONG)
    _, long = by_unit(units, partitions, lambda unit: F.length(unit) > LONG)
    per_unit = encode_units(short, path).unionByName(_encode_long(long, path))
    return meet_lists(packed_documents(docs, "text", cut, keep, True), dealt, checks, per_unit, "ids").mapInArrow(gather, schema)


@functools.lru_cache(maxsize=2)
def _spelling(path: str) -> tuple[list[bytes], bytes]:
    """The bytes of each id."""
    p, m = _processor(path), model(path)
    spelt = [b""] * p.get_piece_size()
    for piece, i, _ in m.pieces:
        spelt[i] = piece.replace(SPACE, " ").encode()
    if m.first_byte is not None:
        for b in range(256):
            spelt[m.first_byte + b] = bytes([b])
    spelt[m.unknown] = " ⁇ ".encode()
    return spelt, b" " if m.prefix else b""


def decode(encoded: DataFrame, path: str, keep: list[str], with_ids: bool = False) -> DataFrame:
    """The kept columns, n_ids, ids_crc32 (of the ids as little-endian 32-bit integers) and the decoded text."""
    own = [StructField("n_ids", LongType()), StructField("ids_crc32", LongType()), StructField("text", StringType())]
    schema = StructType([*[encoded.schema[c] for c in keep], *([encoded.schema["ids"]] if with_ids else []), *own])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt, lead = _spelling(path)
        for batch in batches:
            column = batch.column("ids")
            at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            texts, crc = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                text = b"".join([spelt[i] for i in flat[a:b].tolist()])
                texts.append(text.removeprefix(lead).decode(errors="replace"))
                crc.append(zlib.crc32(flat[a:b].astype("<u4").tobytes()))
            made = {c: batch.column(c) for c in [*keep, *(["ids"] if with_ids else [])]}
            made |= {"n_ids": pa.array(np.diff(at), pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_pydict(made)

    return encoded.select(*keep, "ids").mapInArrow(spell, schema)
