"""Work per distinct piece of text instead of per occurrence.

Documents are taken in batches of bounded bytes and cut into units. A batch's distinct units are rows
(place, unit), so a frequent unit costs one row for each batch, never one for each document; what
is computed once per distinct unit comes back to the batches by a join on the unit, and meets the
documents' own units, kept as packed positions, by a join on the batch.

A place is the batch's number (partition and count in it) and the unit's position. Both branches make
the batches from the same scan, and each carries a checksum of the batch's units: should a lost executor
ever change how the scan is split, the checksums differ and the job fails rather than answering wrongly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm.common import pack, slices, stored, unpack
from tidemark.llm.words import Spans

Cutter = Callable[[pa.Array], Spans]
#: Text of one batch, and of the slices in which it is cut: the arrays over a slice take some thirty times as much.
BATCH_BYTES, SLICE_BYTES = 16 << 20, 2 << 20


@dataclass
class _Batch:
    number: int
    rows: list[pa.Table] = field(default_factory=list)
    hashes: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    texts: dict[int, bytes] = field(default_factory=dict)
    bytes: int = 0

    def add(self, rows: pa.Table, spans: Spans, keep: list[str], with_texts: bool) -> None:
        h = spans.hashes()
        self.hashes.append(h)
        self.counts.append(np.bincount(spans.row, minlength=spans.rows))
        self.bytes += len(spans.data)
        if with_texts:
            distinct, first = np.unique(h, return_index=True)
            new = ~np.isin(distinct, self.known, assume_unique=True)
            self.texts.update(zip(distinct[new].tolist(), spans.texts(first[new]), strict=True))
            self.known = np.concatenate([self.known, distinct[new]])
        else:
            size = pc.fill_null(pc.binary_length(rows[rows.column_names[-1]]), 0).cast(pa.int64())
            self.rows.append(rows.select(keep).append_column("n_bytes", size))

    def ranked(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct hashes, their rank): frequent units come first, so that positions pack well."""
        distinct, n = np.unique(np.concatenate([*self.hashes, np.zeros(0, np.uint64)]), return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return distinct, rank


def _check(distinct: np.ndarray, rank: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((distinct * (2 * rank.astype(np.uint64) + np.uint64(1))).sum(dtype=np.uint64).astype(np.int64))


def _batches(batches: Iterator[pa.RecordBatch], column: str, cut: Cutter, keep: list[str], with_texts: bool) -> Iterator[_Batch]:
    number = TaskContext.get().partitionId() << 11
    batch = _Batch(number)
    for rows in slices(batches, column, SLICE_BYTES):
        spans = cut(rows[column].combine_chunks())
        if batch.hashes and batch.bytes + len(spans.data) > BATCH_BYTES:
            yield batch
            batch = _Batch(batch.number + 1)
            if batch.number >> 11 != number >> 11:
                raise ValueError("too many batches in one partition: read smaller partitions")
        batch.add(rows, spans, keep, with_texts)
    if batch.hashes:
        yield batch


def distinct_units(docs: DataFrame, column: str, cut: Cutter) -> tuple[DataFrame, DataFrame]:
    """((place, unit) for the distinct units of each batch, (batch, check)), written once."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, column, cut, [], True):
            distinct, rank = batch.ranked()
            order = np.argsort(rank)
            units = [batch.texts[h].decode() for h in distinct[order].tolist()]
            yield pa.RecordBatch.from_pydict({"batch": pa.array([batch.number], pa.int64()), "check": pa.array([_check(distinct, rank)], pa.int64()), "units": pa.array([units], pa.list_(pa.string()))})

    made = stored(docs.select(column).mapInArrow(make, "batch long, check long, units array<string>"), "units")
    rows = made.select("batch", F.posexplode("units").alias("at", "unit"))
    rows = rows.where("unit is not null")  # none is; said here, so that Spark adds it to neither use of the rows and can share their exchange
    return rows.select((F.shiftleft("batch", 31) + F.col("at")).alias("place"), "unit"), made.select("batch", "check")


def packed_documents(docs: DataFrame, column: str, cut: Cutter, keep: list[str], sequence: bool) -> DataFrame:
    """A row per batch: the kept columns as arrays, each document's units packed.

    sequence: every occurrence in order; otherwise distinct positions and, in ``freq``, how often.
    """
    fields = [StructField(c, ArrayType(docs.schema[c].dataType)) for c in keep]
    schema = StructType([StructField("batch", LongType()), StructField("own_check", LongType()), *fields, StructField("n_bytes", ArrayType(LongType())),
                         *[StructField(c, BinaryType()) for c in ("units", "at", "freq")]])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, column, cut, keep, False):
            distinct, rank = batch.ranked()
            units, place, freq = [], [], [np.zeros(0, np.int64)]
            for h, n in zip(batch.hashes, batch.counts, strict=True):
                at = rank[np.searchsorted(distinct, h)]
                if not sequence:
                    width = max(len(distinct), 1)
                    both, f = np.unique(np.repeat(np.arange(len(n)), n) * width + at, return_counts=True)
                    row, at = both // width, both % width
                    n = np.bincount(row, minlength=len(n))
                    same = np.concatenate([[False], row[1:] == row[:-1]])[:len(row)]
                    at = np.where(same, np.diff(at, prepend=0), at)  # small steps pack well
                    freq.append(f)
                units.append(n)
                place.append(at.astype(np.uint32))
            rows = pa.concat_tables(batch.rows)
            made = {"batch": pa.array([batch.number], pa.int64()), "own_check": pa.array([_check(distinct, rank)], pa.int64())}
            for c in [*keep, "n_bytes"]:
                values = rows[c].combine_chunks()
                made[c] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            for c, x in (("units", units), ("at", place), ("freq", freq)):
                made[c] = pa.array([pack(np.concatenate(x).astype(np.uint32))], pa.binary())
            yield pa.RecordBatch.from_pydict(made)

    return docs.select(*[c for c in keep if c != column], column).mapInArrow(make, schema)


def unpacked(units: bytes, at: bytes, freq: bytes, sequence: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units of each document, positions, frequencies) as packed_documents made them."""
    n, at, f = unpack(units, np.uint32).astype(np.int64), unpack(at, np.uint32), unpack(freq, np.uint32)
    if not sequence and len(at):
        total = np.cumsum(at, dtype=np.int64)
        begin = (np.cumsum(n) - n)[n > 0]
        at = total - np.repeat(total[begin] - at[begin], n[n > 0])
    return n, at, f


def by_unit(units: DataFrame, partitions: int, only: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(units dealt by unit, the distinct ones of them that only lets through): one exchange serves both."""
    dealt = units.repartition(partitions, "unit")
    # a condition on the aggregate stays behind the exchange, which else would be made once more with the condition in it
    condition = F.when(F.col("place").isNotNull(), only(F.col("unit"))) if only else F.col("place").isNotNull()
    return dealt, dealt.groupBy("unit").agg(F.max("place").alias("place")).where(condition).select("unit")


def meet(documents: DataFrame, dealt: DataFrame, checks: DataFrame, per_unit: DataFrame, value: str) -> DataFrame:
    """documents with ``check`` and ``values``: the value of each unit of the batch in order; a batch's units are bounded."""
    met = dealt.join(per_unit, "unit").select(F.shiftright("place", 31).alias("batch"), F.col("place").bitwiseAND(2**31 - 1).cast("int").alias("at"), value)
    values = met.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("at", value))).alias("pairs"))
    values = values.select(F.col("batch").alias("_batch"), F.transform("pairs", lambda p: p[value]).alias("values"))
    known = checks.join(values, F.col("batch").eqNullSafe(F.col("_batch")), "left").drop("_batch")
    return documents.join(known, "batch", "left")


PARTS = StructType([StructField("_batch", LongType()), *[StructField(c, BinaryType()) for c in ("at", "size", "flat")]])


def meet_lists(documents: DataFrame, dealt: DataFrame, checks: DataFrame, per_unit: DataFrame, value: str) -> DataFrame:
    """meet() for values that are lists of integers: documents with ``check`` and ``parts``, which listed() puts together.

    A task packs the lists of each batch before they are shuffled; it holds those of its own units.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not sum(r.num_rows for r in rows):
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        batch, at = table["batch"].to_numpy(), table["at"].to_numpy()
        order = np.lexsort((at, batch))
        begin = np.flatnonzero(np.concatenate([[True], np.diff(batch[order]) != 0]))
        lists = table[value].combine_chunks() if isinstance(table[value], pa.ChunkedArray) else table[value]
        for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
            some = order[lo:hi]
            own = lists.take(pa.array(some))
            size, flat = pc.list_value_length(own).to_numpy(), own.flatten().to_numpy()
            yield pa.RecordBatch.from_pydict({"_batch": pa.array([int(batch[some[0]])], pa.int64()), "at": pa.array([pack(np.diff(at[some], prepend=0).astype(np.uint32))], pa.binary()),
                                               "size": pa.array([pack(size.astype(np.uint32))], pa.binary()), "flat": pa.array([pack(flat.astype(np.uint32))], pa.binary())})

    met = dealt.join(per_unit, "unit").select(F.shiftright("place", 31).alias("batch"), F.col("place").bitwiseAND(2**31 - 1).cast("int").alias("at"), value)
    parts = met.mapInArrow(make, PARTS).groupBy("_batch").agg(F.collect_list(F.struct("at", "size", "flat")).alias("parts"))
    return documents.join(checks.join(parts, F.col("batch").eqNullSafe(F.col("_batch")), "left").drop("_batch"), "batch", "left")


def listed(row: dict[str, pa.Scalar], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes of the lists of a batch's units in order, their integers); fails unless both branches saw the same batch."""
    at, size, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for part in row["parts"].as_py() or []:
        at.append(np.cumsum(unpack(part["at"], np.uint32), dtype=np.int64))
        size.append(unpack(part["size"], np.uint32).astype(np.int64))
        flat.append(unpack(part["flat"], np.uint32).astype(np.int32))
    at, size, flat = (np.concatenate(x) for x in (at, size, flat))
    _same(row, places, len(at))
    order = np.argsort(at)
    k = size[order]
    return k, flat[np.repeat((np.cumsum(size) - size)[order] - (np.cumsum(k) - k), k) + np.arange(k.sum())]


def require(row: dict[str, pa.Scalar], at: np.ndarray) -> None:
    """Fails unless both branches saw the same batch."""
    _same(row, at, len(row["values"].values) if row["values"].is_valid else 0)


def _same(row: dict[str, pa.Scalar], at: np.ndarray, have: int) -> None:
    if row["check"].as_py() != row["own_check"].as_py() or len(at) and int(at.max()) >= have:
        raise RuntimeError(f"batch {row['batch']}: its scan was split differently the second time; run the job again")
