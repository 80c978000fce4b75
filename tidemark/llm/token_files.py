"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned by id, so each partition writes one run of the whole sequence:
``ids`` (little-endian unsigned integers, the smallest width that holds the vocabulary) and
``offsets`` (unsigned 64-bit, one more than documents, counted in ids from the partition's start),
beside ``docs`` (signed 64-bit document ids). A partition's base in the whole sequence is the prefix
sum of the sizes before it; there are as many sizes as partitions. Files are memory-mapped on reading.

Each attempt of a task writes under a name of its own and the manifest names the files of the attempt
that counts, so repeated tasks do no harm.

Defined cases: a null text is empty and gets the end id alone; a null document id sorts first and is
written with the mark NULL_ID; equal ids keep all their rows, in order of the text's hash; an empty
table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import open_shared, scratch_path, slices, spread, tokenizer
from tidemark.llm.words import BYTE_KIND, Spans, raw

MANIFEST = "part int, path string, documents long, tokens long, width int"
NULL_ID = -(2**63)
#: White space that is not ASCII, and the control characters that Unicode's rules for \\s and ours treat differently.
#: A text holding one is encoded whole.
ODD_SPACE = tuple(map(chr, (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


#: Units whose ids a Python worker remembers.
REMEMBERED = 300_000


class _Memory:
    """Ids of the units met lately: sorted hashes, and their ids end to end."""

    def __init__(self):
        self.hash, self.begin, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash stands, -1 where it doesn't."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, pieces: list[list[int]]) -> None:
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ids = np.fromiter((i for p in pieces for i in p), dtype=np.uint32, count=int(size.sum()))
        begin = np.cumsum(size) - size + len(self.ids)
        hashes = np.concatenate([self.hash, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hash, self.begin, self.size = hashes[order], np.concatenate([self.begin, begin])[order], np.concatenate([self.size, size])[order]
        self.ids = np.concatenate([self.ids, ids])


_memories: dict[str, _Memory] = {}


def _units(column: pa.Array) -> Spans:
    """Each text cut where the vocabulary's pattern surely cuts: in front of white space, and between
    ASCII letters, digits and others (not behind an apostrophe, nor in texts that hold ``<|``)."""
    data, offsets = raw(column)
    n = len(data)
    whole = pc.fill_null(pc.match_substring(column, "<|"), False).to_numpy(zero_copy_only=False)
    fine = ~np.repeat(whole, np.diff(offsets))
    kind = BYTE_KIND[data]
    a, b = kind[:-1], kind[1:]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    border[1:n] |= (b == 0) & (a != 0)
    border[1:n] |= (a != b) & (a != 0) & (a != 4) & (b != 4) & (data[:-1] != 0x27) & fine[1:]
    edges = np.flatnonzero(border)
    if not n:
        edges = edges[:0]
    start, end = edges[:-1], edges[1:]
    return Spans(data, start, end, np.searchsorted(offsets, start, side="right") - 1, len(column))


def encode_texts(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each whole text as (ids, offsets).

    Byte-level BPE works within the pieces that its pattern cuts a text into, so the text can be cut at
    borders of that pattern: distinct units are encoded once and their ids gathered. Texts with
    other kinds of white space than ASCII are encoded whole.
    """
    t = tokenizer(path)
    spans = _units(column)
    hashes, first, place = np.unique(spans.hashes(), return_index=True, return_inverse=True)
    memory = _memories.setdefault(path, _Memory())
    if len(memory.hash) > REMEMBERED:
        memory = _memories[path] = _Memory()
    new = np.flatnonzero(memory.place(hashes) < 0)
    pieces: list[list[int]] = []
    for lo in range(0, len(new), 4096):
        pieces += [x.ids for x in t.encode_batch_fast([b.decode() for b in spans.texts(first[new[lo:lo + 4096]])], add_special_tokens=False)]
    memory.add(hashes[new], pieces)
    at = memory.place(hashes)[place]
    n = memory.size[at]
    ids = memory.ids[np.repeat(memory.begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(spans.row, weights=n, minlength=spans.rows).astype(np.int64))])
    odd = np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, "[" + "".join(ODD_SPACE) + "]"), False).to_numpy(zero_copy_only=False)).tolist()
    if odd:
        parts = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        for i in odd:
            parts[i] = np.array(t.encode(column[i].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
        ids = np.concatenate(parts)
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return ids, offsets


def write_ids(docs: DataFrame, vocabulary: str, vocabulary_size: int, end_id: int = 0, folder: str | None = None,
              slice_bytes: int = 2 << 20) -> DataFrame:
    """Write the ids of docs(doc_id, text) and return the manifest, one row per part."""
    folder = folder or scratch_path(docs.sparkSession, "ids")
    width = next(w for w in (1, 2, 4, 8) if vocabulary_size <= 256**w)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, root = open_shared(folder)
        root = f"{root}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        documents = tokens = 0
        sinks = None
        for rows in slices(batches, "text", slice_bytes):
            if sinks is None:
                fs.create_dir(root, recursive=True)
                sinks = {k: fs.open_output_stream(f"{root}/{k}", compression=None) for k in ("ids", "offsets", "docs")}
                sinks["offsets"].write(np.zeros(1, dtype="<u8").tobytes())
            ids, offsets = encode_texts(rows["text"].combine_chunks(), vocabulary)
            ids = np.insert(ids, offsets[1:], end_id).astype(f"<u{width}")
            ends = offsets[1:] + np.arange(1, len(offsets))
            sinks["ids"].write(ids.tobytes())
            sinks["offsets"].write((ends + tokens).astype("<u8").tobytes())
            sinks["docs"].write(rows["doc_id"].combine_chunks().cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            documents += rows.num_rows
            tokens += len(ids)
        if sinks is not None:
            for s in sinks.values():
                s.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [root if "://" not in folder else f"{folder.split('://')[0]}://{root}"],
                                              "documents": pa.array([documents], pa.int64()), "tokens": pa.array([tokens], pa.int64()), "width": pa.array([width], pa.int32())})

    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange(max(spread(rows, 32), docs.sparkSession.sparkContext.defaultParallelism), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    path = scratch_path(docs.sparkSession, "manifest")
    ordered.mapInArrow(write, MANIFEST).write.parquet(path)  # writing is an action: the manifest is what it leaves
    return docs.sparkSession.read.schema(MANIFEST).parquet(path)


def read_ids(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the memory-mapped files."""
    # as many rows as parts
    bases = manifest.withColumn("base", F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    bases = bases.withColumn("base", F.coalesce("base", F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                fs, root = open_shared(part["path"])
                with _mapped(fs, f"{root}/ids") as ids_file, _mapped(fs, f"{root}/offsets") as off_file, _mapped(fs, f"{root}/docs") as docs_file:
                    ids = np.frombuffer(ids_file.read_buffer(), dtype=f"<u{part['width']}")
                    offsets = np.frombuffer(off_file.read_buffer(), dtype="<u8").astype(np.int64)
                    docs = np.frombuffer(docs_file.read_buffer(), dtype="<i8")
                    if len(ids) != part["tokens"] or len(docs) != part["documents"]:
                        raise OSError(f"{root}: the files don't hold what the manifest says")
                    for lo in range(0, len(docs), 4096):
                        at = offsets[lo:lo + 4097]
                        block = ids[at[0]:at[-1]].astype("<u4")
                        crc = [zlib.crc32(block[a:b]) for a, b in zip((at[:-1] - at[0]).tolist(), (at[1:] - at[0]).tolist(), strict=True)]
                        d = docs[lo:lo + 4096]
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(d, pa.int64(), mask=d == NULL_ID), "start": pa.array(at[:-1] + part["base"], pa.int64()),
                                                          "n_tokens": pa.array(np.diff(at), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    per_task = bases.repartition(max(1, spark.sparkContext.defaultParallelism), "part")
    return per_task.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _mapped(fs: pa.fs.FileSystem, path: str):
    """A memory map where the shared folder is mounted, a random-access file elsewhere."""
    return pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)
