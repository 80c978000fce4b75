"""Which tokens of two tokenizers stand for the same bytes, counted over the corpus by external spill counting.

Both tokenizers encode every text (a space in front). Byte offsets where tokens of both end cut a text into groups; every token of A
in a group is linked with every token of B in it. A pair of ids counts the documents that hold it linked.

Counting. A task gathers (pair, document, links) records in a bounded buffer. A full buffer is summed, sorted by (radix of
A's id, A's id, B's id, document) and spilled as one run: for each radix a section of zstd frames holding the distinct pairs with
their numbers of records, and beside it the documents and links of those records. So a pair takes one entry in a run, however many
documents hold it. The sections of a radix meet in one k-way merge: a heap of the runs by the last pair of the frame each holds
says how far the order is settled; what lies below is summed. As A's id is the major side, an id's highest count is
known as soon as its pairs have passed, and at most one id's pairs (as many as B has ids) are held back. The counts stream back to
each run in its own order, with a mark for the highest, and a last pass adds them up for the run's documents. Where
a radix has more than FAN sections, they are merged FAN at a time in rounds, and the counts come back through the same rounds.

Spark deals out texts, sections and runs; records never pass a shuffle. Files lie in the shared folder under names of their own
for each attempt; the written manifests say which count, so lost executors do no harm.

Defined cases: null and empty texts, and those whose joined token bytes differ from space and text, have no tokens: zeros and an empty
digest; rows with equal or null ids are documents of their own; empty tables give no rows; columns that aren't
kept are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import open_shared, pack, row_slices, scratch_path, spread, stored, unpack
from tidemark.llm.token_files import ODD_SPACE
from tidemark.llm.words import Spans, raw

#: Records and documents of a run, pairs of a frame, sections of a merge.
RUN_RECORDS, RUN_DOCUMENTS, FRAME, FAN = 3_000_000, 1 << 18, 1 << 15, 256
#: Linked pairs made at a time, and the units (and bytes of theirs) a worker remembers.
EXPANDED, REMEMBERED, REMEMBERED_BYTES = 1 << 21, 300_000, 64 << 20
SPACE = "▁"



def _fields(longs: str = "", strings: str = "") -> StructType:
    return StructType([*[StructField(c, LongType()) for c in longs.split()], *[StructField(c, StringType()) for c in strings.split()]])


MERGED = _fields("run radix at size", "path")
SECTION = _fields("run radix at size records_at records_size", "path")
ANSWER = _fields("run radix part at size", "path")
REPORT = _fields("n_a n_b n_groups n_links n_best count_sum", "groups_sha256")


# ---- the two tokenizers ----

@dataclass(frozen=True)
class _Side:
    """A vocabulary's tokens as bytes end to end, and how many bits an id takes."""

    data: np.ndarray
    size: np.ndarray
    begin: np.ndarray
    bits: int

    @staticmethod
    def of(tokens: list[bytes]) -> _Side:
        size = np.array([len(x) for x in tokens], dtype=np.int64)
        return _Side(np.frombuffer(b"".join(tokens), dtype=np.uint8), size, np.cumsum(size) - size, max(1, (len(tokens) - 1).bit_length()))

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[_ragged(self.begin[ids], self.size[ids])]


def _ragged(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers begin[i] .. begin[i] + n[i] - 1 of every i, end to end."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _byte_level(token: str) -> bytes:
    """A token of a byte-level vocabulary as bytes: printable characters of Latin-1 stand for themselves, the other
    bytes, in order, for the characters from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    back = {b: b for b in own} | {0x100 + i: b for i, b in enumerate(b for b in range(256) if b not in own)}
    return bytes(back[ord(c)] for c in token)


class Tokenizers:
    """A (a byte-level file of tokenizers) and B (a SentencePiece model), and whether texts may be cut in front of spaces."""

    def __init__(self, a: str, b: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        import tokenizers
        from sentencepiece import sentencepiece_model_pb2

        self.first = tokenizers.Tokenizer.from_file(a)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=b)
        special = {t.content.encode() for t in self.first.get_added_tokens_decoder().values()}
        tokens = [self.first.id_to_token(i) or "" for i in range(self.first.get_vocab_size())]
        self.a = _Side.of([t.encode() if t.encode() in special else _byte_level(t) for t in tokens])
        sp = self.second
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.b = _Side.of([bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)])
        if max(self.a.bits, self.b.bits) > 21:
            raise ValueError("a record has 63 bits: 20 for the document, and 21 for each id")
        said = json.loads(self.first.to_str())
        cut = said["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and said["normalizer"] is None
        # a space inside a piece, an absent prefix or an absent space would let B reach across a cut, and so would another pattern let A
        rules = sentencepiece_model_pb2.ModelProto.FromString(sp.serialized_model_proto()).normalizer_spec
        plain &= rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
        self.space = sp.piece_to_id(SPACE)
        self.cuts = plain and pieces[self.space] == SPACE and not any(c == SPACE and p[i - 1] != SPACE for p in pieces for i, c in enumerate(p) if i)

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each unit, which begins with a space that B's own prefix stands for."""
        first = [x.ids for x in self.first.encode_batch_fast(units, add_special_tokens=False)]
        second = self.second.encode([u[1:] for u in units], num_threads=1)
        return first, [[self.space] if u == " " and self.cuts else ids for u, ids in zip(units, second, strict=True)]


@functools.lru_cache(maxsize=2)
def tokenizers_of(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


_ODD = "[" + "".join(ODD_SPACE) + "]"


def units_of(column: pa.Array, both: Tokenizers) -> Spans:
    """Each text behind a space, cut in front of every space that follows a character other than white space.

    Neither the pattern of a byte-level vocabulary nor a piece reaches across such a place. In texts with kinds of white
    space that aren't ASCII the character has to be ASCII.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    data, offsets = raw(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    if both.cuts and len(data):
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
        solid = (data > 0x20) & (data != 0x7F)
        if odd.any():
            solid &= (data < 0x7F) | ~np.repeat(odd, np.diff(offsets))
        border[1:len(data)] |= (data[1:] == 0x20) & solid[:-1]
    edges = np.flatnonzero(border)
    start, end = edges[:-1], edges[1:]
    return Spans(data, start, end, np.searchsorted(offsets, start, side="right") - 1, len(column))


# ---- alignment ----

def linked(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray, groups: int, b_bits: int, most: int = EXPANDED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, pair, links) for the distinct pairs of each group, at most about ``most`` at a time; links is how often the pair stands in it."""
    def distinct(group: np.ndarray, ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, n = np.unique(group << bits | ids, return_counts=True)
        return keys >> bits, keys & ((1 << bits) - 1), n

    ga, a, na = distinct(group_a, ids_a, 21)
    gb, b, nb = distinct(group_b, ids_b, 21)
    begin = np.searchsorted(gb, np.arange(groups + 1))
    lo, width = begin[ga], begin[ga + 1] - begin[ga]
    ends = np.cumsum(width)
    at = 0
    while at < len(ga):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        w = width[at:to]
        right = _ragged(lo[at:to], w)
        yield np.repeat(ga[at:to], w), np.repeat(a[at:to] << b_bits, w) | b[right], np.repeat(na[at:to], w) * nb[right]
        at = to


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


@dataclass
class _Units:
    """What is known of the units met lately, in order of arrival; index finds them by hash."""

    hash: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    stats: np.ndarray = field(default_factory=lambda: np.zeros((0, 5), np.int64))  # n_a, n_b, n_groups, n_links, fine
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    links: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    groups: list[bytes] = field(default_factory=list)
    bytes: int = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, self.place[at], -1)

    def add(self, hashes: np.ndarray, units: list[str], both: Tokenizers) -> None:
        """Encode new units and align their tokens."""
        first, second = both.encode(units)
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (first, second))
        a, b = (np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(n.sum())) for ids, n in ((first, n_a), (second, n_b)))
        joined = np.frombuffer("".join(units).encode(), dtype=np.uint8)
        size = np.array([len(u.encode()) for u in units], dtype=np.int64)
        fine = np.ones(len(units), dtype=bool)
        for side, ids, n in ((both.a, a, n_a), (both.b, b, n_b)):
            have = np.bincount(np.repeat(np.arange(len(n)), n), weights=side.size[ids], minlength=len(n)).astype(np.int64)
            same = have == size
            text = joined[_ragged((np.cumsum(size) - size)[same], size[same])]
            differs = side.bytes_of(ids[np.repeat(same, n)]) != text
            wrong = np.bincount(np.repeat(np.flatnonzero(same), size[same])[differs], minlength=len(n)) > 0
            fine &= same & ~wrong
        a, b, size = a[np.repeat(fine, n_a)], b[np.repeat(fine, n_b)], np.where(fine, size, 0)
        n_a, n_b = np.where(fine, n_a, 0), np.where(fine, n_b, 0)
        ends = [np.cumsum(side.size[ids]) for side, ids in ((both.a, a), (both.b, b))]
        marks = [np.zeros(int(size.sum()) + 1, dtype=bool) for _ in ends]
        for m, e in zip(marks, ends, strict=True):
            m[e] = True
        shared = np.concatenate([[0], np.cumsum(marks[0][1:] & marks[1][1:])])
        group_a, group_b = (shared[e - 1] for e in ends)
        groups = int(shared[-1])
        upto = shared[np.cumsum(size)]
        n_groups = np.diff(upto, prepend=0)
        per_a, per_b = (np.bincount(g, minlength=groups) for g in (group_a, group_b))
        unit_of = np.repeat(np.arange(len(units)), n_groups)
        n_links = np.zeros(len(units), dtype=np.int64)
        np.add.at(n_links, unit_of, per_a * per_b)
        # the distinct pairs of each unit
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        found += [(unit_of[g], pair, n) for g, pair, n in linked(group_a, a, group_b, b, groups, both.b.bits)]
        unit, pair, n = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((pair, unit))
        unit, pair, n = unit[order], pair[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (pair[1:] != pair[:-1])])) if len(unit) else np.zeros(0, np.int64)
        # texts of the groups
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        until = [np.concatenate([[0], np.cumsum(p)]).tolist() for p in (per_a, per_b)]
        texts = [f"{','.join(text_a[p:q])}|{','.join(text_b[r:s])}" for p, q, r, s in zip(until[0], until[0][1:], until[1], until[1][1:], strict=False)]
        lows = (upto - n_groups).tolist()
        self.groups += [";".join(texts[p:q]).encode() for p, q in zip(lows, upto.tolist(), strict=True)]
        self.bytes += sum(map(len, self.groups[-len(units):]))
        self.stats = np.concatenate([self.stats, np.stack([n_a, n_b, n_groups, n_links, fine.astype(np.int64)], axis=1)])
        self.pairs = np.concatenate([self.pairs, pair[new]])
        self.links = np.concatenate([self.links, np.add.reduceat(n, new) if len(new) else n])
        self.n_pairs = np.concatenate([self.n_pairs, np.bincount(unit[new], minlength=len(units))])
        self.hash = np.concatenate([self.hash, hashes])
        self.place = np.concatenate([self.place, np.arange(len(self.place), len(self.place) + len(units))])
        order = np.argsort(self.hash)
        self.hash, self.place = self.hash[order], self.place[order]


_known: dict[tuple[str, str], _Units] = {}


@dataclass
class Aligned:
    """The documents of a slice: stats (n_a, n_b, n_groups, n_links) and digest of each, and records (document, pair, links)."""

    stats: np.ndarray
    digest: list[str]
    document: np.ndarray
    pair: np.ndarray
    links: np.ndarray


def align(column: pa.Array, a: str, b: str) -> Aligned:
    """Whole texts through both tokenizers; equal units are encoded once."""
    both = tokenizers_of(a, b)
    spans = units_of(column, both)
    hashes, first, place = np.unique(spans.hashes(), return_index=True, return_inverse=True)
    known = _known.setdefault((a, b), _Units())
    if len(known.hash) > REMEMBERED or known.bytes > REMEMBERED_BYTES or len(known.pairs) > 4 * REMEMBERED:
        known = _known[a, b] = _Units()
    new = np.flatnonzero(known.find(hashes) < 0)
    lo = 0
    size = np.cumsum((spans.end - spans.start)[first[new]])
    while lo < len(new):  # a bounded number of bytes at a time, one unit at least
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + (1 << 20), side="right")))
        known.add(hashes[new[lo:hi]], [x.decode() for x in spans.texts(first[new[lo:hi]])], both)
        lo = hi
    at = known.find(hashes)
    rows, of_unit = spans.rows, at[place]
    until = spans.per_row()
    stats = np.add.reduceat(known.stats[of_unit], until[:-1]) if rows else np.zeros((0, 5), np.int64)  # every text has a unit, its space
    empty = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) == 0
    fine = (stats[:, 4] == np.diff(until)) & ~empty
    listed, ends, texts = of_unit.tolist(), until.tolist(), known.groups
    digest = [hashlib.sha256(b";".join([texts[i] for i in listed[p:q]])).hexdigest() if ok else "" for p, q, ok in zip(ends, ends[1:], fine.tolist(), strict=False)]
    keep = fine[spans.row]
    both_, n = np.unique(spans.row[keep] * len(hashes) + place[keep], return_counts=True)
    document, unit = both_ // max(len(hashes), 1), at[both_ % max(len(hashes), 1)]
    begin = np.cumsum(known.n_pairs) - known.n_pairs
    width = known.n_pairs[unit]
    records = _ragged(begin[unit], width)
    return Aligned(np.where(fine[:, None], stats[:, :4], 0), digest, np.repeat(document, width), known.pairs[records], known.links[records] * np.repeat(n, width))


# ---- runs ----

@dataclass(frozen=True)
class _Keys:
    """How pairs are ordered: the low bits of A's id (its radix) first, then the rest of it, then B's id."""

    a_bits: int
    b_bits: int
    radix_bits: int

    def of(self, pair: np.ndarray) -> np.ndarray:
        a = pair >> self.b_bits
        turned = (a & ((1 << self.radix_bits) - 1)) << (self.a_bits - self.radix_bits) | a >> self.radix_bits
        return turned << self.b_bits | pair & ((1 << self.b_bits) - 1)

    def radix(self, key: np.ndarray) -> np.ndarray:
        return key >> (self.b_bits + self.a_bits - self.radix_bits)


def _frame(*arrays: np.ndarray) -> bytes:
    """Arrays of one length without negative numbers, each packed in the narrowest width, behind their sizes and widths."""
    widths = [next(w for w in (1, 2, 4, 8) if int(x.max(initial=0)) >> 8 * w == 0) for x in arrays]
    parts = [pack(x.astype(f"<u{w}")) for x, w in zip(arrays, widths, strict=True)]
    return struct.pack(f"<{2 * len(parts)}I", *[y for p, w in zip(parts, widths, strict=True) for y in (len(p), w)]) + b"".join(parts)


def _frames(path: str, at: int, size: int, parts: int) -> Iterator[list[np.ndarray]]:
    """The frames of one section of a file, read one after another."""
    fs, own = open_shared(path)
    with fs.open_input_file(own) as file:
        file.seek(at)
        while file.tell() < at + size:
            head = struct.unpack(f"<{2 * parts}I", file.read(8 * parts))
            yield [unpack(file.read(n), f"<u{w}").astype(np.int64) for n, w in zip(head[::2], head[1::2], strict=True)]


def _counted(path: str, at: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs in order, their counts) of each frame."""
    for steps, counts in _frames(path, at, size, 2):
        yield np.cumsum(steps), counts


class _Run:
    """The records and documents of one run until it is written."""

    def __init__(self):
        self.keys, self.links, self.rows, self.documents, self.records = [], [], [], 0, 0

    def add(self, rows: pa.Table, found: Aligned, order: _Keys) -> None:
        self.keys.append(order.of(found.pair) << 20 | found.document + self.documents)
        self.links.append(found.links)
        self.rows.append(rows)
        self.documents += rows.num_rows
        self.records += len(found.pair)

    def write(self, folder: str, number: int, order: _Keys) -> Iterator[dict]:
        """Write the run; its sections, and one row with radix -1 for its documents."""
        keys, links = summed(np.concatenate(self.keys), np.concatenate(self.links))
        fs, root = open_shared(folder)
        name = f"run-{number}-{uuid.uuid4().hex[:12]}"
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}.rows", compression=None) as sink:
            table = pa.concat_tables(self.rows)
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table, max_chunksize=1 << 16)
        yield {"run": number, "radix": -1, "path": f"{folder}/{name}", "at": 0, "size": 0, "records_at": 0, "records_size": 0}
        pair, document = keys >> 20, keys & ((1 << 20) - 1)
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(pair))
        radix = order.radix(pair[first])
        with fs.open_output_stream(f"{root}/{name}.pairs", compression=None) as pairs, fs.open_output_stream(f"{root}/{name}.records", compression=None) as records:
            for r in np.unique(radix).tolist():
                lo, hi = (int(x) for x in np.searchsorted(radix, [r, r + 1]))
                at, records_at = pairs.tell(), records.tell()
                for p in range(lo, hi, FRAME):
                    q = min(p + FRAME, hi)
                    pairs.write(_frame(np.diff(pair[first[p:q]], prepend=0), ends[p:q] - first[p:q]))
                    x, y = int(first[p]), int(ends[q - 1])
                    records.write(_frame(document[x:y], links[x:y]))
                yield {"run": number, "radix": r, "path": f"{folder}/{name}", "at": at, "size": pairs.tell() - at, "records_at": records_at, "records_size": records.tell() - records_at}


def spill(docs: DataFrame, text: str, keep: list[str], a: str, b: str, radix_bits: int, folder: str, run_records: int) -> DataFrame:
    """The manifest of the runs of all documents, written."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    names = rows.columns[:-1]
    both = tokenizers_of(a, b)
    order = _Keys(both.a.bits, both.b.bits, radix_bits)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number, run = TaskContext.get().partitionId() << 32, _Run()
        for part in row_slices(batches, "_text", 2 << 20):
            found = align(part["_text"].combine_chunks(), a, b)
            kept = part.select(names)
            for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links")):
                kept = kept.append_column(c, pa.array(found.stats[:, i], pa.int64()))
            run.add(kept.append_column("groups_sha256", pa.array(found.digest, pa.string())), found, order)
            if run.records >= run_records or run.documents > RUN_DOCUMENTS:
                yield from run.write(folder, number, order)
                number, run = number + 1, _Run()
        if run.rows:
            yield from run.write(folder, number, order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _listed(made(batches), SECTION)

    return stored(rows.mapInArrow(write, SECTION), "runs")


def _listed(made: Iterator[dict], schema: StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held = to_arrow_schema(schema), []
    for x in made:
        held.append(x)
        if len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


# ---- merging ----

def merged(sections: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """(pairs in order, sums of their counts, each section's own pairs among them), a stretch of the order at a time.

    The heap holds the sections by the last pair of the frame each has open. Up to the least of these every section shows all it has.
    """
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def open_next(i: int) -> None:
        frame = next(sections[i], None)
        if frame is not None:
            held[i] = frame
            heapq.heappush(heap, (int(frame[0][-1]), i))

    for i in range(len(sections)):
        open_next(i)
    while heap:
        last = heap[0][0]
        keys, counts, own = [], [], []
        for i, (k, n) in held.items():
            if len(k) and k[0] <= last:
                to = int(np.searchsorted(k, last, side="right"))
                keys.append(k[:to])
                counts.append(n[:to])
                own.append((i, k[:to]))
                held[i] = (k[to:], n[to:])
        pairs, sums = summed(np.concatenate(keys), np.concatenate(counts))
        yield pairs, sums, own
        while heap and heap[0][0] == last:
            i = heapq.heappop(heap)[1]
            held.pop(i)
            open_next(i)


def settled(stretches: Iterator[tuple[np.ndarray, np.ndarray, list]], b_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """merged() with final answers: twice the count, plus one for the highest of its id of A. An id's pairs wait until all have come."""
    keys, counts, own = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for k, n, o in itertools.chain(stretches, [(None, None, [])]):
        if k is not None:
            keys, counts, own = np.concatenate([keys, k]), np.concatenate([counts, n]), own + o
        if not len(keys):
            continue
        to = len(keys) if k is None else int(np.searchsorted(keys, keys[-1] >> b_bits << b_bits))
        if not to:
            continue
        side = keys[:to] >> b_bits
        first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        highest = np.repeat(np.maximum.reduceat(counts[:to], first), np.diff(np.append(first, to)))
        limit = keys[to - 1]
        ready, rest = [], []
        for i, x in own:
            p = int(np.searchsorted(x, limit, side="right"))
            ready += [(i, x[:p])] if p else []
            rest += [(i, x[p:])] if p < len(x) else []
        yield keys[:to], counts[:to] * 2 + (counts[:to] == highest), ready
        keys, counts, own = keys[to:], counts[to:], rest


class _Answers:
    """What goes back to the sections of one merge, in one file."""

    def __init__(self, folder: str, sections: list[dict]):
        self.sections, self.parts = sections, [0] * len(sections)
        self.held: list[list[np.ndarray]] = [[] for _ in sections]
        self.n = [0] * len(sections)
        self.path = f"{folder}/answers-{uuid.uuid4().hex}"
        fs, own = open_shared(self.path)
        fs.create_dir(own.rpartition("/")[0], recursive=True)
        self.sink = fs.open_output_stream(own, compression=None)

    def add(self, i: int, values: np.ndarray) -> Iterator[dict]:
        self.held[i].append(values)
        self.n[i] += len(values)
        if self.n[i] >= FRAME:
            yield self.flush(i)

    def flush(self, i: int) -> dict:
        data = pack(np.concatenate(self.held[i]).astype(np.uint64))
        row = {"run": self.sections[i]["run"], "radix": self.sections[i]["radix"], "part": self.parts[i], "path": self.path, "at": self.sink.tell(), "size": len(data)}
        self.sink.write(data)
        self.held[i], self.n[i], self.parts[i] = [], 0, self.parts[i] + 1
        return row

    def close(self) -> Iterator[dict]:
        for i, n in enumerate(self.n):
            if n:
                yield self.flush(i)
        self.sink.close()


def _answered(answers: list[dict]) -> Iterator[np.ndarray]:
    """The answers of one section, in order; files stay open while their parts follow each other."""
    fs = file = path = None
    for x in sorted(answers, key=lambda x: x["part"]):
        if x["path"] != path:
            if file is not None:
                file.close()
            fs, own = open_shared(x["path"])
            file, path = fs.open_input_file(own), x["path"]
        file.seek(x["at"])
        yield unpack(file.read(x["size"]), np.uint64).astype(np.int64)
    if file is not None:
        file.close()


class Counting:
    """The counts of all pairs of the runs, brought back to each run: ``answers`` is the manifest of what came back."""

    def __init__(self, runs: DataFrame, folder: str, b_bits: int, fan: int = FAN):
        self.spark, self.folder, self.b_bits, self.fan = runs.sparkSession, folder, b_bits, fan
        sections = runs.where("radix >= 0").select("run", "radix", F.concat("path", F.lit(".pairs")).alias("path"), "at", "size")
        most = runs.agg(F.max(F.shiftright("run", 32)).alias("p"), F.max(F.col("run").bitwiseAND((1 << 32) - 1)).alias("i"), F.countDistinct("radix").alias("radixes")).first()
        # runs numbered without gaps in the bits
        width = (most.i or 0) + 1
        self.runs = ((most.p or 0) + 1) * width
        self.number = F.shiftright("run", 32) * width + F.col("run").bitwiseAND((1 << 32) - 1)
        self.radixes = most.radixes or 1
        levels = [sections.withColumn("run", self.number)]
        while self.runs > fan ** len(levels):
            levels.append(stored(self._merged_once(levels[-1], len(levels)), "merged"))
        answers = stored(self._back(levels[-1], None, len(levels)), "answers")
        for level in range(len(levels) - 1, 0, -1):
            answers = stored(self._back(levels[level - 1], answers, level), "answers")
        self.answers = answers

    def _group(self, df: DataFrame, level: int) -> DataFrame:
        """Sections (or answers) dealt by what they are merged with: a number of tasks that Spark doesn't join again for being small."""
        tasks = self.radixes * -(-self.runs // self.fan**level)
        return df.withColumn("_group", F.expr(f"run div {self.fan**level}")).repartition(max(1, min(tasks, 100_000)), "radix", "_group")

    def _merged_once(self, sections: DataFrame, level: int) -> DataFrame:
        """The sections of each group as one section; its run is the group's number times the fan."""
        folder, fan = self.folder, self.fan**level
        def join(table: pa.Table) -> pa.Table:
            rows = table.to_pylist()
            path = f"{folder}/merged-{uuid.uuid4().hex}"
            fs, own = open_shared(path)
            with fs.open_output_stream(own, compression=None) as sink:
                for keys, counts, _ in merged([_counted(r["path"], r["at"], r["size"]) for r in rows]):
                    for p in range(0, len(keys), FRAME):
                        sink.write(_frame(np.diff(keys[p:p + FRAME], prepend=0), counts[p:p + FRAME]))
                size = sink.tell()
            return _table([{"run": rows[0]["run"] // fan * fan, "radix": rows[0]["radix"], "path": path, "at": 0, "size": size}], MERGED)

        return self._group(sections, level).groupBy("radix", "_group").applyInArrow(join, MERGED)

    def _back(self, sections: DataFrame, answers: DataFrame | None, level: int) -> DataFrame:
        """Answers to the sections of a level: from the counts themselves at the top, else from those of the merged sections."""
        folder, b_bits = self.folder, self.b_bits

        def bring(rows: list[dict], given: list[dict] | None) -> list[dict]:
            stretches = merged([_counted(r["path"], r["at"], r["size"]) for r in rows])
            stretches = settled(stretches, b_bits) if given is None else _followed(stretches, _answered(given))
            out, back = [], _Answers(folder, rows)
            for keys, values, own in stretches:
                for i, x in own:
                    out += back.add(i, values[np.searchsorted(keys, x)])
            return [*out, *back.close()]

        kept = ["run", "radix", "path", "at", "size", "_group"]
        if answers is None:
            return self._group(sections, level).select(*kept).groupBy("radix", "_group").applyInArrow(lambda t: _table(bring(t.to_pylist(), None), ANSWER), ANSWER)
        both = [self._group(df, level).groupBy("radix", "_group") for df in (sections, answers)]
        return both[0].cogroup(both[1]).applyInArrow(lambda s, g: _table(bring(s.to_pylist(), g.to_pylist()), ANSWER), ANSWER)


def _table(rows: list[dict], schema: StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))


def _followed(stretches, answers: Iterator[np.ndarray]):
    """Stretches with the answers that come in the same order."""
    rest = np.zeros(0, np.int64)
    for keys, _, own in stretches:
        while len(rest) < len(keys):
            rest = np.concatenate([rest, next(answers)])
        yield keys, rest[:len(keys)], own
        rest = rest[len(keys):]


# ---- the documents ----

def align_corpus(docs: DataFrame, text: str, keep: list[str], a: str, b: str, run_records: int = RUN_RECORDS, fan: int = FAN) -> DataFrame:
    """(kept columns, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document, written once.

    n_best counts the links whose pair's count is its A id's highest, ties included; count_sum adds the counts over the links.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "crosswalk")
    both = tokenizers_of(a, b)
    radix_bits = min(max(4, (spread(docs, 16) - 1).bit_length()), 10, both.a.bits)
    runs = spill(docs, text, keep, a, b, radix_bits, folder, run_records)
    counting = Counting(runs, folder, both.b.bits, fan)
    fields = StructType([docs.schema[c] for c in keep])
    schema = StructType([*fields.fields, *REPORT.fields])
    own = runs.withColumn("run", counting.number)
    tasks = max(1, min(counting.runs, 100_000))

    def report(sections: pa.Table, answers: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        rows = sections.to_pylist()
        path = rows[0]["path"]
        fs, at = open_shared(path)
        with fs.open_input_stream(f"{at}.rows", compression=None) as source:
            table = pa.ipc.open_stream(source).read_all()
        best, total = (np.zeros(table.num_rows, dtype=np.int64) for _ in range(2))
        given: dict[int, list[dict]] = {}
        for x in answers.to_pylist():
            given.setdefault(x["radix"], []).append(x)
        for s in rows:
            if s["radix"] < 0:
                continue
            values = _answered(given[s["radix"]])
            pairs = _counted(f"{path}.pairs", s["at"], s["size"])
            records = _frames(f"{path}.records", s["records_at"], s["records_size"], 2)
            rest = np.zeros(0, np.int64)
            for (keys, n), (document, links) in zip(pairs, records, strict=True):
                while len(rest) < len(keys):
                    rest = np.concatenate([rest, next(values)])
                each = np.repeat(rest[:len(keys)], n)
                rest = rest[len(keys):]
                np.add.at(total, document, links * (each >> 1))
                np.add.at(best, document, links * (each & 1))
        arrays = {c: table[f"k{i}"] for i, c in enumerate(keep)}
        arrays |= {c: table[c] for c in ("n_a", "n_b", "n_groups", "n_links")}
        arrays |= {"n_best": pa.array(best), "count_sum": pa.array(total), "groups_sha256": table["groups_sha256"]}
        return pa.table(list(arrays.values()), names=list(arrays)).cast(to_arrow_schema(schema))

    sides = [df.repartition(tasks, "run").groupBy("run") for df in (own, counting.answers)]
    return stored(sides[0].cogroup(sides[1]).applyInArrow(report, schema), "crosswalk")
