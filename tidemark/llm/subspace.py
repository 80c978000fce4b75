"""Near-duplicate vectors by the pigeonhole principle on subspaces.

Unit vectors with a cosine of at least t have a squared distance of at most 2 - 2t. After a random
rotation the components are split into blocks, and the budget with them in proportion: in one block at least, a
pair keeps within that block's budget. So each block is range-joined by itself: vectors are cut into slabs
along the block's first component, as wide as the budget reaches, and meet those of their slab and the next.
The candidates that keep within the block's budget are verified by their exact cosine. A link counts in the first block
that finds it, so no set of pairs has to be made distinct.

Equal vectors are joined once. The vectors of a label are dealt into tiles, each written once, and every pair of tiles is met by a
task that reads both files: disk follows the vectors, not their pairs or blocks. Slabs are made within a pair of
tiles. There links become degrees and a forest; pairs of a large group are never written.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those without a label, link
with nothing; vectors link with those of their own length only; rows that repeat an id are vectors of their own; a row without id
counts as a vector, and a component's id is its smallest id that isn't null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.common import discard, drop, mark_hot, open_shared, scratch_path, split_join, stored
from tidemark.llm.components import components
from tidemark.llm.hilbert import norms, projection, vectors

BLOCK = 8
TILE = 2000
#: Pairs of tiles that a task meets.
PAIRS = 8
SEED = 77
#: So that rounding can't put every block of a linked pair over its budget.
SLACK = 1 + 1e-9


def _rotated(unit: np.ndarray) -> np.ndarray:
    """unit times a fixed rotation, added up in the same order for each row however many there are."""
    r = projection(unit.shape[1], unit.shape[1], SEED)
    out = np.zeros_like(unit)
    for d in range(unit.shape[1]):
        out += unit[:, d:d + 1] * r[d]
    return out


def _budgets(dims: int, cosine: float) -> list[tuple[slice, float]]:
    return [(slice(lo, min(lo + BLOCK, dims)), (2 - 2 * cosine) * (min(lo + BLOCK, dims) - lo) / dims * SLACK) for lo in range(0, dims, BLOCK)]


def _slabs(vec: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (rows) turned, and the slab of each in each block."""
    turned = _rotated(vec / norms(vec)[:, None])
    return turned, np.stack([np.floor(turned[:, part.start] / np.sqrt(budget)).astype(np.int64) for part, budget in _budgets(vec.shape[1], cosine)], axis=1)


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, left, label[right])
        np.minimum.at(label, right, label[left])
        label = label[label]
        if (label == before).all():
            return label


def _doubles(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors of one length as rows of doubles; their bytes are floats where the given components are."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype="<f4" if len(values[0]) == 4 * dims else "<f8").reshape(len(values), dims).astype(np.float64)


class _Tile:
    """Vectors of one label and length with what each block asks of them."""

    def __init__(self, rows: pa.Table, dims: int, cosine: float):
        rows = rows.take(pa.array(np.argsort(rows["cid"].to_numpy(), kind="stable")))
        self.cid, self.n, self.m = rows["cid"].to_numpy(), rows["n"].to_numpy(), _doubles(rows["vec"], dims)
        self.length = norms(self.m)
        self.turned, self.slab = _slabs(self.m, cosine)
        self.order = np.argsort(self.slab, axis=0, kind="stable")


def _links(one: _Tile, other: _Tile, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of two tiles, or of one with itself, as places in them; each pair once, in the first block that finds it."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    budgets = _budgets(one.m.shape[1], cosine)
    for b, (part, budget) in enumerate(budgets):
        x, y = one.turned[:, part], other.turned[:, part]
        long_x, long_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
        mine, theirs = one.slab[one.order[:, b], b], other.slab[other.order[:, b], b]
        for s in np.unique(mine).tolist():
            at = one.order[np.searchsorted(mine, s):np.searchsorted(mine, s, "right"), b]
            beside = other.order[np.searchsorted(theirs, s - 1):np.searchsorted(theirs, s + 1, "right"), b]
            for k in range(0, len(at) if len(beside) else 0, 64):
                i = at[k:k + 64]
                near = long_x[i][:, None] + long_y[beside][None, :] - 2 * (x[i] @ y[beside].T) <= budget + 1e-9
                if one is other:
                    near &= beside[None, :] > i[:, None]
                r, j = np.nonzero(near)
                for lo in range(0, len(r), 50_000):
                    p, q = i[r[lo:lo + 50_000]], beside[j[lo:lo + 50_000]]
                    good = (one.m[p] * other.m[q]).sum(axis=1) / (one.length[p] * other.length[q]) >= cosine
                    p, q = p[good], q[good]
                    first = np.full(len(p), -1)
                    for e, (t, most) in enumerate(budgets[:b + 1]):
                        within = ((one.turned[p, t] - other.turned[q, t]) ** 2).sum(axis=1) <= most
                        first[within & (first < 0)] = e
                    left.append(p[first == b])
                    right.append(q[first == b])
    return np.concatenate(left), np.concatenate(right)


def _found(one: _Tile, other: _Tile, cosine: float) -> dict[str, pa.Array]:
    """cid, links and one node of the same component of the vectors that have links between the two tiles."""
    p, q = _links(one, other, cosine)
    cid, n = one.cid, one.n
    if one is not other:
        cid, n, q = np.concatenate([one.cid, other.cid]), np.concatenate([one.n, other.n]), q + len(one.cid)
    degree = np.bincount(p, weights=n[q], minlength=len(cid)) + np.bincount(q, weights=n[p], minlength=len(cid))
    root = _forest(p, q, len(cid)) if len(p) else np.arange(len(cid))
    some = np.flatnonzero(degree > 0)
    return {"cid": pa.array(cid[some], pa.int64()), "links": pa.array(degree[some].astype(np.int64), pa.int64()), "other": pa.array(cid[root[some]], pa.int64())}


def _settle(folder: str, cosine: float):
    """A tile's links within itself; a label of several tiles has them written, and a row names each file."""
    def run(group: pa.Table) -> pa.Table:
        label, dims, tile, tiles = (group[c][0].as_py() for c in ("label", "dims", "tile", "tiles"))
        one = _Tile(group, dims, cosine)
        out = pa.table(_found(one, one, cosine))
        row = {"label": None, "dims": None, "tile": None, "path": None}
        if tiles > 1:
            fs, path = open_shared(f"{folder}/{uuid.uuid4().hex}.arrow")  # a name of this attempt's own
            fs.create_dir(path.rpartition("/")[0])
            kept = group.select(["cid", "n", "vec"])
            with fs.open_output_stream(path) as sink, pa.ipc.new_file(sink, kept.schema) as file:
                file.write_table(kept)
            row = {"label": label, "dims": dims, "tile": tile, "path": path.rpartition("/")[2]}
        n = len(out) + (tiles > 1)
        more = pa.table({c: pa.array([None] * len(out) + [row[c]] * (tiles > 1), t) for c, t in (("label", pa.int32()), ("dims", pa.int32()), ("tile", pa.int64()), ("path", pa.string()))})
        nothing = {c: pa.nulls(n - len(out), pa.int64()) for c in out.column_names}
        return pa.table({**{c: pa.concat_arrays([*out[c].chunks, nothing[c]]) for c in out.column_names}, **{c: more[c] for c in more.column_names}})

    return run


def _across(folder: str, cosine: float):
    """The links between the two tiles of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(name: str, dims: int) -> _Tile:
            fs, path = open_shared(f"{folder}/{name}")
            with fs.open_input_file(path) as file:
                return _Tile(pa.ipc.open_file(file).read_all(), dims, cosine)

        name, one = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["one"] != name:
                    name, one = row["one"], tile(row["one"], row["dims"])
                yield pa.RecordBatch.from_pydict(_found(one, tile(row["other"], row["dims"]), cosine))

    return run


def near(distinct: DataFrame, cosine: float) -> DataFrame:
    """(cid, links, other) of distinct(cid, label, dims, n, vec), written: vectors linked to, and one node of the same component, per pair of tiles."""
    folder = scratch_path(distinct.sparkSession, "tiles")
    size = distinct.groupBy("label", "dims").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    rows = distinct.join(stored(size, "sizes"), ["label", "dims"]).withColumn("tile", F.pmod(F.xxhash64("cid"), "tiles"))
    within = rows.groupBy("label", "dims", "tile").applyInArrow(_settle(folder, cosine), "cid long, links long, other long, label int, dims int, tile long, path string")
    within = stored(within, "within")
    files = within.where("path is not null")
    one, other = (files.select("label", "dims", F.col("tile").alias(f"{c}_tile"), F.col("path").alias(c)) for c in ("one", "other"))
    pairs = stored(one.join(other, ["label", "dims"]).where("one_tile < other_tile").select("dims", "one", "other"), "pairs")
    # a row stands for the work of two tiles, so tasks follow the rows and not their bytes
    dealt = pairs.repartition(pairs.count() // PAIRS + 1, F.xxhash64("one", "other")).sortWithinPartitions("one")
    across = stored(dealt.mapInArrow(_across(folder, cosine), "cid long, links long, other long"), "across")
    discard(pairs)
    drop(distinct.sparkSession, folder)
    return within.where("cid is not null").select("cid", "links", "other").unionByName(across)


def dedup(rows: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of rows(vec_id, embedding, label)."""
    narrow = isinstance(rows.schema["embedding"].dataType.elementType, FloatType)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, begin, length = vectors(batch.column("embedding"))
            length[~batch.column("label").is_valid().to_numpy(zero_copy_only=False)] = 0
            vec = [values[b:b + n].astype("<f4" if narrow else "<f8").tobytes() if n else None for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "label": batch.column("label"), "dims": pa.array(length, pa.int32()), "vec": pa.array(vec, pa.binary())})

    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
    made = rows.mapInArrow(read, "vec_id long, label int, dims int, vec binary").withColumn("digest", F.unhex(F.sha2("vec", 256)))
    read_ = stored(made.drop("vec", "dims"), "vectors")  # vectors themselves are kept once for each distinct one
    usable = read_.where("digest is not null")
    per = made.where("vec is not null").groupBy("label", "dims", "digest").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.any_value("vec").alias("vec"))
    per = stored(per.withColumn("cid", F.monotonically_increasing_id()), "distinct")  # numbered once
    found = near(per.select("cid", "label", "dims", "n", "vec"), cosine)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    root = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    known = per.select("cid", "label", "digest", "n", "least").join(links, "cid", "left").join(root.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.withColumn("root", F.coalesce("root", "cid")).withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("label", "digest", "n", "n_links", "component_id")
    some = split_join(usable.select("vec_id", "label", "digest"), stored(mark_hot(known, "n"), "known"), ["label", "digest"]).select("vec_id", "n_links", "component_id")
    none = read_.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
