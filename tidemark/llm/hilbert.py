"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, shifted, and ordered along a Hilbert curve, several times over with
other projections and shifts. Each ordering is range-partitioned into blocks; a query meets the blocks
within a window around its own place on the curve, and what it finds in all orderings is merged and ranked by the
exact cosine of the original vectors.

A window holds a share of all rows, so recall doesn't fall as the table grows; WINDOW and ORDERINGS are
chosen for vectors without any structure, the worst case, where neighbours are hardly nearer than others.
Blocks are cut by row counts with the id as the last sorting column, so equal vectors spread over blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part; ids that are null neither; vectors
are compared with those of their own length; rows that repeat an id and its vector are one candidate, other vectors of an id candidates each, but never of that
id's query, and queries of one id are answered together; ties go to the smaller id; with too few candidates a query has fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

ORDERINGS = 8
DIMENSIONS = 4
BITS = 6
#: Share of the rows on either side of a query's block.
WINDOW = 0.14
BLOCK_ROWS = 2000
#: Queries that meet one block at a time.
QUERY_ROWS = 4000


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values end to end, begin, length) of a list column; unusable vectors get length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_list(pa.float64()))
    at = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)  # null components become NaN
    length = np.diff(at)
    length[~column.is_valid().to_numpy(zero_copy_only=False)] = 0
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    some = np.concatenate([[0], np.cumsum(np.nan_to_num(values) != 0)])
    length[(bad[at[1:]] > bad[at[:-1]]) | (some[at[1:]] == some[at[:-1]])] = 0
    return values, at[:-1], length


def usable(rows: DataFrame, kept: str, embedding: str = "embedding") -> DataFrame:
    """The kept columns (a schema), dims and vec (doubles, little-endian) of rows whose vector can be compared."""
    names = [x.split()[0] for x in kept.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, begin, length = vectors(batch.column(embedding))
            keep = np.flatnonzero(length > 0)
            vec = [values[begin[i]:begin[i] + length[i]].astype("<f8").tobytes() for i in keep.tolist()]
            yield pa.RecordBatch.from_pydict({**{n: batch.column(n).take(pa.array(keep)) for n in names}, "dims": pa.array(length[keep], pa.int32()), "vec": pa.array(vec, pa.binary())})

    return rows.select(*names, embedding).mapInArrow(run, f"{kept}, dims int, vec binary")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<f8").reshape(len(rows), -1)


def norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=1))


def projection(dims: int, out: int, seed: int) -> np.ndarray:
    """out orthonormal directions (all of them, a rotation, if out = dims)."""
    q, _ = np.linalg.qr(np.random.Generator(np.random.PCG64([seed, dims])).standard_normal((dims, dims)))
    return q[:, :out]


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below 2**bits, by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            t = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def keys(m: np.ndarray, ordering: int, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Places of the vectors (rows) in one ordering."""
    dims = m.shape[1]
    out = min(dimensions, dims)
    flat = (m / norms(m)[:, None]) @ projection(dims, out, ordering)
    shift = np.random.Generator(np.random.PCG64([ordering, 7])).random(out) / 2
    # a coordinate of a random direction is about normal with deviation 1 / sqrt(dims)
    spot = (flat * np.sqrt(dims) / 8 + 0.25 + shift) * (1 << bits)
    return hilbert(np.clip(np.floor(spot), 0, (1 << bits) - 1), bits)


def place(valid: DataFrame, rows: int, orderings: int = ORDERINGS) -> DataFrame:
    """valid(vec_id, dims, vec) once for each ordering, with the block it falls into; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                m = matrix(part.column("vec"))
                for k in range(orderings):
                    n = part.num_rows
                    yield pa.RecordBatch.from_pydict({"ordering": pa.array(np.full(n, k), pa.int32()), "dims": part.column("dims"), "key": pa.array(keys(m, k), pa.int64()),
                                                      "vec_id": part.column("vec_id"), "vec": part.column("vec")})

    keyed = valid.mapInArrow(run, "ordering int, dims int, key long, vec_id long, vec binary")
    parts = orderings * max(1, -(-rows // BLOCK_ROWS))
    return stored(keyed.repartitionByRange(parts, "ordering", "dims", "key", "vec_id").withColumn("block", F.spark_partition_id()), "places")


def windows(placed: DataFrame, share: float) -> DataFrame:
    """(ordering, dims, block, near): the blocks that a query in block meets; a table of blocks only."""
    per = placed.groupBy("ordering", "dims", "block").agg(F.count("*").alias("n"))
    along = Window.partitionBy("ordering", "dims").orderBy("block")
    whole = Window.partitionBy("ordering", "dims")
    per = per.withColumn("end", F.sum("n").over(along)).withColumn("total", F.sum("n").over(whole)).withColumn("start", F.col("end") - F.col("n"))
    reach = F.ceil(F.col("total") * share)
    low, high = F.col("start") - reach, F.col("end") + reach
    # at the ends of the curve the window is moved, not cut
    low, high = low - F.greatest(F.lit(0), high - F.col("total")), high + F.greatest(F.lit(0), -low)
    per = stored(per.withColumn("low", low).withColumn("high", high), "blocks")
    other = per.select("ordering", "dims", F.col("block").alias("near"), F.col("start").alias("s"), F.col("end").alias("e"))
    return per.join(other, ["ordering", "dims"]).where("s < high and e > low").select("ordering", "dims", "block", "near")


def _scored(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0)]}
        if queries.num_rows and rows.num_rows:
            m, ids = matrix(rows["vec"]), rows["vec_id"].to_numpy()
            length = norms(m)
            unit = m / length[:, None]
            for lo in range(0, queries.num_rows, 256):
                part = queries.slice(lo, 256)
                q, own = matrix(part["q_vec"]), part["q_vec_id"].to_numpy()
                near = (q / norms(q)[:, None]) @ unit.T
                near[own[:, None] == ids[None, :]] = -np.inf
                at = min(k, len(ids))
                least = np.partition(near, len(ids) - at, axis=1)[:, len(ids) - at]
                # all that may be among the best, then exactly and by id
                i, j = np.nonzero((near >= least[:, None] - 1e-9) & np.isfinite(near))
                exact = (q[i] * m[j]).sum(axis=1) / (norms(q)[i] * length[j])
                order = np.lexsort((ids[j], -exact, i))
                i, j, exact = i[order], j[order], exact[order]
                first = np.searchsorted(i, i)
                keep = np.arange(len(i)) - first < k
                for c, x in (("query_id", own[i]), ("vec_id", ids[j]), ("score", exact)):
                    out[c].append(x[keep])
        return pa.table({c: np.concatenate(x) for c, x in out.items()})

    return run


def search(rows: DataFrame, is_query: Column, k: int = 5, share: float = WINDOW, orderings: int = ORDERINGS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among rows(vec_id, embedding)."""
    valid = stored(usable(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null"), "vec_id long").dropDuplicates(["vec_id", "vec"]), "vectors")
    asked = valid.where(is_query)
    placed = place(valid, valid.count(), orderings)
    group = ["ordering", "dims", "near", "part"]
    parts = max(1, int(asked.count() * (2 * share + 0.1)) // QUERY_ROWS)
    queries = placed.where(is_query).join(windows(placed, share), ["ordering", "dims", "block"])
    queries = queries.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("q_part"), *[F.col(c).alias(f"q_{c}") for c in ("ordering", "dims", "near", "vec_id", "vec")])
    data = placed.select("ordering", "dims", F.col("block").alias("near"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "vec_id", "vec")
    found = queries.groupBy(*[f"q_{c}" for c in group]).cogroup(data.groupBy(*group)).applyInArrow(_scored(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
