"""Near-duplicate vectors against all pairs; recall of the search against brute force."""

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hilbert, subspace
from tidemark.llm.common import open_shared

SCHEMA = "vec_id long, embedding array<float>, label int, links long"


def clustered(seed, n=260, dims=20):
    r = np.random.Generator(np.random.PCG64(seed))
    centres = r.standard_normal((20, dims))
    rows = []
    for i in range(n):
        v = centres[r.integers(20)] + r.standard_normal(dims) * r.choice([0, 0.05, 0.28, 1.0])
        rows.append((i, (v * r.choice([0.5, 1.0, 3.0])).astype(np.float32).tolist(), int(r.integers(2)), 5))
    return rows


def brute(rows, cosine):
    m = np.array([v for _, v, _, _ in rows], dtype=np.float64)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    label = np.array([x for *_, x, _ in rows])
    near = (u @ u.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(len(rows))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(rows)).min(1))
        if (new == root).all():
            return near.sum(1), root
        root = new


@pytest.mark.parametrize("tile", [2000, 9])
def test_links_equal_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(subspace, "TILE", tile)
    rows = clustered(3)
    links, root = brute(rows, 0.93)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in subspace.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (int(links[i]), int(root[i]), i == root[i]) for i in range(len(rows))}
    assert links.max() > 5


def test_vectors_are_written_once_whatever_their_pairs(spark, monkeypatch):
    """Copies per pair of tiles and block made disk grow with the square of the rows."""
    kept = []

    def seen(_, folder):
        fs, path = open_shared(folder)
        for file in fs.get_file_info(pa.fs.FileSelector(path)):
            with fs.open_input_file(file.path) as source:
                kept.extend(pa.ipc.open_file(source).read_all()["cid"].to_pylist())

    monkeypatch.setattr(subspace, "TILE", 9)
    monkeypatch.setattr(subspace, "drop", seen)
    rows = clustered(4)
    distinct = len({(tuple(v), x) for _, v, x, _ in rows})
    assert subspace.dedup(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)
    assert len(kept) == len(set(kept)) == distinct


def test_single_precision_and_double_agree(spark):
    rows = clustered(5)
    one = subspace.dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    two = subspace.dedup(spark.createDataFrame(rows, SCHEMA.replace("array<float>", "array<double>"))).collect()
    assert sorted(one) == sorted(two)


ODD = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [float("nan"), 1.0], 1), (7, [1.0, 0.0], None),
       (8, [1.0, None], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.3], 1), (11, [1.0, 0.0], 2), (None, [1.0, 0.01], 2), (12, [], 1), (13, [float("inf"), 1.0], 1)]


def test_defined_cases(spark):
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in subspace.dedup(spark.createDataFrame(ODD, "vec_id long, embedding array<double>, label int")).collect()}
    for i in (1, 2, 3, 10):
        assert got[i] == (3, 1, i == 1)
    for i in (4, 5, 6, 7, 8, 9, 12, 13):
        assert got[i] == (0, i, True)
    assert got[11] == (1, 11, True) and got[None] == (1, 11, False)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert subspace.dedup(empty).collect() == []


def nearest(rows, queries, k):
    m = np.array([v for _, v, *_ in rows], dtype=np.float64)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    ids = np.array([i for i, *_ in rows])
    out = {}
    for q in queries:
        s = u @ u[q]
        order = [j for j in np.lexsort((ids, -s.round(12))) if j != q][:k]
        out[int(ids[q])] = [int(ids[j]) for j in order]
    return out


def test_search_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.orderBy("vec_id").collect()]
    exact = nearest(rows, [k for k, (i, _) in enumerate(rows) if i % 50 == 0], 5)
    found: dict[int, list] = {}
    old = hilbert.BLOCK_ROWS
    try:
        hilbert.BLOCK_ROWS = 100  # small blocks, so that the windows leave rows out
        got = hilbert.search(df, F.col("vec_id") % 50 == 0).collect()
    finally:
        hilbert.BLOCK_ROWS = old
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found.keys() == exact.keys() and all(len(set(v)) == 5 for v in found.values())
    assert sum(len(set(found[q]) & set(e)) for q, e in exact.items()) >= 0.9 * 5 * len(exact)


def test_search_scores_and_ties(spark):
    rows = [(i, [1.0, 0.0, 0.0] if i < 30 else [0.5, float(i), 1.0], 1) for i in range(40)]
    got = hilbert.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, key int"), F.col("vec_id") == 7, 5).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(k + 1, k, 1.0) for k in range(5)]


def test_search_defined_cases(spark):
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>, label int")
    got = sorted(((r.query_id, r["rank"], r.vec_id) for r in hilbert.search(df, F.col("vec_id").isin(1, 4, 5, 9, 12), 5).collect()))
    assert got == [(1, k + 1, i) for k, i in enumerate([2, 3, 7, 11, 10])]  # 9 has no other of its length, the rest take no part
    assert hilbert.search(df.where("vec_id > 100"), F.lit(True)).collect() == []


def test_repeated_rows_take_one_place(spark):
    rows = [(0, [1.0, 0.0, 0.0])] + [(1, [1.0, 0.1, 0.0])] * 8 + [(i, [1.0, 0.1 * i, 0.0]) for i in range(2, 9)]
    got = hilbert.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(k, k) for k in range(1, 6)]


def test_curve_steps_to_neighbours():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    key = hilbert.hilbert(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
