"""The Jaccard join and connected components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import word_list
from tidemark.llm import jaccard
from tidemark.llm.components import components, grown


def brute(texts):
    """Component of each position: the smallest position it reaches."""
    sets = []
    for t in texts:
        w = word_list("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def corpus(seed, n=150):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        kind = r.random()
        if texts and kind < 0.45:  # chains of edits, so that components hold texts that aren't similar themselves
            words = word_list(r.choice(texts[-20:]))
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
        else:
            words = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 5, 9, 40, 120]))]
            if kind > 0.7:
                words = words[:20] + passage
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize(("seed", "small"), [(1, False), (2, True)])
def test_components_equal_brute_force(spark, monkeypatch, seed, small):
    if small:  # frequent tokens, tiles and parts of stars come up in small data too
        monkeypatch.setattr(jaccard, "FREQUENT", 3)
        monkeypatch.setattr(jaccard, "TILE", 4)
        monkeypatch.setattr(jaccard, "ROUNDS", ((0,),))
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sizes, roots = brute(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    assert got == dict(enumerate(zip(sizes, roots, strict=True)))


def test_defined_cases(documents):
    got = jaccard.join(documents).collect()
    assert len(got) == documents.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by_id[3] == [(0, 3)] and by_id[4] == [(0, 4)] and by_id[5] == [(0, 5)]
    assert by_id[6] == by_id[7] == [(1, 6)] and by_id[2] == [(11, 1)] and by_id[None] == [(1, None)]
    assert sorted(by_id[1]) == [(1, 1), (11, 1), (11, 1), (11, 1)]


def test_one_of_each_stays(documents):
    kept = jaccard.first_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        {(r.doc_id or 0, r.text or "") for r in documents.collect() if r.doc_id not in (2, 7)})


def test_near_copies_without_or_with_repeated_ids(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega one two three"
    rows = [(None, base), (None, base + " four"), (7, base + " five"), (8, "quite another text of more than five words"), (8, base + " six"),
            (None, ""), (None, ""), (9, None), (None, "lone words without any id at all"), (None, "lone words without any id at all")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _id string")
    kept = sorted((str(r.doc_id), str(r.text)) for r in jaccard.first_of_each(docs).collect())
    assert kept == sorted([("7", base + " five"), ("8", "quite another text of more than five words"), ("None", ""), ("9", "None"), ("None", "lone words without any id at all")])


def test_nothing(nothing):
    assert jaccard.join(nothing).collect() == []
    assert jaccard.first_of_each(nothing).collect() == []


def test_contraction_finds_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1001), (1001, 1000), (5000, 5000)] + [(3000, 3000 + i) for i in range(1, 50)]
    got = components(spark.createDataFrame(edges, "a long, b long")).groupBy("root").agg(F.count("*").alias("n"), F.min("node").alias("m"), F.max("node").alias("x"))
    assert sorted((r.n, r.m, r.x) for r in got.collect()) == [(2, 1000, 1001), (50, 3000, 3049), (201, 0, 200)]


def test_signatures_lose_no_similar_pair():
    r = np.random.default_rng(5)
    kept = similar = 0
    for _ in range(300):
        n = int(r.integers(1, 900))
        own = r.integers(0, 2**64, n, dtype=np.uint64)
        other = np.unique(np.concatenate([own[int(n * r.random() * 0.5):], r.integers(0, 2**64, int(n * r.random() * 0.4), dtype=np.uint64)]))
        both = len(np.intersect1d(own, other))
        if not min(n, len(other)) or 100 * min(n, len(other)) < 75 * max(n, len(other)):
            continue
        passed = jaccard.near_enough([jaccard.signature(own), jaccard.signature(other)], np.array([n, len(other)]), np.array([0]), np.array([1]), 75)[0]
        like = 100 * both >= 75 * (n + len(other) - both)
        assert passed or not like
        kept, similar = kept + passed, similar + like
    assert similar > 20 and kept < 2 * similar


def test_texts_with_a_passage_in_common_are_no_candidates(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 1000)  # the passage's tokens count as rare ones
    seen = []
    real = jaccard.candidates
    monkeypatch.setattr(jaccard, "candidates", lambda *a: seen.append(real(*a)) or seen[-1])
    counts = []
    real_verified = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *a: counts.append(pairs.count() if len(a) == 3 else 0) or real_verified(pairs, *a))
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"d{d}x{i}" for i in range(60)) + " " + passage for d in range(60)]
    got = jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.component_id for r in got) == list(range(60)) and len(seen) == 2
    assert sum(counts) < 60  # 1,770 pairs share the passage


def test_components_grow_by_links(spark):
    first = [(1, 2), (3, 4), (4, 5), (10, 11)]
    more = [(2, 20), (20, 21), (5, 11), (30, 31), (1, 2)]
    found = grown(components(spark.createDataFrame(first, "a long, b long")), spark.createDataFrame(more, "a long, b long"))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [[1, 2, 20, 21], [3, 4, 5, 10, 11], [30, 31]]


def test_bitmap_holds_each_hash(spark):
    hashes = np.random.default_rng(3).integers(-2**63, 2**63 - 1, 500)
    words = jaccard.bitmap(spark.createDataFrame([(int(h),) for h in hashes], "h long"), 1 << 14)
    assert jaccard._in_bitmap(words, hashes).all()
    assert jaccard._in_bitmap(words, np.random.default_rng(4).integers(-2**63, 2**63 - 1, 5000)).mean() < 0.06


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_bitmaps_of_any_size_keep_all_sets(spark, monkeypatch, bits):
    monkeypatch.setattr(jaccard, "BITMAP_BITS", bits)
    texts = corpus(3, 60)
    docs = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    named = jaccard.classes(docs, 5).where("n > 0")
    nodes = named.groupBy("key").agg(F.any_value("n").alias("n"), F.min("doc_id").alias("doc_id")).where("key % 2 = 0")
    sets = jaccard.Sets(docs, nodes, 5, nodes.count())
    got = sorted((r.key, r.n) for r in sets.table.select("key", "n").collect())
    sets.drop()
    assert got == sorted((r.key, r.n) for r in nodes.collect())
