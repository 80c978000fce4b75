"""Near-duplicate texts: exact Jaccard join of word shingles, filtered under several token orders.

Two sets with a similarity of at least t share a token in the prefixes of both under every order of all
tokens, a prefix being the first n - ceil(t n) + 1 tokens. The join goes by these steps; none loses a link.

1. Equal sets are one node, named by a hash of the set.
2. First order (by hash), over all texts: with a prefix longer by l tokens, two similar sets share l tokens in it.
   Nodes that don't find as many of their prefix tokens elsewhere have no partner and go.
3. Nodes with an equal smallest hash are compared with one of them (stars, not pairs). The
   components so found only serve to skip pairs whose ends are connected already, so large groups of near
   copies never become pairs.
4. Second order (frequent tokens last): nodes of different components that share a prefix token are
   candidates, if what stands behind it in both suffices for the overlap needed, and if their signatures don't
   differ in more bits than the sets may in tokens. Very common passages stand at the end of this order, and
   texts that have no more than a passage in common are told apart before a pair of them is written.
5. Candidates whose prefixes also meet under the third and fourth order are verified on the whole sets.

Tokens are 64-bit hashes of shingles. A token that many share is reduced to two postings in each
batch before it is shuffled in step 2, and to its extreme components in step 4; the lists left are cut
into tiles, so that no task gets a list whole.

Defined cases: null, empty and blank texts have an empty set and link with nothing; fewer words than a shingle make
one shingle; repeated rows and equal texts share a component; a row without id takes part, and a component's id is its
smallest id that isn't null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, mark_hot, pack, scratch_path, slices, split_join, spread, stored, unpack
from tidemark.llm.components import components, grown
from tidemark.llm.words import mix, shingles

SLICE_BYTES = 4 << 20
#: The longer prefix of step 2: one more token for each so many of the set.
EXTRA = 10
#: Smallest hashes kept of each set (step 3).
HASHES = 8
#: The rounds of step 3, each by some of the hashes; what one connects, the next leaves out.
ROUNDS = ((0,), (1, 2, 3), (4, 5, 6, 7))
#: Tokens in more sets than this, and than a millionth of all, count as frequent: a million of them at most.
FREQUENT = 16
FREQUENT_AT_MOST = 1_000_000
#: Sets in one tile of a token's list.
TILE = 1000
#: Bits of a signature, a power of two between these that isn't less than the set's size.
LEAST_BITS, MOST_BITS = 64, 8192
#: Bits of a bitmap at most, which is broadcast.
BITMAP_BITS = 1 << 27
#: Pairs of a group's lists that are held before they are made distinct and compared by signature.
HELD = 1 << 20


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """ceil(percent / 100 * n): the tokens that a similar set has in common with one of n, at least."""
    return (percent * n + 99) // 100


def _keys(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    n = np.diff(at)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s, 9))])
        return mix((total[at[1:]] - total[at[:-1]]) + n.astype(np.uint64), 10).view(np.int64)


def signature(tokens: np.ndarray) -> bytes:
    """A bit for each class of tokens, set where the set has an odd number of them.

    A token that only one of two sets has turns one bit, so signatures differ in no more bits than sets in tokens.
    A signature's halves, one xor the other, are that of half as many bits.
    """
    bits = min(max(1 << (max(len(tokens), 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    odd = np.bincount((mix(tokens, 40) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def near_enough(signatures: list[bytes], n: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of places (left, right) may be similar by signatures and sizes; sizes differ by less than half."""
    width = np.array([8 * len(s) for s in signatures], dtype=np.int64)
    keep = np.zeros(len(left), dtype=bool)
    common = np.minimum(width[left], width[right])
    for w in np.unique(common).tolist():
        at = np.flatnonzero(common == w)
        used, place = np.unique(np.concatenate([left[at], right[at]]), return_inverse=True)
        rows = np.zeros((len(used), w // 64), dtype=np.uint64)
        for i, k in enumerate(used.tolist()):
            rows[i] = np.bitwise_xor.reduce(np.frombuffer(signatures[k], dtype=np.uint64).reshape(-1, w // 64), axis=0)
        a, b = place[:len(at)], place[len(at):]
        step = max(1, (64 << 20) // w)
        for lo in range(0, len(at), step):
            differ = np.bitwise_count(rows[a[lo:lo + step]] ^ rows[b[lo:lo + step]]).sum(axis=1, dtype=np.int64)
            some = at[lo:lo + step]
            keep[some] = (100 + percent) * differ <= (100 - percent) * (n[left[some]] + n[right[some]])
    return keep


def _distinct_rows(s: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rows with a set, the first of equal ones."""
    first = np.sort(np.unique(key, return_index=True)[1])
    return first[np.diff(at)[first] > 0]


def classes(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, key, tie) of every row of docs(doc_id, text); tie is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", SLICE_BYTES):
            s, at = shingles(rows["text"].combine_chunks(), size)
            yield pa.RecordBatch.from_pydict({"doc_id": rows["doc_id"].combine_chunks(), "n": pa.array(np.diff(at), pa.int64()), "key": pa.array(_keys(s, at), pa.int64()),
                                               "tie": rows["tie"].combine_chunks()})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")).mapInArrow(run, "doc_id long, n long, key long, tie long")


def shared_counts(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """(key, shared): how many tokens of each set's longer prefix are in another set's, at least where it matters.

    Copies in different batches may count a token again, which only lets more sets pass.
    """
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", SLICE_BYTES):
            s, at = shingles(rows["text"].combine_chunks(), size)
            names = _keys(s, at)
            rows_ = _distinct_rows(s, at, names)
            n = np.diff(at)[rows_]
            p = n - _need(n, percent) + np.maximum(1, n // EXTRA)
            take = np.repeat(at[:-1][rows_] - (np.cumsum(p) - p), p) + np.arange(p.sum())
            token, local = s[take], np.repeat(np.arange(len(rows_)), p)
            if not len(token):
                continue
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((token, bucket))
            token, local, bucket = token[order], local[order], bucket[order]
            run = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            length = np.diff(np.append(run, len(token)))
            many = length > 1  # rows differ, so these tokens are shared here already
            counted = np.bincount(local[np.repeat(many, length)], minlength=len(rows_))
            token, bucket = (token[run] // np.uint64(buckets)).astype(np.uint32), bucket[run]
            one, other = local[run], local[run + length - 1]
            border = np.searchsorted(bucket, np.arange(buckets + 1))
            keys = names[rows_]
            for b in range(buckets):
                lo, hi = border[b], border[b + 1]
                if lo == hi and b:
                    continue
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b], pa.int32()), "token": pa.array([pack(token[lo:hi])], pa.binary()),
                    "one": pa.array([pack(one[lo:hi].astype(np.uint32))], pa.binary()), "other": pa.array([pack(other[lo:hi].astype(np.uint32))], pa.binary()),
                    "keys": pa.array([keys.tobytes()], pa.binary()), "counted": pa.array([pack(counted.astype(np.uint32)) if b == 0 else None], pa.binary())})

    def count(group: pa.Table) -> pa.Table:
        tokens, names, fresh, done_key, done_n = [], [], [], [], []
        for row in group.to_pylist():
            keys = np.frombuffer(row["keys"], dtype=np.int64)
            t, a, b = (unpack(row[c], np.uint32) for c in ("token", "one", "other"))
            two = a != b
            tokens += [t, t[two]]
            names += [keys[a], keys[b[two]]]
            fresh += [~two, np.zeros(int(two.sum()), dtype=bool)]
            if row["counted"] is not None:
                done_key.append(keys)
                done_n.append(unpack(row["counted"], np.uint32).astype(np.int64))
        t, k, f = np.concatenate(tokens), np.concatenate(names), np.concatenate(fresh)
        order = np.argsort(t, kind="stable")
        t, k, f = t[order], k[order], f[order]
        if len(t):
            run = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            shared = np.minimum.reduceat(k, run) != np.maximum.reduceat(k, run)
            hit = np.repeat(shared, np.diff(np.append(run, len(t)))) & f
            done_key.append(k[hit])
            done_n.append(np.ones(int(hit.sum()), dtype=np.int64))
        k, n = np.concatenate([*done_key, np.zeros(0, np.int64)]), np.concatenate([*done_n, np.zeros(0, np.int64)])
        k, n = k[n > 0], n[n > 0]
        name, place = np.unique(k, return_inverse=True)
        return pa.table({"key": pa.array(name, pa.int64()), "shared": pa.array(np.bincount(place, weights=n, minlength=len(name)).astype(np.int64), pa.int64())})

    posted = docs.select("text").mapInArrow(post, "bucket int, token binary, one binary, other binary, keys binary, counted binary")
    return posted.groupBy("bucket").applyInArrow(count, "key long, shared long").groupBy("key").agg(F.sum("shared").alias("shared"))


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The classes, by their lowest bits, of the hashes in the only column, as 64-bit words; bits is a power of two."""
    at = hashes.select(F.col(hashes.columns[0]).bitwiseAND(bits - 1).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["set"].to_numpy().view(np.uint64)
    return out


def _in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) & np.uint64(64 * len(words) - 1)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


class Sets:
    """The sets of the nodes that may have a partner: (key, n, hashes, signature, tokens), in files bucketed by key."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, size: int, count: int, mb: int = 64):
        spark = docs.sparkSession
        self.name, self.path = f"sets_{uuid.uuid4().hex}", scratch_path(spark, "sets")
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spread(docs, mb))

        # texts stay where they are read: bitmaps of a bounded size tell most of those without a node, the join below the rest
        bits = min(max(1 << (16 * count).bit_length(), LEAST_BITS), BITMAP_BITS)
        chosen = spark.sparkContext.broadcast((bitmap(nodes.select(F.xxhash64("doc_id").alias("h")), bits), bitmap(nodes.select("key"), bits)))

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_in_bitmap(chosen.value[0], batch.column("id").to_numpy())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in slices(some(batches), "text", SLICE_BYTES):
                s, at = shingles(rows["text"].combine_chunks(), size)
                key = _keys(s, at)
                keep = _distinct_rows(s, at, key)
                keep = keep[_in_bitmap(chosen.value[1], key[keep])]
                if not len(keep):
                    continue
                least = [_least(s, at, keep, 20 + k) for k in range(HASHES)]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(key[keep], pa.int64()), "n": pa.array(np.diff(at)[keep], pa.int64()),
                    "hashes": pa.array(list(np.stack(least, axis=1).view(np.int64)), pa.list_(pa.int64())),
                    "signature": pa.array([signature(s[at[i]:at[i + 1]]) for i in keep.tolist()], pa.binary()),
                    "tokens": pa.array([s[at[i]:at[i + 1]].tobytes() for i in keep.tolist()], pa.binary())})

        sets = docs.select(F.xxhash64("doc_id").alias("id"), "text").mapInArrow(run, "key long, n long, hashes array<long>, signature binary, tokens binary").repartition(buckets, "key").dropDuplicates(["key"])
        sets = sets.join(nodes.select("key"), "key", "left_semi")
        sets.write.format("parquet").bucketBy(buckets, "key").sortBy("key").option("compression", "zstd").option("path", self.path).saveAsTable(self.name)
        self.table = spark.table(self.name)
        self.table.scratch = self.path

    def drop(self) -> None:
        self.table.sparkSession.sql(f"DROP TABLE {self.name}")
        discard(self.table)


def _least(s: np.ndarray, at: np.ndarray, rows: np.ndarray, salt: int) -> np.ndarray:
    """The smallest hash of each of the rows, none of which is empty."""
    full = np.flatnonzero(np.diff(at) > 0)
    return np.minimum.reduceat(mix(s, salt), at[:-1][full])[np.searchsorted(full, rows)]


def _prefix(tokens: np.ndarray, n: int, percent: int, salt: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The prefix of a set under one order: frequent tokens last, by frequency; then by a hash of salt."""
    p = int(n - _need(np.int64(n), percent) + 1)
    names, counts = frequent
    rank = np.zeros(n, dtype=np.int64)
    if len(names):
        at = np.minimum(np.searchsorted(names, tokens), len(names) - 1)
        rank = np.where(names[at] == tokens, counts[at], 0)
    return tokens[np.lexsort((mix(tokens, salt), rank))[:p]]


def verified(pairs: DataFrame, sets: DataFrame, percent: int, frequent=None) -> DataFrame:
    """The pairs (a, b) whose sets are similar; with frequent, those only that also pass the later orders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = frequent.value if frequent is not None else None

        @functools.lru_cache(maxsize=2000)
        def prefixes(tokens: bytes) -> tuple[np.ndarray, ...]:
            t = np.frombuffer(tokens, dtype=np.uint64)
            return tuple(np.sort(_prefix(t, len(t), percent, o, orders)) for o in (3, 4))

        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)):
                small, large = sorted((len(a), len(b)))
                if 100 * small < percent * large:
                    continue
                if orders is not None and not all(_common(p, q) for p, q in zip(prefixes(a), prefixes(b), strict=True)):
                    continue
                both = _common(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64))
                keep[i] = 100 * both >= percent * ((small + large) // 8 - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def stars(sets: DataFrame, which: list[int], nodes: int) -> DataFrame:
    """Pairs (a, b) of nodes with an equal smallest hash: each with the first of its part, those with the first of all."""
    parts = max(1, nodes // TILE)
    rows = sets.select("key", F.posexplode("hashes").alias("k", "h")).where(F.col("k").isin(which)).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    # another order for each hash: what isn't like one centre may be like the next
    first = rows.groupBy("k", "h", "part").agg(F.min(F.struct(F.xxhash64("k", "key").alias("o"), F.col("key").alias("b"))).alias("first"))
    top = first.groupBy("k", "h").agg(F.min("first").alias("top"))
    inner = rows.join(first, ["k", "h", "part"]).select(F.col("key").alias("a"), F.col("first.b").alias("b"))
    outer = first.join(top, ["k", "h"]).select(F.col("first.b").alias("a"), F.col("top.b").alias("b"))
    return inner.unionByName(outer).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not known to be connected."""
    a = found.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = found.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    met = pairs.join(a, "a", "left").join(b, "b", "left")
    return met.where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")


def frequent_tokens(sets: DataFrame, total: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens and in how many sets they are; FREQUENT_AT_MOST at most, since all sets together hold total."""
    least = max(FREQUENT, -(-total // FREQUENT_AT_MOST))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "tokens", 4 << 20):
            all_ = np.frombuffer(b"".join(rows["tokens"].to_pylist()), dtype=np.uint64)
            token, n = np.unique(all_, return_counts=True)
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            token, n, border = token[order], n[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                lo, hi = border[b], border[b + 1]
                if lo < hi:
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "token": pa.array([pack(token[lo:hi])], pa.binary()), "n": pa.array([pack(n[lo:hi].astype(np.uint32))], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        token = np.concatenate([unpack(x, np.uint64) for x in group["token"].to_pylist()])
        n = np.concatenate([unpack(x, np.uint32) for x in group["n"].to_pylist()]).astype(np.int64)
        order = np.argsort(token, kind="stable")
        token, n = token[order], n[order]
        run = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        n = np.add.reduceat(n, run)
        return pa.table({"token": pa.array(token[run][n >= least].view(np.int64), pa.int64()), "n": pa.array(n[n >= least], pa.int64())})

    got = sets.select("tokens").mapInArrow(part, "bucket int, token binary, n binary").groupBy("bucket").applyInArrow(add, "token long, n long").toArrow()
    token, n = got["token"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def candidates(sets: DataFrame, found: DataFrame, percent: int, frequent, all_members: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix token under the second order; written.

    Without all_members, each token's list has one node of each component, another one for each token.
    """
    spark = sets.sparkSession

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = frequent.value
        for batch in batches:
            out = [_prefix(np.frombuffer(t, dtype=np.uint64), n, percent, 2, orders) for t, n in zip(batch.column("tokens").to_pylist(), batch.column("n").to_pylist(), strict=True)]
            size = np.array([len(x) for x in out], dtype=np.int64)
            spot = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            made = {"token": pa.array(np.concatenate([*out, np.zeros(0, np.uint64)]).view(np.int64), pa.int64()), "spot": pa.array(spot, pa.int64())}
            for c in ("key", "root", "n"):
                made[c] = pa.array(np.repeat(batch.column(c).to_numpy(), size), pa.int64())
            yield pa.RecordBatch.from_pydict(made)

    roots = found.select(F.col("node").alias("key"), F.col("root").alias("_root"))
    rows = sets.join(roots, "key", "left").select("key", "n", "tokens", F.coalesce("_root", "key").alias("root"))
    posted = rows.mapInArrow(post, "token long, spot long, key long, root long, n long")
    per = posted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows")).where("low <> high").select("token", "rows")
    lists = posted.join(per, "token")
    if not all_members:
        pick = F.min(F.struct(F.xxhash64("token", "key").alias("o"), "key", "spot", "n", "rows"))
        lists = lists.groupBy("token", "root").agg(pick.alias("one")).select("token", "root", "one.key", "one.spot", "one.n", "one.rows")
    lists = lists.join(sets.select("key", "signature"), "key")
    tiles = F.ceil(F.col("rows") / TILE)
    lists = lists.withColumn("mine", F.pmod(F.xxhash64("key"), tiles)).withColumn("its", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    lists = lists.select("token", "spot", "key", "root", "n", "signature", "mine", F.least("mine", "its").alias("lo"), F.greatest("mine", "its").alias("hi"))
    lists = stored(lists, "lists")
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lists.count() // 100_000 + 1)

    def pair(group: pa.Table) -> pa.Table:
        c = {k: group[k].to_numpy() for k in ("token", "spot", "key", "root", "n", "mine", "lo", "hi")}
        order = np.lexsort((c["root"], c["hi"], c["lo"], c["token"]))
        c = {k: v[order] for k, v in c.items()}
        keys, first, place = np.unique(c["key"], return_index=True, return_inverse=True)
        signatures, sizes = group["signature"].take(pa.array(order[first])).to_pylist(), c["n"][first]
        tile = np.stack([c["token"], c["lo"], c["hi"]])
        begin = np.flatnonzero(np.concatenate([[True], (tile[:, 1:] != tile[:, :-1]).any(0)])) if len(order) else np.zeros(0, np.int64)
        held, met = [], [np.zeros(0, np.int64)]  # pairs as one number: the places of both in keys
        size = 0

        def settle() -> None:
            new = np.unique(np.concatenate([np.zeros(0, np.int64), *held]))
            new = new[near_enough(signatures, sizes, new // len(keys), new % len(keys), percent)] if len(new) else new
            met[0] = np.union1d(met[0], new)
            held.clear()

        for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
            root, n, mine, own = c["root"][lo:hi], c["n"][lo:hi], c["mine"][lo:hi], place[lo:hi]
            rest = n - c["spot"][lo:hi]  # from the token on
            if root[0] == root[-1]:
                continue
            edge = np.searchsorted(root, root, side="right")  # partners stand behind the row's own component
            for i in np.flatnonzero(edge < hi - lo).tolist():
                j = np.arange(edge[i], hi - lo)
                # if the token is the first that the two share, they share no more than what stands behind it
                fits = (100 + percent) * np.minimum(rest[j], rest[i]) >= percent * (n[j] + n[i])
                if c["lo"][lo] != c["hi"][lo]:
                    fits &= mine[j] != mine[i]
                j = own[j[fits]]
                held.append(np.minimum(j, own[i]) * len(keys) + np.maximum(j, own[i]))
                size += len(j)
            if size >= HELD:
                settle()
                size = 0
        settle()
        return pa.table({"a": pa.array(keys[met[0] // max(len(keys), 1)], pa.int64()), "b": pa.array(keys[met[0] % max(len(keys), 1)], pa.int64())})

    grouped = lists.withColumn("_group", F.pmod(F.xxhash64("token", "lo", "hi"), F.lit(groups)))
    pairs = stored(grouped.groupBy("_group").applyInArrow(pair, "a long, b long").distinct(), "pairs")
    discard(lists)
    return pairs


def linked(docs: DataFrame, size: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(classes, components of their keys): see classes() and components.components()."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select("doc_id", "text")
    named = stored(classes(docs, size), "classes")
    buckets = spread(docs, 32)
    per_key = named.where("n > 0").groupBy("key").agg(F.any_value("n").alias("n"), F.min("doc_id").alias("doc_id"))
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / EXTRA))
    nodes = stored(per_key.join(shared_counts(docs, size, percent, buckets), "key").where(F.col("shared") >= need).select("key", "n", "doc_id"), "nodes")
    count, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    sets = Sets(docs, nodes, size, count)
    found = components(nodes.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0))
    for which in ROUNDS:
        near = stars(sets.table, list(which), count)
        found = grown(found, verified(near if which == ROUNDS[0] else apart(near, found), sets.table, percent))
    frequent = spark.sparkContext.broadcast(frequent_tokens(sets.table, total, buckets))
    # a node that is like many of a component is first held against a few of them
    for all_members in (False, True):
        pairs = candidates(sets.table, found, percent, frequent, all_members)
        found = grown(found, verified(pairs, sets.table, percent, frequent))
        discard(pairs)
    sets.drop()
    discard(nodes)
    return named, found


def join(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs(doc_id, text)."""
    named, found = linked(docs, size, percent)
    root = found.select(F.col("node").alias("key"), "root")
    per_key = named.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    per_key = per_key.join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = per_key.groupBy("root").agg(F.min("least").alias("component_id"))
    per_key = per_key.join(least, "root").select("key", "rows", "component_id")
    some = split_join(named.where("n > 0"), stored(mark_hot(per_key, "rows"), "per-key"), ["key"])
    none = named.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.select("doc_id", "n", "component_id").unionByName(none).withColumnRenamed("n", "n_shingles")


def first_of_each(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """docs without all but one document of each component: that with its smallest id, nulls last, of equal rows one.

    Rows are told apart by id and text, so a component keeps one row also where its ids are null or repeated. Documents without
    words are components of their own.
    """
    named, found = linked(docs, size, percent)
    row = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "tie")
    per_key = named.where("n > 0").groupBy("key").agg(F.min(row).alias("first"))
    rooted = per_key.join(found.select(F.col("node").alias("key"), "root"), "key", "left").groupBy(F.coalesce("root", "key")).agg(F.min("first").alias("first"))
    chosen = rooted.select("first.doc_id", "first.tie").unionByName(named.where("n = 0").select("doc_id", "tie").distinct())
    counts = named.groupBy("doc_id", "tie").agg(F.count("*").alias("rows")).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "rows")
    kept = stored(chosen.join(counts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))).select("_id", "_tie", "rows"), "kept")

    def of(rows: DataFrame) -> DataFrame:
        return docs.join(rows, docs["doc_id"].eqNullSafe(rows["_id"]) & (F.xxhash64(docs["text"]) == rows["_tie"]), "left_semi")

    return of(kept.where("rows = 1")).unionByName(of(kept.where("rows > 1")).dropDuplicates(["doc_id", "text"]))
