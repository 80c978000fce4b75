"""Quality classifier with hierarchical empirical Bayes over sites.

Each document has its own evidence, the log odds of a logistic model over shares of character kinds and of repeated
words. Sites (a host, and a path in it) have posteriors of their own: a host's share of good documents is drawn
towards the share of all, a path's towards its host's, by as many pseudo-documents as the
spread between hosts (paths) supports. A site with few documents stays near what stands above it. A
document's posterior adds its path's log odds over the global ones, the document itself left out, to
its evidence. Sites are grouped aggregates; only their table meets the documents again.

The model is fitted on at most FIT_ROWS labelled documents, those with the smallest hashes of their ids; all else covers all rows.

Defined cases: a null or blank text has neutral features; a null host or path is a site of its own; several labels
of one document count as their mean, null labels not at all; without labels of both kinds the evidence is the share of good labels (one
half without any); repeated rows are all scored; an empty table gives no rows. A document is kept at a
posterior of THRESHOLD or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import aside, mark_hot, put_back, slices, split_join, stored
from tidemark.llm.words import raw, words

#: The bound of the sample that the model is fitted on.
FIT_ROWS = 20_000
THRESHOLD = 0.5
#: Log odds beyond this say no more.
MOST_ODDS = 12.0

_KINDS = np.zeros((5, 256), dtype=bool)
_KINDS[0, 65:91] = True  # capitals
_KINDS[1, 48:58] = True  # digits
_KINDS[2, [ord(c) for c in ".,;:'\"()-?"]] = True  # punctuation of prose
_KINDS[3, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?"]] = True  # other symbols
_KINDS[4, 10] = True  # line ends
FEATURES = 5 + 3 + 2


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES numbers for each text."""
    data, offsets = raw(column)
    size = np.diff(offsets)
    out = np.zeros((len(size), FEATURES))
    some = np.maximum(size, 1)
    for k in range(5):
        total = np.concatenate([[0], np.cumsum(_KINDS[k][data], dtype=np.int64)])
        out[:, k] = np.diff(total[offsets]) / some
    spans = words(column, lower=True)
    h = spans.hashes()
    n = np.bincount(spans.row, minlength=spans.rows)
    for lag in (1, 2, 3):
        again = np.zeros(len(h), dtype=bool)
        again[lag:] = (h[lag:] == h[:-lag]) & (spans.row[lag:] == spans.row[:-lag])
        out[:, 4 + lag] = np.bincount(spans.row[again], minlength=spans.rows) / np.maximum(n, 1)
    out[:, :8] = np.log1p(100 * out[:, :8])
    out[:, 8] = np.log1p(np.where(n > 0, size / np.maximum(n, 1), 0))
    out[:, 9] = np.log1p(n)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic model, by Newton steps on scaled columns."""
    good = y.sum()
    if len(y) == 0 or good in (0, len(y)):
        share = (good + 1) / (len(y) + 2) if len(y) else 0.5
        return np.zeros(x.shape[1]), float(np.log(share / (1 - share)))
    mean, scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """The evidence model from docs(doc_id, text) and labels(doc_id, quality)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # at most rows: broadcast and collected
    rows_ = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "y", F.lit(0).alias("at"))
    schema = "y double, x array<double>"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches, "text", 4 << 20):
            x = features(t["text"].combine_chunks())
            yield pa.RecordBatch.from_pydict({"y": t["y"].combine_chunks(), "x": pa.array(list(x), pa.list_(pa.float64()))})

    got = rows_.mapInArrow(measure, schema).orderBy("y", "x").limit(2 * rows).toArrow()
    if not got.num_rows:
        return fit_logistic(np.zeros((0, FEATURES)), np.zeros(0))
    x = got["x"].combine_chunks().values.to_numpy().reshape(-1, FEATURES)
    return fit_logistic(x, (got["y"].to_numpy() >= 0.5).astype(float))


def with_evidence(docs: DataFrame, model: tuple[np.ndarray, float], column: str = "evidence") -> DataFrame:
    """docs with the model's log odds of each text."""
    weights, bias = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches, "text", 4 << 20):
            odds = np.clip(features(t["text"].combine_chunks()) @ weights + bias, -MOST_ODDS, MOST_ODDS)
            yield from t.append_column(column, pa.array(odds, pa.float64())).combine_chunks().to_batches()

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(level: DataFrame, share: str, n: str, centre: str, name: str) -> DataFrame:
    """One row: how many pseudo-documents the level's prior is worth, by the method of moments.

    The spread of the shares beyond what their sizes explain; without any, the prior is worth much.
    """
    within = F.col(centre) * (1 - F.col(centre))
    spread = F.sum(F.col(n) * ((F.col(share) - F.col(centre)) ** 2 - within / F.col(n))) / F.sum(n)
    even = F.sum(F.col(n) * within) / F.sum(n)
    strength = F.when(spread > even / 10_000, even / spread - 1).otherwise(F.lit(10_000.0))
    return level.agg(F.greatest(strength, F.lit(1.0)).alias(name))


def site_posteriors(evidence: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """(host, path, n, good, host_posterior, path_strength, global_share) from rows (host, path, evidence).

    good sums the documents' own probabilities.
    """
    p = 1 / (1 + F.exp(-F.col("evidence")))
    paths = evidence.groupBy(host, path).agg(F.sum(p).alias("good"), F.count("*").alias("n"))
    hosts = paths.groupBy(host).agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"))
    # the smallest share that makes finite log odds
    everything = hosts.agg(((F.sum("host_good") + 0.5) / (F.sum("host_n") + 1)).alias("global_share"))
    hosts = hosts.crossJoin(F.broadcast(everything)).withColumn("host_share", F.col("host_good") / F.col("host_n"))
    hosts = hosts.crossJoin(F.broadcast(_strength(hosts, "host_share", "host_n", "global_share", "host_strength")))
    hosts = hosts.withColumn("host_posterior", (F.col("host_strength") * F.col("global_share") + F.col("host_good")) / (F.col("host_strength") + F.col("host_n")))
    h = hosts.select(F.col(host).alias("_host"), "host_posterior", "global_share")
    paths = paths.join(h, F.col(host).eqNullSafe(F.col("_host"))).drop("_host").withColumn("path_share", F.col("good") / F.col("n"))
    return paths.crossJoin(F.broadcast(_strength(paths, "path_share", "n", "host_posterior", "path_strength"))).drop("path_share")


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = THRESHOLD) -> DataFrame:
    """docs with _evidence, _host_posterior, _path_posterior, _posterior and _keep; needs doc_id and text."""
    model = fit(docs, labels)
    sites = docs.select("text", host.alias("host"), path.alias("path"))
    sites = site_posteriors(with_evidence(sites, model).select("host", "path", "evidence"))
    sites = sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "good", "host_posterior", "path_strength", "global_share")
    sites = sites.select("_host", "_path", *[F.col(c).alias(f"_{c}") for c in ("n", "good", "host_posterior", "path_strength", "global_share")])
    sites = stored(mark_hot(sites, "_n"), "sites")  # written, so that Spark knows its size
    columns = docs.columns
    scored = with_evidence(docs.select("text", host.alias("_host"), path.alias("_path"), aside(docs, "text")), model, "_evidence")
    met = split_join(scored, sites, ["_host", "_path"])
    own = 1 / (1 + F.exp(-F.col("_evidence")))
    others = (F.col("_path_strength") * F.col("_host_posterior") + F.col("_good") - own) / (F.col("_path_strength") + F.col("_n") - 1)
    met = met.withColumn("_path_posterior", F.least(F.greatest(others, F.lit(1e-6)), F.lit(1 - 1e-6)))
    odds = F.col("_evidence") + _odds(F.col("_path_posterior")) - _odds(F.col("_global_share"))
    met = met.withColumn("_posterior", 1 / (1 + F.exp(-odds))).withColumn("_keep", F.col("_posterior") >= threshold)
    return met.select(*put_back(columns, "text"), "_evidence", "_host_posterior", "_path_posterior", "_posterior", "_keep")
