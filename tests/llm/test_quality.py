"""The quality classifier: held-out accuracy, shrinkage, defined cases."""

import math
import random
from collections import defaultdict

import pytest

from tidemark.llm import quality
from tidemark.llm.queries import site


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.classify(docs, labels.where("doc_id % 2 = 0"), *site(docs)).join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "_keep").collect()
    assert len(got) > 100
    assert sum(r._keep == (r.quality == 1) for r in got) >= 0.97 * len(got)
    assert all(r._keep for r in got if r.quality == 1)


def test_posteriors_equal_plain_arithmetic(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None, "c"]), r.choice(["p", "q"]), r.uniform(-6, 6)) for _ in range(200)] + [("lonely", "p", -5.0)]
    got = {(x.host, x.path): x for x in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, evidence double")).collect()}
    paths, hosts = defaultdict(list), defaultdict(list)
    for h, p, e in rows:
        paths[h, p].append(1 / (1 + math.exp(-e)))
        hosts[h].append(1 / (1 + math.exp(-e)))
    everything = [p for ps in hosts.values() for p in ps]
    share = (sum(everything) + 0.5) / (len(everything) + 1)

    def strength(groups):
        """From (values, centre) of each group."""
        n = sum(len(v) for v, _ in groups)
        spread = sum(len(v) * ((sum(v) / len(v) - c) ** 2 - c * (1 - c) / len(v)) for v, c in groups) / n
        even = sum(len(v) * c * (1 - c) for v, c in groups) / n
        return max(1.0, even / spread - 1 if spread > even / 10_000 else 10_000.0)

    m = strength([(v, share) for v in hosts.values()])
    posterior = {h: (m * share + sum(v)) / (m + len(v)) for h, v in hosts.items()}
    k = strength([(v, posterior[h]) for (h, _), v in paths.items()])
    assert got.keys() == paths.keys()
    for (h, p), x in got.items():
        assert x.n == len(paths[h, p]) and x.good == pytest.approx(sum(paths[h, p]))
        assert x.global_share == pytest.approx(share) and x.host_posterior == pytest.approx(posterior[h]) and x.path_strength == pytest.approx(k)
    # a site with one document stays nearer to all than to itself
    assert abs(posterior["lonely"] - share) < abs(posterior["lonely"] - hosts["lonely"][0])


def test_defined_cases(spark, documents, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (6, None)], "doc_id long, quality int")
    for labels in (none, some):
        got = quality.classify(documents, labels, *site(documents))
        assert got.columns[:len(documents.columns)] == documents.columns
        rows = got.collect()
        assert len(rows) == documents.count() and all(r._keep and 0 < r._posterior < 1 for r in rows)
    assert quality.classify(nothing, some, *site(nothing)).collect() == []
