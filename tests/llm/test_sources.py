"""Mixing and WARC conversion."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import word_list
from tidemark.llm import mixing, warc


def wanted(sizes, weights, share, most):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while open_ := [s for s in names if s not in full]:
        rate = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if rate * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rate * weight[s] for s in names}
        full |= over
    return {s: most * sizes[s] for s in names}


@pytest.fixture
def sources(spark):
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(1 + i * 7 % 50)), ["b", "a", None, "c", "a", "a", "é"][i % 7]) for i in range(300)]
    rows += [(900, None, "b"), (901, " ", "empty"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (None, "no id here", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_its_targets(sources, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 20)
    got = mixing.Mix(sources, block_words=4, shard_slots=50).taken().collect()
    docs = sources.collect()
    assert len(got) == len(docs)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), len(word_list(r.text))) for r in docs)
    sizes = Counter()
    for r in docs:
        sizes[r.source] += len(word_list(r.text))
    target = wanted(sizes, (5, 2, 1), 1.5, 2.0)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, abs=max(8, 0.02 * t))


def test_mix_agrees_when_run_again(sources):
    def take(df):
        return sorted((str(r.doc_id), r.taken) for r in mixing.Mix(df, block_words=4).taken().collect())

    assert take(sources) == take(sources.repartition(5))


def test_rows_hold_the_words_taken(sources):
    mix = mixing.Mix(sources.withColumn("extra", F.lit(1)), block_words=4)
    rows = mix.rows(sources.withColumn("extra", F.lit(1))).collect()
    text = {(r.doc_id, r.source): word_list(r.text) for r in sources.collect()}
    found = Counter()
    for r in rows:
        words = word_list(r.text)
        at = iter(text[r.doc_id, r.source])
        assert all(w in at for w in words) and r.extra == 1  # a subsequence
        found[str(r.doc_id), r.source] += len(words)
    taken = Counter()
    for r in mix.taken().collect():
        taken[str(r.doc_id), r.source] += r.taken
    assert +found == +taken


def test_copies_under_several_sources_keep_their_words(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text, s) for s in "abc"] + [(i, "some other words here", s) for i in range(5, 9) for s in "ab"], "doc_id long, text string, source string")
    for df in (docs, docs.orderBy(F.rand(3)), docs.orderBy(F.rand(8))):
        mix = mixing.Mix(df, block_words=4)
        found = Counter()
        for r in mix.rows(df).collect():
            found[r.doc_id, r.source] += len(word_list(r.text))
        assert +found == +Counter({(r.doc_id, r.source): r.taken for r in mix.taken().collect()})


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    assert sorted(mixing.permute(np.arange(n), n, 5).tolist()) == list(range(n))


def test_mix_of_nothing(nothing):
    mix = mixing.Mix(nothing)
    assert mix.taken().collect() == [] and mix.rows(nothing).collect() == []


PAGES = [(1, "http://a.example/x y", "<p>" + "a" * 200), (2, None, "<p>" + "a" * 200), (3, "http://b.example/", "short"), (4, "http://b.example/", "short"),
         (5, "", None), (6, "http://c.example/é", "é\r\n\r\nWARC/1.1\r\n" * 20), (7, "u", "<p>" + "a" * 200), (7, "u", "<p>" + "a" * 200), (None, "n", "b" * 150), (8, "m", "b" * 150), (9, "x", "z" * 300_000)]


def test_archives_give_back_the_pages(spark):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string").coalesce(2)
    got = warc.read_warc(spark, warc.archive(df, "page_id", "url", "html")).collect()
    expected = Counter()
    for i, _, h in PAGES:
        body = (h or "").encode()
        equal = [j for j, _, g in PAGES if j is not None and (g or "").encode() == body] if len(body) >= 100 else []
        expected[i, len(body), hashlib.sha256(body).hexdigest()] += 1
        first = min(equal, default=None)
        for r in got:
            if r.key == i and r.payload_digest == hashlib.sha256(body).hexdigest() and i not in (7,):
                assert (r.record_type, r.refers_to) == (("revisit", first) if first not in (None, i) else ("response", None)), r
    assert Counter((r.key, r.payload_bytes, r.payload_digest) for r in got) == expected
    assert len({r.record_id for r in got}) == len(got)
    responses = {r.record_id for r in got if r.record_type == "response"}
    assert all(r.refers_to_id in responses for r in got if r.record_type == "revisit")
    assert [r.url for r in got if r.key == 1] == ["http://a.example/x%20y"] and [r.url for r in got if r.key == 2] == [None]


def test_both_arc_versions_and_damage():
    for version in (1, 2):
        data = warc.arc_header("a.arc", version, "20080101000000") + warc.arc_record(version, "http://x/", "192.0.2.1", "20080102030405", "text/html", b"body\n\nhttp://fake 1 2 3 4\n", "a.arc", 7)
        (_, fields, content), = warc.parse_arc(data)
        assert content == b"body\n\nhttp://fake 1 2 3 4\n" and fields["Archive-date"] == "20080102030405"
        assert ("Checksum" in fields) == (version == 2)
        for bad in (data[:-5], data.replace(b"%d 0 Legacy" % version, b"9 0 Legacy"), data[data.index(b"http://x/"):]):
            with pytest.raises(ValueError):
                list(warc.parse_arc(bad))


def test_archives_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(spark, warc.archive(empty, "page_id", "url", "html")).collect() == []
