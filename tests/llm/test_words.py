"""Words, shingles and packing against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import word_list
from tidemark.llm.common import pack, slices, unpack
from tidemark.llm.words import mix, shingles, words

TEXT = st.text(alphabet="aBz é日\t\n\x0b\x1c 😀.", max_size=40)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_the_runs_of_other_characters(texts):
    spans = words(pa.array(texts, pa.string()))
    found = [[] for _ in texts]
    for row, piece in zip(spans.row.tolist(), spans.texts(np.arange(len(spans.start))), strict=True):
        found[row].append(piece.decode())
    assert found == [word_list(t) for t in texts]
    assert len({*zip(spans.texts(np.arange(len(spans.start))), spans.hashes().tolist(), strict=True)}) == len(set(spans.hashes().tolist()))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6))
def test_shingles_are_distinct_sequences_of_words(texts):
    s, at = shingles(pa.array(texts, pa.string()), size=2)
    expected = []
    for t in texts:
        w = word_list("".join(c.lower() if c.isascii() else c for c in t or ""))
        expected.append({tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set())
    assert np.diff(at).tolist() == [len(e) for e in expected]
    hashes = [set(s[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    for i, e in enumerate(expected):
        for j, f in enumerate(expected):
            assert len(e & f) == len(hashes[i] & hashes[j])


def test_hashes_do_not_depend_on_the_slice():
    text = ["one two three four five six seven"] * 3
    alone = shingles(pa.array(text[:1]))[0].tolist()
    s, at = shingles(pa.array(["x y z", *text]))
    assert s[at[2]:at[3]].tolist() == alone


def test_slices_keep_all_rows_and_bound_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (3, 0, 50, 2, 2, 9)]})
    got = [t["text"].to_pylist() for t in slices([batch, batch], "text", 10)]
    assert sum(got, []) == batch.column(0).to_pylist() * 2
    assert all(len(t) == 1 or sum(map(len, t)) <= 10 for t in got)


def test_pack_round_trip_and_mix_is_one_to_one():
    for x in (np.arange(1000, dtype=np.uint32), np.zeros(0, np.uint32)):
        assert unpack(pack(x), np.uint32).tolist() == x.tolist()
    assert len(np.unique(mix(np.arange(100_000, dtype=np.uint64), 3))) == 100_000
