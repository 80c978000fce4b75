"""Aligned tokens and their corpus counts against a plain version on both libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import crosswalk

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["it's 'tis a''s DON'T we'll", "<|endoftext|> there <s> </s><unk>", "é Éa 'é's", "a b c\x85d\x1cx", "ΣΑΣ İstanbul K ſ", "  lead and trail  ",
       "\n\n a\n b\t\tc \n", "1234abc12.5--x_y", "日本語テキスト、。😀😀a", "a\x0bb\x0cc", "▁ literal ▁", " " * 300, "x" * 400, "ab" * 100, " ", "a ", "\0", "\xa0 \xa0 b　 c", "a  b   c", "the end.", "<0x0A> \r\n x"]


def table(token):
    own = [b for b in range(256) if chr(b).isprintable() and b != 32 and (b < 127 or b > 160)]
    back = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    return bytes(back[c] for c in token)


def brute(rows):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    docs, held = [], defaultdict(int)
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        ids = [t.encode(whole.decode(), add_special_tokens=False).ids, sp.encode(text or "")]
        parts = [[table(t.id_to_token(i)) for i in ids[0]], [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        if not text or any(b"".join(p) != whole for p in parts):
            docs.append((doc, 0, 0, Counter(), ""))
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links, groups, lo = Counter(), [], 0
        for cut in cuts:
            a, b = ([i for i, e in zip(x, y, strict=True) if lo < e <= cut] for x, y in zip(ids, ends, strict=True))
            links.update((i, j) for i in a for j in b)
            groups.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
            lo = cut
        for pair in links:
            held[pair] += 1
        docs.append((doc, len(ids[0]), len(ids[1]), links, ";".join(groups)))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return sorted((str(d), a, b, g.count("|"), sum(k.values()), sum(n for p, n in k.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in k.items()),
                   hashlib.sha256(g.encode()).hexdigest() if g else "") for d, a, b, k, g in docs)


def run(df, **sizes):
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r.doc_id), *[r[c] for c in columns]) for r in crosswalk.align_corpus(df, "text", ["doc_id"], A, B, **sizes).collect())


def given(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]


def test_odd_texts_nulls_and_repeats(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(100 + i, x) for i, x in enumerate(ODD)] + [(None, "the end."), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, path string, run int").repartition(3)
    assert run(df) == brute(rows)


def test_given_texts_in_one_merge_and_in_rounds(spark):
    rows = given(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute(rows)
    assert run(df) == expected
    assert run(df, run_records=20_000, fan=3) == expected


def test_nothing(spark, nothing):
    assert run(nothing) == []


def test_random_texts_cut_like_whole_ones():
    rng = random.Random(3)
    alphabet = ["a", "The", " ", "  ", "\n", "é", "日", "😀", "'s", ".", "12", "\xa0", " ", "\x1c", "\x85", "ing", "▁", "\t", "<|", "K"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 14))) for _ in range(4000)]
    found = crosswalk.align(pa.array(texts), A, B)
    t = Tokenizer.from_file(A)
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    for text, (n_a, n_b, *_), digest in zip(texts, found.stats.tolist(), found.digest, strict=True):
        if "▁" in text:
            assert (n_a, n_b, digest) == (0, 0, "")
        else:
            assert (n_a, n_b) == (len(t.encode(" " + text).ids), len(sp.encode(text))), repr(text)


def test_a_wide_group_makes_its_pairs_in_parts():
    a, b = np.arange(300) % 50, np.arange(200) % 40
    zeros = np.zeros(300, np.int64)
    parts = list(crosswalk.linked(zeros, a, zeros[:200], b, 1, 15, most=100))
    pair, n = crosswalk.summed(np.concatenate([p for _, p, _ in parts]), np.concatenate([x for _, _, x in parts]))
    expected = Counter((i << 15) | j for i in a.tolist() for j in b.tolist())
    assert len(parts) > 10 and dict(zip(pair.tolist(), n.tolist(), strict=True)) == expected
