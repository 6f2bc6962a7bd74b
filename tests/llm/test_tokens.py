"""Token counts and packing against the tokenizers themselves."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparktrips.llm import packing, token_counts

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
POOL = [*"abcXYZ 0129'stlre.,!?-_#ÀéßñçÖ<|>\n\t\x1c\x85\u00a0\u0301İſKﬁǅ中文абвΣςé²½Ⅷ😀\u200d\x00ẞ  \n\n",
        "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "'re", "  ", "\n\n"]


def random_texts(n: int) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_words_count_as_the_tokenizer_counts_whole_texts():
    tokenizer, counter = Tokenizer.from_file(WORDS), token_counts.WordCounter(WORDS, cached=50)
    for t in random_texts(3000):
        assert counter.count(t.encode()) == len(tokenizer.encode(t, add_special_tokens=False).ids), repr(t)


def test_ids_are_the_tokenizers():
    tokenizer, encoder = Tokenizer.from_file(BYTES), packing.TextEncoder(BYTES, cached=50)
    for t in random_texts(3000):
        assert np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("table", ["documents", "awkward", "nothing"])
def test_token_counts(request, table):
    docs, tokenizer = request.getfixturevalue(table), Tokenizer.from_file(WORDS)
    expected = []
    for r in docs.select("doc_id", "text").collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        expected.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    got = [tuple(r) for r in token_counts.count_tokens(docs, WORDS).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_frequent_words_survive_the_merge(documents, texts):
    from collections import Counter
    counts = Counter(w for t in texts.values() for w in t.encode().split())
    found = token_counts.frequent_words(documents.repartition(7), keep=64)
    total = sum(counts.values())
    assert len(found) <= 64 and {w for w, c in counts.items() if c > total * 3 / 64} <= set(found)


@pytest.mark.parametrize("table", ["documents", "awkward", "nothing"])
def test_packing_is_a_round_trip(request, table):
    docs, tokenizer = request.getfixturevalue(table), Tokenizer.from_file(BYTES)
    pieces = packing.pack_documents(docs, BYTES, keep_ids=True).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
        sequences[p.sequence_id].append(p)
        documents[p.doc_id, p.doc_tokens].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    expected = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        expected[r.doc_id, len(ids)].append(ids)
    assert set(expected) == set(documents)
    for key, wanted in expected.items():
        by_start = sorted(documents[key], key=lambda p: p.start)
        if len(wanted) == 1:
            assert [i for p in by_start for i in p.ids] == wanted[0]
        assert sum(p.length for p in by_start) == sum(map(len, wanted))


@pytest.mark.parametrize("lengths", [[1], [2048, 4096, 1], [317] * 3000, [1100] * 500, [2047] * 50 + [1] * 10])
def test_pack_covers_every_token_without_padding(lengths):
    sequences = packing.pack(lengths)
    at = [0] * len(lengths)
    for doc, start, n in sorted(p for s in sequences for p in s):
        assert at[doc] == start and n > 0
        at[doc] += n
    assert at == lengths
    totals = [sum(p[2] for p in s) for s in sequences]
    assert all(t == 2048 or t & (t - 1) == 0 for t in totals) and sum(t < 2048 for t in totals) <= 11


def test_nonnegative_least_squares_is_optimal():
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 30)), rng.random(12) * 50
    x = packing.nonnegative_least_squares(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-5 and abs(gradient[x > 0]).max() < 1e-5
