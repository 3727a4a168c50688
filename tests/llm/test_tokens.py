"""SentencePiece codec and token counts against the public libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from productlens.llm import queries, sentencepiece_codec, token_counts
from productlens.llm.merge_rounds import PairTable, merge_rounds
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(BYTES)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []


def noise(n, seed):
    pick = random.Random(seed)
    alphabet = " \n\t\r" + "▁" * 2 + "   aabbcthein--=.'s0193é中😀\x00\x1c\xa0​"
    return ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 120))) for _ in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n▁aeth"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_codec_equals_library(texts):
    own, lib = sentencepiece_codec.codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, counts = own.encode(pa.array(texts, pa.string()))
    assert split(ids, counts) == [lib.encode(t) for t in texts]
    assert own.decode(ids, counts) == [lib.decode(lib.encode(t)) for t in texts]


def test_codec_on_noise_and_runs(pieces):
    own = sentencepiece_codec.codec(PIECES)
    texts = noise(500, 1) + [" " * n + "x" + " " * (n + 3) for n in range(70)] + ["ab" * 400, "a" * 999, "\n" * 50]
    ids, counts = own.encode(pa.array(texts))
    assert split(ids, counts) == pieces.encode(texts)


def test_token_counts_equal_library(byte_bpe):
    own = token_counts.counter(BYTES)
    texts = noise(500, 2) + ["<|endoftext|>" * 3, "a <|endoftext|> b", "<|endoftext", "don't we'll x's"]
    texts += [f"a{c} {c}b{c}" for c in map(chr, range(0x3100))]
    assert own.counts(texts).tolist() == [len(e.ids) for e in byte_bpe.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proved(byte_bpe):
    own = token_counts.counter(BYTES)
    assert len(own.whole) > 40_000
    for s in own.whole[::997]:
        if len(own.pattern.findall(s)) == 1:
            assert len(byte_bpe.encode(s, add_special_tokens=False).ids) == 1


def one_by_one(word, rank_of, product):
    """Plain merging: lowest rank, leftmost, one at a time."""
    word = list(word)
    while True:
        found = [(rank_of[p], i) for i, p in enumerate(zip(word, word[1:])) if p in rank_of]
        if not found:
            return word
        rank, i = min(found)
        word[i: i + 2] = [product[rank]]


def test_merge_rounds_equal_plain_merging():
    rng = np.random.default_rng(3)
    for _ in range(60):  # random tables, most of which let a product merge before its parts' other occurrences
        symbols, rules = 3, {}
        product = []
        for rank in range(12):
            pair = tuple(rng.integers(0, symbols, 2).tolist())
            if pair not in rules:
                rules[pair] = len(product)
                product.append(symbols)
                symbols += 1
        mix = rng.permutation(len(product))  # ranks not in the order of creation
        rank_of = {p: int(mix[r]) for p, r in rules.items()}
        by_rank = [0] * len(product)
        for p, r in rules.items():
            by_rank[mix[r]] = product[r]
        table = PairTable([p[0] for p in rank_of], [p[1] for p in rank_of], list(rank_of.values()), by_rank, symbols)
        words = [rng.integers(0, 3, rng.integers(0, 14)).tolist() for _ in range(40)]
        out, counts = merge_rounds(np.array(sum(words, [])), np.array([len(w) for w in words]), table)
        assert split(out, counts) == [one_by_one(w, rank_of, by_rank) for w in words]


def test_queries_on_odd_rows(odd_docs, pieces, byte_bpe):
    got = queries.sentencepiece_digest(odd_docs).collect()
    want = []
    for i, t in ODD:
        ids = pieces.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(pieces.decode(ids).encode()).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(want)
    counts = Counter(map(tuple, token_counts.count_tokens(odd_docs, BYTES).collect()))
    assert counts == Counter((i, len((t or "").encode()), len(byte_bpe.encode(t or "", add_special_tokens=False).ids))
                             for i, t in ODD)


def test_round_trip_and_empty_table(make_docs, odd_docs):
    ids = sentencepiece_codec.encode(odd_docs, PIECES)
    texts = Counter(map(tuple, sentencepiece_codec.decode(ids, PIECES).collect()))
    assert texts == Counter((i, (t or "").replace("▁", " ")) for i, t in ODD)
    empty = make_docs([])
    assert sentencepiece_codec.encode(empty, PIECES).count() == token_counts.count_tokens(empty, BYTES).count() == 0


def test_registered_queries(spark, pieces, byte_bpe):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF_SMALL, "documents").collect()}
    op1 = {r.doc_id: r for r in queries.op1_sentencepiece(spark, SF_SMALL).collect()}
    op7 = {r.doc_id: r for r in queries.op7_token_counts(spark, SF_SMALL).collect()}
    assert op1.keys() == op7.keys() == docs.keys()
    for i, t in docs.items():
        ids = pieces.encode(t)
        assert op1[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        n = len(byte_bpe.encode(t, add_special_tokens=False).ids)
        assert (op7[i].n_tokens, op7[i].over_limit) == (n, n > 512)
