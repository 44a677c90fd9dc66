import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import clashing_docs, colliding_words, edge_docs, edge_rows, no_docs  # noqa: F401, F811
from tokenizers import Tokenizer

from strata.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    return P.WordTokens(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x250, exclude_categories=["Cs"])
                        | st.sampled_from("'strevmld  \n") | st.sampled_from("İΣ<|漢"),
                        max_size=40), max_size=6))
def test_ids_are_those_of_the_tokenizer(words, texts):
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in words.encode(texts)] == want


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_colliding_words_keep_their_ids(words, n):
    texts = list(colliding_words(n))
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert want[0] != want[1] and [x.tolist() for x in words.encode(texts)] == want


def test_cache_starts_afresh(words, monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 3)
    texts = ["alpha beta gamma delta", "beta epsilon zeta", "", "alpha"]
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [x.tolist() for x in words.encode(texts)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.integers(50, 90))
def test_groups_stay_within_capacity(sizes, capacity):
    where = P.pack_group(sizes, capacity)
    sums = np.bincount(where, sizes)
    assert len(where) == len(sizes) and sums.max() <= capacity and sums.sum() == sum(sizes)


def test_differencing_cancels_imbalance():
    # the textbook case: two parts of 8 7 6 5 4 differ by 2
    where, sums = P.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(np.bincount(where, [8, 7, 6, 5, 4])) == sorted(sums) == [14, 16]
    _, sums = P.differencing(list(range(1, 201)), 10)
    assert sums.max() - sums.min() <= 2


def test_pieces_hold_every_id_once(spark, clashing_docs, no_docs):
    out = P.pack(clashing_docs, PATH, group=16).toPandas()
    t = Tokenizer.from_file(PATH)
    ids = [np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4") for r in edge_rows()]
    assert out["length"].sum() == sum(map(len, ids))
    want = sorted(zlib.crc32(x.tobytes()) for x in ids if len(x) <= P.GRAIN)
    whole = out[(out["length"] == out["doc_tokens"])]
    assert sorted(whole["ids_crc32"]) == want
    long = next(x for x, r in zip(ids, edge_rows()) if r[0] == 10)
    for r in out[out["doc_id"] == 10].itertuples():
        assert zlib.crc32(long[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert (seq["offset"] == seq["length"].cumsum() - seq["length"]).all()
        assert seq["length"].sum() <= P.CAPACITY
    assert P.pack(no_docs, PATH).count() == 0
