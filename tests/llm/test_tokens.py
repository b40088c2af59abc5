"""Encoding, packing and the id file against the tokenizers' own libraries."""

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starsift.llm import packing, queries, simple8b
from starsift.llm.chunks import Ids
from starsift.llm.pieces import encode_decode
from starsift.llm.shared import folder


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def sentencepiece():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_sentencepiece_query_equals_library(spark, sf_dir, texts):
    model, got = sentencepiece(), brute.rows(queries.QUERIES["op2_sentencepiece"](spark, sf_dir), "doc_id")
    assert len(got) == len(texts)
    for i, t in texts:
        ids = model.encode(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert got[i].decoded_sha256 == brute.sha(model.decode(ids))


def test_sentencepiece_awkward_rows(spark):
    model, got = sentencepiece(), brute.rows(encode_decode(brute.awkward(spark), public_tokenizers.path("piece_bpe_32k.model")), "doc_id")
    for i, t, *_ in brute.AWKWARD:
        ids = model.encode(t or "")
        assert (got[i].ids, got[i].decoded) == (ids, model.decode(ids) if ids else ""), i
    assert encode_decode(brute.empty(spark), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("name, chunking", [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "words")])
def test_special_tokens_as_the_plain_call_finds_them(name, chunking):
    """Texts full of special strings, whole and broken, with white space and accents on both sides."""
    pick, ids = np.random.default_rng(5), library(name)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "<|", "|>", " ", "  ", "\n", "\t", "a", "Bc", "e\u0301", "\u0301", "é", "7", "'s", "\x1c", "\x85", "漢", "<|ENDOFTEXT|>"]
    texts = ["".join(pick.choice(parts, pick.integers(0, 14))) for _ in range(6000)]
    got = Ids(public_tokenizers.path(name), chunking)(texts)
    for t, b in zip(texts, got):
        assert np.frombuffer(b, "<u4").tolist() == ids(t), t
    assert sum("<|endoftext|>" in t for t in texts) > 1000


def check_packing(got, docs, ids_of, capacity):
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in docs:
        ids = ids_of(t) + [0]
        own = sorted(pieces.pop(i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert own[0].start == 0 and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == brute.crc(ids[r.start : r.start + r.length])
        assert len(own) == 1 or (len(ids) > capacity and all(r.length == capacity for r in own[1:]))
    assert not pieces
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_query(spark, sf_dir, texts):
    got = queries.QUERIES["op6_packing"](spark, sf_dir).collect()
    used = check_packing(got, texts, library("byte_bpe_50k.json"), 2048)
    assert used <= packing.lower_bound(np.bincount([r.length for r in got], minlength=2049)) + 1


def test_packing_awkward_rows_and_exchange(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(brute.awkward(spark), path).collect()
    check_packing(got, brute.AWKWARD, library("byte_bpe_50k.json"), 2048)
    assert packing.pack_documents(brute.empty(spark), path).count() == 0
    sizes = np.random.default_rng(1).integers(1, 100, 900)
    frame = spark.createDataFrame([(i % 800, int(s)) for i, s in enumerate(sizes)], "doc_id long, length long").withColumn("piece", F.lit(0))
    packed = packing.pack(frame, 100, group_size=30).collect()
    assert len(packed) == 900 and sorted(r.length for r in packed) == sorted(sizes.tolist())
    loads = {}
    for r in packed:
        loads[r.sequence_id] = loads.get(r.sequence_id, 0) + r.length
    assert max(loads.values()) <= 100 and len(loads) <= 1.05 * packing.lower_bound(np.bincount(sizes, minlength=101))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_holds(sizes):
    """The bound never exceeds the best packing, found by trying all assignments."""
    sizes = sorted(sizes, reverse=True)

    def fits(k, i=0, loads=()):
        if i == len(sizes):
            return True
        loads = loads or (0,) * k
        return any(fits(k, i + 1, loads[:b] + (loads[b] + sizes[i],) + loads[b + 1 :]) for b in range(k) if loads[b] + sizes[i] <= 20 and loads[b] not in loads[:b])

    best = next(k for k in range(1, len(sizes) + 1) if fits(k))
    bins, offsets, _ = packing.best_fit_decreasing(np.array(sizes), 20)
    assert packing.lower_bound(np.bincount(sizes, minlength=21)) <= best <= bins.max() + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 0), st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 12))
def test_words_round_trip(values, times):
    v = np.array(values * times, np.uint64)
    words, firsts, escapes = simple8b.encode(v)
    assert (simple8b.decode(words, firsts, escapes, len(v)) == v).all()
    data = simple8b.to_shard([v, v[:3], v[:0]])
    back, at = simple8b.from_shard(data)
    assert at.tolist() == [0, len(v), len(v) + len(v[:3]), len(v) + len(v[:3])] and (back[: len(v)] == v).all()


def check_file(got, docs, ids_of):
    start = 0
    for i, t, *_ in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = ids_of(t) + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), brute.crc(ids)), i
        start += len(ids)


def test_token_file_query(spark, sf_dir, texts):
    check_file(brute.rows(queries.QUERIES["op7_token_file"](spark, sf_dir), "doc_id"), texts, library("word_bpe_49k.json"))


def test_token_file_awkward_rows(spark, monkeypatch):
    for docs, n in ((brute.awkward(spark), len(brute.AWKWARD)), (brute.empty(spark), 0)):
        place = folder(spark, "ids")
        simple8b.write_ids(docs, place, public_tokenizers.path("word_bpe_49k.json"), 2)
        got = brute.rows(simple8b.read_ids(spark, place), "doc_id")
        assert len(got) == n
        if n:
            check_file(got, brute.AWKWARD, library("word_bpe_49k.json"))
            assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 2 for r in got.values())
