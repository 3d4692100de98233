"""Bounded-space packing: an exact round trip of all tokens, little padding, bounded open windows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyfold.llm import packing
from tallyfold.llm.packing import Packer, TokenIds, pack, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(rows, want, size):
    """``want``: per doc_id its ids. Every id is in one piece; sequences have no gap."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.length > 0
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            ids = want[doc][at: at + r.length]
            assert r.start == at and r.doc_tokens == len(want[doc])
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += r.length
        assert at == len(want[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence) * size - sum(r.length for r in rows)


def test_query_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: whole(tokenizer, r.text) for r in docs.collect()}
    rows = packing.report(docs).collect()
    padding = check_pieces(rows, want, 4096)
    assert padding < 4096 + 32 * (len({r.sequence_id for r in rows}))


def test_many_partitions_small_windows(spark, tokenizer):
    pick = random.Random(3)
    texts = [" ".join(pick.choice(("word", "isn't", "ÀÉ", "你好", "x1y2", "...!?", "<|endoftext|>")) for _ in range(pick.choice((0, 1, 5, 40, 300))))
             for _ in range(400)] + [None, "", " \t\n\x0b\x0c\r ", "\x1c \x1d\x85 \xa0a", "é é ́x", "a" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(40)
    want = {i: whole(tokenizer, t) for i, t in enumerate(texts)}
    packed = pack(docs, size=64, open_windows=4, max_gap=3)
    rows = packed.collect()
    padding = check_pieces(rows, want, 64)
    assert padding <= 3 * len({r.sequence_id for r in rows}) + 64
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.start):
        by_doc.setdefault(r.doc_id, []).extend(r.ids)
    assert by_doc == want


def test_words_give_what_whole_texts_give(tokenizer):
    texts = [b"It's a TEST, isn't it? 1234\x0bfoo\x1cbar", b"...Marks!? (beside) <|endoftext|> <|x|> 'tis don't's o'clock's -- 'S", "Straße, ÇA! ŁÓDŹ İx ŉx ſx ×2 à̀ é.".encode(), "Ünïcodé İstanbul ΣΑΣ ΟΔΟΣ. ﬁ 你好 🙂🙂\x85x y".encode(), b"", b"<|startoftext|>a <|endoftext|>"]
    by_word, by_text = TokenIds(vocabulary()), TokenIds(vocabulary(), by_word=False)
    assert by_word.of(texts) == by_text.of(texts) == [np.array(whole(tokenizer, t.decode()), "<u4").tobytes() for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch):
    texts = [b"one two three four", b"five six one two", b"three seven"]
    want = TokenIds(vocabulary()).of(texts)
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 300)
    ids = TokenIds(vocabulary())
    assert [ids.of([t])[0] for t in texts] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 5), st.integers(0, 4))
def test_open_windows_are_bounded_and_best_fit(lengths, most, gap):
    packer, size, out = Packer(16, most, gap), 16, []
    for doc, n in enumerate(lengths):
        free = sorted(size - w.used for w in packer.open.values())
        done = list(packer.add((doc, 0, bytes(4 * n), n)))
        out += done
        assert len(packer.open) <= most
        assert all(size - w.used <= gap for w in done)
        fits = [f for f in free if f >= n]
        if n < size and fits:  # a piece that fits goes, uncut, where it leaves least
            left = sorted([*free[:free.index(fits[0])], *free[free.index(fits[0]) + 1:], *([fits[0] - n] if fits[0] > n else [])])
            assert sorted(size - w.used for w in packer.open.values()) == left
    out += packer.rest()
    got = {}
    for w in out:
        assert [p[4] for p in w.pieces] == list(np.cumsum([0, *[len(p[2]) // 4 for p in w.pieces]])[:-1])
        for doc, start, ids, _, _ in w.pieces:
            got.setdefault(doc, []).append((start, len(ids) // 4))
    for doc, n in enumerate(lengths):
        pieces = sorted(got[doc])
        assert [s for s, _ in pieces] == list(np.cumsum([0, *[k for _, k in pieces]])[:-1]) and sum(k for _, k in pieces) == n


def test_edge_rows(spark, tokenizer):
    rows = [(1, "same text"), (1, "same text"), (None, "x"), (2, None), (3, "")]
    got = pack(spark.createDataFrame([(*r, 9, "s") for r in rows], "doc_id bigint, text string, start int, ids string")).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 2), (1, 3), (1, 3), (2, 1), (3, 1)]
    assert len({r.sequence_id for r in got}) == 1
    assert pack(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
