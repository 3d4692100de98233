"""Phrase mining: the trie against a search, hashes that meet, several parts and shards, exact scores."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyfold.llm import collocations as C

WORD = st.sampled_from([b"a", b"b", b"c", b"d", b"e", b"\xff"])


def brute(docs, max_words=3, least=10, percent=50):
    """Rows of (lang, phrase) -> (a, l, r, n, score)."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        words = [w for w in C.words_of(text.encode() if text is not None else None)]
        piece = []
        for w in words:
            if w != C._BREAK:
                piece.append(w.decode())
                continue
            n[lang] += len(piece)
            for size in range(1, max_words + 1):
                for i in range(len(piece) - size + 1):
                    f[lang, tuple(piece[i: i + size])] += 1
            piece = []
    found = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    out = {}
    for (lang, p), a in found.items():
        cuts = [(C.SCALE * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        around = [v for (l2, q), v in found.items() if l2 == lang and len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))]
        if not any(100 * v >= percent * a for v in around):
            out[lang, " ".join(p)] = (a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=1, max_size=4)), max_size=25, unique_by=str),
       st.lists(WORD, max_size=60))
def test_trie_counts_what_a_search_counts(phrases, words):
    trie = C.Trie(pa.table({"lang": pa.array([lang for lang, _ in phrases], pa.string()), "id": pa.array(range(len(phrases)), pa.int64()),
                            "phrase": pa.array([b" ".join(p).decode() for _, p in phrases], pa.string())}))
    numbered = C.Numbered([trie])
    for lang in ("x", "y", "z"):
        total = np.zeros(len(trie.check), np.int64)
        for states in trie.reached(next(numbered.texts(lang, words))):
            np.add.at(total, states, 1)
        got = {int(trie.names[trie.ids[i]]): int(total[i]) for i in np.flatnonzero(total)}
        want = {i: sum(words[j: j + len(p)] == p for j in range(len(words))) for i, (other, p) in enumerate(phrases) if other == lang}
        assert got == {i: v for i, v in want.items() if v}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAé .,\t\n\r\x0b\x0c\x1c;", max_size=12), max_size=6), st.sampled_from([1, 1 << 20]))
def test_blocks_of_numbered_words_are_the_words(texts, size):
    rows = pa.record_batch({"lang": pa.array(["x"] * len(texts), pa.string()), "_utf8": pa.array([t.encode() for t in texts], pa.binary())})
    C.BLOCK_BYTES, before = size, C.BLOCK_BYTES
    blocks = list(C._blocks(C._encode(iter([rows]))))
    C.BLOCK_BYTES = before
    assert [b.vocabulary[i] for b in blocks for i in b.codes] == [w for t in texts for w in C.words_of(t.encode())]
    assert len(blocks) <= (len(texts) if size == 1 else 1)


def test_texts_are_split_once(spark, monkeypatch):
    """Passes after the first take numbered words, and look each distinct word up once per block."""
    texts = C.prepared(frame(spark, [("en", "one two " * 500)]))
    assert texts.columns == ["lang", "vocabulary", "codes"]
    block, = C._blocks(texts.toArrow().to_batches())
    assert sorted(block.vocabulary) == [b"one", b"two", b"\xff"] and len(block.codes) == 1001


def prose(seed, n, vocabulary=60):
    pick = np.random.default_rng(seed)
    words = [f"w{int(v) % vocabulary}" for v in pick.zipf(1.3, n)]
    return "".join(w + (" " if pick.random() < 0.9 else ". ") for w in words)


DOCS = [("en", prose(1, 4000)), ("en", prose(2, 4000).upper()), (None, prose(3, 3000)), ("und", prose(4, 500)), ("de", "gut\tund  gut\x1c " * 12),
        ("fr", None), ("es", ""), ("es", ".,;\n\r"), ("it", "nur neun mal " * 9), ("nl", "twee . woorden " * 15), ("en", prose(1, 4000))]


def frame(spark, docs=DOCS):
    return spark.createDataFrame(docs, "lang string, text string").withColumns({c: F.lit("clash") for c in ("phrase", "h", "id", "f", "k")}).repartition(3)


def got(rows):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in rows}


SMALL = {"PART_HASHES": 20, "SHARD_PHRASES": 50, "FLUSH": 200}


@pytest.mark.parametrize("words, limits", [(2, {}), (3, SMALL), (4, {"PART_HASHES": 20})])
def test_against_brute_force(spark, monkeypatch, limits, words):
    for name, value in limits.items():
        monkeypatch.setattr(C, name, value)
    want = brute(DOCS, words)
    assert got(C.collocations(frame(spark), words).collect()) == want and len(want) > 100


def test_hashes_that_meet_only_add_candidates(spark):
    """A word that stands nowhere, with the hash of one that does, gives candidates that are then counted exactly."""
    texts = C.prepared(frame(spark, [("en", "one two " * 20)]))
    words = C.hashed(spark.createDataFrame([("en", "one", 20), ("en", "two", 20)], "lang string, phrase string, f bigint"), 1)
    met = words.unionByName(words.where("phrase = 'two'").withColumn("phrase", F.lit("ghost")))
    found = C.grown(texts, met, 1, 10)
    assert {r.phrase for r in found.collect()} == {"one two", "two one", "one ghost", "ghost one"}
    counts = {r.phrase: r.a for r in C.counted(texts, found).collect()}
    assert {p: n for p, n in counts.items() if n} == {"one two": 20, "two one": 19}


def test_passes_over_the_texts_do_not_grow_with_the_candidates(spark, monkeypatch):
    """Words, two levels and the counts take a pass each, also when a sieve is too small and there are many shards."""
    kind, passes = type(spark.range(1)), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, *given, **more: (passes.extend(["codes"] * ("codes" in df.columns)), plain(df, *given, **more))[1])
    for limits in ({}, SMALL):
        for name, value in limits.items():
            monkeypatch.setattr(C, name, value)
        passes.clear()
        C.collocations(frame(spark))
        assert len(passes) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=4, max_size=40), st.integers(1, 4), st.sampled_from([4, 1 << 40]))
def test_runs_of_numbers_are_counted(codes, size, words):
    at = np.arange(len(codes) - size + 1)
    columns, n = C._runs(np.array(codes, np.int32), at, size, words)
    got = {tuple(int(c[i]) for c in columns): int(n[i]) for i in range(len(n))}
    assert got == Counter(tuple(codes[i: i + size]) for i in at)


def test_a_sieve_holds_what_was_put_in(monkeypatch):
    h = np.random.default_rng(0).integers(0, 1 << 63, 4000).astype(np.uint64)
    roomy = C.Sieve(2000)
    roomy.put(h[:2000])
    assert roomy.holds(h[:2000]).all() and roomy.holds(h[2000:]).sum() < 100
    monkeypatch.setattr(C, "PART_HASHES", 20)
    full = C.Sieve(2000)
    full.put(h[:2000])
    assert full.holds(h[:2000]).all() and len(full.bits) <= 80


def test_exact_scores_beyond_64_bits(spark):
    a, l, r = 3 * 10**13 + 7, 4 * 10**13 + 9, 9 * 10**13 + 11
    phrases = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, a bigint")
    words = spark.createDataFrame([("en", "x", l), ("en", "y", r)], "lang string, phrase string, f bigint")
    assert C.scored(phrases, words).first().score == C.SCALE * a * a // (l * r)


def test_rank_is_the_same_through_parts(spark):
    rows = [("en", f"p{i}", i % 7, i, i, i, i % 5) for i in range(500)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    top = [r.phrase for r in C.ranked(found, 40).orderBy("rank").collect()]
    assert top == [r[1] for r in sorted(rows, key=lambda r: (-r[6], -r[2], r[1]))][:40]


def test_no_documents(spark):
    assert C.report(spark.createDataFrame([], "lang string, text string")).collect() == []
