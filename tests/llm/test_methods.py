"""The methods inside the operators against brute force, and accuracy where SQL has no say."""

import gzip
import io
import re
from collections import Counter
from html import unescape

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyfold.llm import components as components_module
from tallyfold.llm import jaccard_join, language, licenses, main_text, queries, substring_dedup, warc
from tallyfold.llm.components import components
from tallyfold.llm.decontaminate import Automaton, automata, decontaminate, find_leaks, words_of
from tallyfold.llm.quality_rules import repeated_words
from tallyfold.llm.text import WordHashes, covered, window_hashes
from tallyfold.settings import ARROW_ROWS, BATCH_ROWS

WORDS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25)
SF = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, max_size=5), WORDS, st.integers(1, 5))
def test_automaton_finds_what_a_search_finds(items, words, window):
    named = [(str(i), w) for i, w in enumerate(items) if w]
    spans, found = Automaton(window).build(named).match(words)
    hit, want = set(), set()
    for name, item in named:
        size = min(window, len(item))
        for run in {tuple(item[i: i + size]) for i in range(len(item) - size + 1)}:
            for at in range(len(words) - size + 1):
                if tuple(words[at: at + size]) == run:
                    hit.update(range(at, at + size))
                    want.add(name)
    assert found == want
    assert [p for a, b in spans for p in range(a, b)] == sorted(hit)
    assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_several_automata_give_the_same(spark):
    items = spark.createDataFrame([(i, f"w{i} " * 3 + f"x{i} y{i} z{i} " * 4) for i in range(30)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"start W{i}, w{i} w{i} x{i} y{i} z{i} x{i} y{i} z{i} x{i} end") for i in range(40)], "doc_id bigint, text string")
    assert len(list(automata(items, per_automaton=100))) > 2
    rows = [sorted((r._row.doc_id, r.n_hit, tuple(r["items"])) for r in find_leaks(docs, items, per_automaton=n).collect())
            for n in (100, 200_000)]
    assert rows[0] == rows[1] and sum(r[1] for r in rows[0]) == 30 * 10


def test_passages_are_cut_and_clean_texts_kept(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    text = "Before, as it was. ONE two (three) four-five six seven; eight nine\nten! After: as it was " + "and more words " * 5
    docs = spark.createDataFrame([(1, text, 1), (2, "one two three four five six seven eight nine ten", 2), (3, "Clean  text", 3), (4, None, 4)],
                                 "doc_id bigint, text string, n_chars bigint")
    got = {r.doc_id: (r.text, r.n_chars) for r in decontaminate(docs, items).collect()}
    cut = "Before, as it was. ! After: as it was " + "and more words " * 5
    assert got == {1: (cut, len(cut)), 3: ("Clean  text", 3), 4: (None, 4)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=40))
def test_repeated_words(words):
    runs = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    twice = {r for r, n in Counter(runs).items() if n > 1}
    assert repeated_words(words) == len({p for i, r in enumerate(runs) if r in twice for p in range(i, i + 5)})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(1, 20))
def test_window_hashes_are_equal_for_equal_windows_only(words, size):
    got = window_hashes(WordHashes().of(words), size)
    runs = [tuple(words[i: i + size]) for i in range(len(words) - size + 1)]
    assert len(got) == max(0, len(runs))
    assert len(set(zip(runs, got.tolist()))) == len(set(runs)) == len(set(got.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=6, max_size=60))
def test_anchors(words):
    hashed = WordHashes().of(words)
    half = window_hashes(hashed, 3)
    want = [min(half[i: i + 4].tolist()) for i in range(len(words) - 5)]
    assert substring_dedup.window_anchors(hashed, 6).tolist() == want


def test_covered():
    assert covered(np.array([1, 2, 8]), 3, 10).tolist() == [False, True, True, True, True, False, False, False, True, True]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 101), (101, 102), (50, 50)] + [(200, 200 + i) for i in range(1, 40)]
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == ({i: 1 for i in range(2, 31)} | {101: 100, 102: 100} | {200 + i: 200 for i in range(1, 40)})


def test_large_regions_go_through_pivots_and_cells(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 10**9)
    common = [f"c{i}" for i in range(40)]
    texts = [" ".join([*common[: 30 + i % 8], *[f"u{i // 2}x{j}" for j in range(i % 13)]]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [{tuple(w[k: k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(40))
    for _ in range(40):
        for x in range(40):
            for y in range(x):
                if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                    label[x] = label[y] = min(label[x], label[y])
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == dict(enumerate(label)) and 1 < len(set(label)) < 40


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60))
def test_sketches_differ_in_no_more_bits_than_sets_in_shingles(one, two):
    a, b = (int.from_bytes(jaccard_join.sketch_of(np.array(sorted(s), np.uint64)), "big") for s in (one, two))
    assert (a ^ b).bit_count() <= len(one ^ two)


def test_documents_that_share_little_make_no_pairs(spark, monkeypatch):
    made, pairs = [], jaccard_join.leaf_pairs

    def counted(leaves):
        found = pairs(leaves)
        with monkeypatch.context() as without:
            without.setattr(jaccard_join, "ALIKE", "true")
            made.append((pairs(leaves).count(), found.count()))
        return found

    monkeypatch.setattr(jaccard_join, "leaf_pairs", counted)
    texts = [" ".join([*(f"c{i // 6}x{j}" for j in range(14)), *(f"u{i}x{j}" for j in range(12))]) for i in range(150)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert all(r.doc_id == r.component_id for r in got) and made[0][0] > 0 and made[0][1] == 0


def test_near_copies_join_before_their_cells(spark, monkeypatch):
    """Of a group most of whose pairs are no links of any pivot, cells hold a few pairs and not the square of its size."""
    made, cells = [], jaccard_join.cell_pairs

    def counted(active):
        found = cells(active)
        made.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "cell_pairs", counted)
    pick, texts = np.random.default_rng(5), []
    for i in range(250):
        words = [f"c{j}" for j in range(140)]
        for at in pick.choice(140, int(pick.integers(2, 6)), replace=False):
            words[at] = f"u{i}x{at}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k: k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(250))
    links = [(x, y) for x in range(250) for y in range(x) if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])]
    while any(label[x] != label[y] for x, y in links):
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == dict(enumerate(label)) and sum(made) < 1000


def test_regions_of_repeated_rows_stay_apart(spark):
    def pair(name):
        words = [f"{name}{i}" for i in range(120)]
        return " ".join(words), " ".join([*words[:60], "changed", *words[61:]])

    rows = list(enumerate([*pair("a"), *pair("c")])) * 2
    got = jaccard_join.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, i // 2 * 2) for i, _ in rows)


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "other words stand here now"), (4, None), (4, None),
            (None, "a b c d e f"), (None, "a b c d e f")]
    got = jaccard_join.one_per_group(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, rows[0][1])] * 2 + [(1, rows[0][1]), (3, rows[3][1]), (4, "")]


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES["op9_language_mixture"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_a_text_in_two_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train_fold(docs)
    pick = {r.lang: r.text[:2000] for r in docs.where("length(text) > 2500").dropDuplicates(["lang"]).collect()}
    mixture = dict(model.mixture(language.trigram_counts((pick["en"] + " " + pick["fr"][:1000]).encode())))
    assert set(mixture) == {"en", "fr"} and mixture["en"] > mixture["fr"] > 0.15


def test_main_text_of_all_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.QUERIES["op10_main_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[row.page_id], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", article))
        assert row.text == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page, want", [
    ("<div id='menu'><a href=x>Home</a></div><div class=content><h2>T</h2><p>A long paragraph of text.</p><div class=ad>Buy</div>"
     "<p>More.</p></div><div class='comments'><p>Nice!</p></div><footer>c</footer>", "T\nA long paragraph of text.\nMore."),
    ("<article><header><h1>T</h1></header><p>A&nbsp;b &lt;c&gt;</p><aside>x</aside><form>f</form><section class='comments'>no</section></article>",
     "T\nA b <c>"),
    ("<script>var t='</p><p>x';</script><style>p{}</style><p>a <b>b</b>\n c", "a b c"),
    ("<div class='cookie-notice'>We use cookies</div><div><p>Text</p></div><div role='navigation'><p>links</p></div>", "Text"),
    ("<!-- <p>no</p> --><p>yes</p><p hidden>no</p>", "yes"), ("<p>cut <a href='", "cut"), ("<<<>>>", "<<<>>>"),
])
def test_main_text_of_other_pages(page, want):
    assert main_text.extract(page) == want


@pytest.mark.parametrize("page, want", [
    ("<article><h1><a href=x>Title</a></h1><p>Some text.</p><p><a href=y>Source report</a></p></article>", "Title\nSome text.\nSource report"),
    ("<main><p>Begin.</p><ul>" + "".join(f"<li><a href={i}>Paper {i}</a></li>" for i in range(5)) + "</ul><p>End.</p></main>",
     "\n".join(["Begin.", *(f"Paper {i}" for i in range(5)), "End."])),
    ("<ul><li><a href=m>Menu</a></li></ul><div class=content>" + "<div class=ad>Buy</div>".join(
        f"<section><h2><a href={i}>Head {i}</a></h2><p>{'Long text. ' * n}</p></section>" for i, n in enumerate((40, 1, 2))) + "</div>",
     "\n".join(f"Head {i}\n{('Long text. ' * n).strip()}" for i, n in enumerate((40, 1, 2)))),
    ("<article><p>Text of it.</p></article><article><a href=x>Teaser</a></article>", "Text of it."),
])
def test_regions_extend_to_their_article_or_container(page, want):
    assert main_text.extract(page) == want


def test_licence_wording():
    scan = licenses.Scanner(licenses.NOTICES).scan
    exact, changed = scan(b"x\n(c) 2020. Released under the MIT License. Thanks\nlicence of nobody\n"
                          b"This work is licensed under the GNU General Public License, version 2.")
    assert (exact["licence"], exact["line"], exact["exact"]) == ("MIT", 1, True)
    assert (changed["licence"], changed["exact"], changed["missing"], changed["added"]) == ("GPL-3.0", False, ["3"], ["2"])
    assert scan(None) == scan(b"") == scan(b"no notice, just the word license") == []


@pytest.mark.parametrize("name", sorted(licenses.NOTICES))
def test_notices_inside_long_lines_and_wrapped(name):
    scan, words = licenses.Scanner(licenses.NOTICES).scan, licenses.NOTICES[name].split()
    around = [f"word{i}" for i in range(300)]
    one_line = " ".join(around + words + around)
    wrapped = "/*\n * " + "\n * ".join(" ".join(words[i:i + 4]) for i in range(0, len(words), 4)) + "\n */\nint x;"
    for text, line in ((one_line, 0), (wrapped, 1)):
        found = [x for x in scan(text.encode()) if x["licence"] == name]
        assert [(x["line"], x["exact"]) for x in found] == [(line, True)]


def test_all_notices_of_a_text_are_found():
    scan = licenses.Scanner(licenses.NOTICES).scan
    for gap in ("\n", " ", " and so on "):
        found = scan(gap.join(licenses.NOTICES.values()).encode())
        assert {x["licence"] for x in found if x["exact"]} == set(licenses.NOTICES)
    twice = scan(b"Released under the MIT License. Released under the MIT License.")
    assert [(x["licence"], x["exact"]) for x in twice] == [("MIT", True)] * 2
    assert [x["licence"] for x in scan(b"Licensed under CC BY-SA 4.0.")] == ["CC-BY-SA-4.0"]
    longer, = scan(b"Released under the terms and conditions of the MIT License")
    assert (longer["same_words"], longer["missing"], longer["added"]) == (1, [], ["terms", "and", "conditions", "of", "the"])


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=200), st.integers(1, 300))
def test_chunked_round_trip(text, times):
    payload = text.encode("utf-8", "ignore") * times
    assert warc.unchunked(warc.chunked(payload)) == payload


def test_segmented_record():
    payload = "é".encode() * 100_000
    records = list(warc.records_of(5, "http://x", payload, "d", None))
    assert len(records) == 4
    parsed = list(warc.parse(io.BytesIO(b"".join(r + b"\r\n\r\n" for r in records))))
    assert [f["warc-type"] for f, _ in parsed] == ["response", "continuation", "continuation", "continuation"]
    block = b"".join(b for _, b in parsed)
    assert int(parsed[-1][0]["warc-segment-total-length"]) == len(block)
    assert warc.unchunked(block.partition(b"\r\n\r\n")[2]) == payload


def test_an_archive_with_a_missing_segment_is_incomplete(spark, tmp_path):
    records = list(warc.records_of(5, None, b"x" * 200_000, warc.hashlib.sha256(b"x" * 200_000).hexdigest(), None))
    for name, kept in (("whole", records[::-1]), ("cut", records[:1] + records[2:])):
        (tmp_path / name).mkdir()
        with gzip.open(tmp_path / name / "a.warc.gz", "wb") as out:
            out.write(b"".join(r + b"\r\n\r\n" for r in kept))
    whole, cut = (warc.read_archives(spark, str(tmp_path / n)).collect() for n in ("whole", "cut"))
    assert [(r.page_id, r.payload_bytes, r.complete) for r in whole] == [(5, 200_000, True)]
    assert [(r.page_id, r.payload_bytes, r.complete) for r in cut] == [(5, None, False)]


def test_words():
    assert words_of("Ab-c9 É_x y".encode()) == [b"ab", b"c9", "É".encode(), "x y".encode()]


def test_a_pair_that_meets_in_many_regions_is_made_once(spark, monkeypatch):
    """Documents that share two thirds of their shingles, too few for a link, meet in a region for every shared shingle."""
    made, pairs = [], jaccard_join.leaf_pairs

    def counted(leaves):
        found = pairs(leaves)
        made.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(jaccard_join, "leaf_pairs", counted)
    monkeypatch.setattr(jaccard_join, "ALIKE", "true")
    pick, texts = np.random.default_rng(3), []
    for group in range(12):
        for i in range(6):
            words = [f"g{group}x{j}" for j in range(300)]
            for at in pick.choice(300, 15, replace=False):
                words[at] = f"u{group}x{i}x{at}"
            texts.append(" ".join(words))
    got = jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    sets = [{tuple(w[k: k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(texts)))
    links = [(x, y) for x in label for y in range(x) if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])]
    while any(label[x] != label[y] for x, y in links):
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))
    [(rows, distinct)] = made
    assert 0 < distinct <= rows <= 1.2 * distinct


def test_chance_pairs_take_region_sizes_from_their_members(spark, monkeypatch):
    """Sizes are not counted again and joined back to all members in every turn."""
    plans, dealt = [], jaccard_join.chance_pairs

    def watched(active, turn):
        found = dealt(active, turn)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(jaccard_join, "chance_pairs", watched)
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    texts = [" ".join([*(f"c{j}" for j in range(30)), *(f"u{i}x{j}" for j in range(4 + i % 7))]) for i in range(30)]
    jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert plans and all(plan.count("Join") == 1 for plan in plans)


def test_texts_move_once_to_where_passages_are_cut(spark):
    rows = [(i, None if i % 50 == 0 else " ".join(f"w{k}" for k in range(i % 7 * 20, i % 7 * 20 + 80)), i % 3) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id bigint, TEXT string, more int").coalesce(1)
    found = substring_dedup.remove_repeats(docs)
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_utf8" not in joined
    got = {r._row.doc_id: r for r in found.collect()}
    assert sorted((*r._row,) for r in got.values()) == sorted(rows)
    words = {i: (text or "").split() for i, text, _ in rows}
    seen, windows = {}, {i: [tuple(w[k: k + 50]) for k in range(len(w) - 49)] for i, w in words.items()}
    for i in sorted(windows):
        for w in windows[i]:
            seen.setdefault(w, i)
    for i, w in words.items():
        gone = {k + j for k, window in enumerate(windows[i]) if seen[window] < i for j in range(50)}
        assert got[i]._kept.decode() == " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed) == (len(w), len(gone))


def _least_reachable(edges):
    label = {x: x for e in edges for x in e}
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    return {x: c for x, c in label.items() if x != c}


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_components_go_on_from_those_of_other_edges(spark, monkeypatch, broadcast):
    monkeypatch.setattr(components_module, "BROADCAST_NODES", broadcast)
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(1000 + i, 1001 + i) for i in range(9)] + [(5000, x) for x in range(4000, 4040)]
    tables = [spark.createDataFrame(edges[k::2], "u bigint, v bigint") for k in range(2)]
    before = components(spark, tables[0])
    got = {r.node: r.component for r in components(spark, tables[1], before).collect()}
    assert got == _least_reachable(edges)
    none = spark.createDataFrame([(7, 7)], "u bigint, v bigint")
    assert {r.node: r.component for r in components(spark, none, before).collect()} == _least_reachable(edges[::2])
    assert components(spark, none).collect() == []


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_round_of_components_moves_edges_once(spark, monkeypatch):
    moved, write = [], components_module.stored
    monkeypatch.setattr(components_module, "stored", lambda df, purpose: moved.append(_shuffles(df)) or write(df, purpose))
    components(spark, spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(i, 900) for i in range(1, 60)], "u bigint, v bigint"))
    assert sum(moved) <= 3


def test_documents_of_one_row_are_compared_in_three_shuffled_steps(spark, monkeypatch):
    plans, write = {}, jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, purpose: plans.setdefault(purpose, []).append(_shuffles(df)) or write(df, purpose))
    common = [f"c{i}" for i in range(40)]
    texts = [" ".join([*common, *[f"u{i // 3}x{j}" for j in range(i % 5)]]) for i in range(30)]
    for rows in (list(enumerate(texts)), list(enumerate(texts)) + [(3, texts[20]), (4, None)]):
        plans.clear()
        got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert len(got) == len(rows) and {r.component_id for r in got if r.n_shingles} == {0}
        if len(rows) == len(texts):
            # Pairs meet their profiles and their texts by the pivot, what is found needs no sums.
            assert max(plans["bounds"]) <= 2 and max(plans["compared"]) <= 2


@pytest.mark.parametrize("few", [10**6, 0])
def test_pairs_are_compared_alike_broadcast_or_not(spark, monkeypatch, few):
    for limit in ("BROADCAST_PAIRS", "BROADCAST_KEYS"):
        monkeypatch.setattr(jaccard_join, limit, few)
    monkeypatch.setattr(components_module, "BROADCAST_NODES", few)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 60 - i % 4] + [f"x{i // 10}"] * (i // 10 % 2 * 30))) for i in range(40)] + [(99, "one two three"), (98, "one two three"), (7, words[0])]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.report(table).collect()}
    sets = [(i, frozenset(tuple(w[k: k + min(5, len(w))]) for k in range(max(1, len(w) - 4)))) for i, w in ((i, t.split()) for i, t in rows)]
    links = [(a, b) for a, x in sets for b, y in sets if 100 * len(x & y) >= 75 * len(x | y)]
    least = _least_reachable(links)
    assert got == {(i, len(x), least.get(i, i)) for i, x in sets}


def test_texts_go_to_python_in_small_batches(spark):
    spark.conf.unset(ARROW_ROWS)
    jaccard_join.report(spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string"))
    assert spark.conf.get(ARROW_ROWS) == str(BATCH_ROWS)
    spark.conf.unset(ARROW_ROWS)
    language.report(spark.createDataFrame([(1, "ein Text", "de")], "doc_id bigint, text string, lang string"))
    assert spark.conf.get(ARROW_ROWS) == str(BATCH_ROWS)
