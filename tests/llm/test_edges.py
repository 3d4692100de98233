"""Nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables, through every registered query."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfold.llm import queries

from test_llm_oracle import rows_of

CLASHES = ("_row", "_doc", "start", "token", "n", "words", "size", "h1", "spans", "items", "score", "n_words", "kept", "bitmap")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents():
    pick = random.Random(5)
    prose = lambda n: " ".join(pick.choice("the of and in for that with this are was".split()) + pick.choice("abcdefgh")
                               for _ in range(n))
    long, base, shared = prose(20_000), prose(120), prose(60)
    near = base.split()
    near[60] = "changed"
    line = "One line that many documents share here"
    texts = [None, "", " \t\r\n ", "word", "word", "Four words and more", "four WORDS and more", base, base, base.upper(),
             " ".join(near), long, long + " end", prose(30) + " " + shared, prose(80) + " " + shared + " tail", "ÀÉ é x 你好 " + shared,
             f"{line}\n{prose(12)}\n  {line.upper()} \n\n{prose(3)}", f"{line}\n{line}", f"x\n{line}\ny", line, "\n\n\n",
             "a b c d e " * 40, "#*$ %&|<> " * 4, "item words alone one two three four five six seven eight nine ten eleven",
             "Released under the MIT License.\nmore", "12 34 !!", "é", "\x00 null byte", base + "\n" + line]
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "b", None, "hot")[min(i % 7, 3)], None if t is None else len(t))
            for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], rows[16], (None, "Four words and more", "en", None, None), (None, line, None, "a", 1),
             (10**12, base, "en", "hot", 5)]
    return rows


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "of"), (3, None), (4, "..."), (None, "four, words"),
         (1, "changed"), (10, "WORD"), (9, "word")]
PAGE = "<html><body><nav><a href='/'>Home</a></nav><article><h1>T &amp; U</h1><p>{}</p></article></body></html>"
PAGES = [(1, "http://a", PAGE.format("x " * 300)), (2, "http://b\r\nc", PAGE.format("x " * 300)), (3, None, None), (4, "", ""),
         (5, "http://e", "é" * 200_000), (6, "f", "é" * 200_000), (None, "g", PAGE.format("x " * 300)), (7, "h", "a" * 99), (8, "i", "a" * 99),
         (2, "http://b\r\nc", PAGE.format("x " * 300)), (9, "j", "<p>unclosed <b>text"), (10, "k", "\r\n\r\nWARC/1.1\r\n\r\n" * 10),
         (11, "l", PAGE.format("x " * 300))]


def store(spark, folder, docs, items=ITEMS, pages=PAGES):
    more = {c: F.lit("clash") for c in CLASHES}
    spark.createDataFrame(docs, DOCS).withColumns(more).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit(1) for c in ("name", "part", "n")}).write.parquet(
        f"{folder}/benchmark.parquet")
    spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumns(
        {c: F.lit(2) for c in ("digest", "payload", "text", "_row", "kind")}).write.parquet(f"{folder}/pages.parquet")
    conversations = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (None, None, None, None), (2, 1, "", "x" * 50_000)] if docs else []
    spark.createDataFrame(conversations, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {c: F.lit(2) for c in ("plan", "kind", "present", "digest", "fault")}).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    return store(spark, str(tmp_path_factory.mktemp("edges")), documents())


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return store(spark, str(tmp_path_factory.mktemp("nothing")), [], [], [])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, edges, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{edges}/{table}.parquet/*.parquet'")
    df = queries.QUERIES[name](spark, edges)
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    want, have = rows_of(result.fetchall(), columns), rows_of(df.collect(), df.columns)
    assert have == want, f"only Spark: {list((have - want).items())[:5]}, only SQL: {list((want - have).items())[:5]}"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, nothing, name):
    assert queries.QUERIES[name](spark, nothing).collect() == []


def test_language_of_edge_texts(spark, edges):
    got = queries.QUERIES["op9_language_mixture"](spark, edges)
    assert got.count() == len(documents())
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    for unknown in (0, 1, 2, 20, 22, 25):
        assert (by_id[unknown].lang_pred, by_id[unknown].score) == ("und", 0.0)
    assert by_id[26].lang_pred in ("en", "de") and 0 < by_id[26].score <= 1


def test_licences_of_edge_texts(spark, edges):
    got = {r.doc_id: r.licences for r in queries.QUERIES["op4_license_scan"](spark, edges).collect() if r.doc_id is not None}
    assert got[24] == "MIT" and got[0] == got[1] == got[3] == ""


def test_main_text_of_edge_pages(spark, edges):
    got = {r.url: (r.text, r.n_chars) for r in queries.QUERIES["op10_main_text"](spark, edges).collect()}
    assert got[None] == got[""] == ("", 0) and got["j"] == ("unclosed text", 13)
    assert got["l"][0] == "T & U\n" + " ".join(["x"] * 300) and got["f"][1] == 200_000


def test_pipeline_on_edge_tables(spark, edges, nothing):
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, edges)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, edges)
    assert mix.count() == docs.count() > 5
    assert corpus_pipeline.run(spark, nothing).collect() == []
