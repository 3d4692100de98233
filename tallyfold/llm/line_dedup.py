"""Line deduplication: of a line that many documents share, one document keeps its copies.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of ``min_chars`` code points
or more that are found in ``min_docs`` documents or more stay in the largest ``doc_id`` that holds them only.

Only hashes move. Two 64-bit hashes per line are range-partitioned and sorted by hash, document (largest
first) and position, so a key streams by in one piece: its first document keeps its lines, and all
others lose theirs if the key's document numbers reach ``min_docs``. The decisions come back as one sparse
bitmap per document, 64 lines to a word and only words with a dropped line, and are applied to the text where it is.

A key with more than ``HOT_ROWS`` rows and more than ``1 / SHARES`` of all rows is hot: there are fewer than ``SHARES`` of them. Those are counted with partial aggregation and their rows are marked without moving.

Everything is built-in functions. A document is known by ``doc_id`` and a hash of its text.

Defined cases: a null or empty text is one empty line; rows with one ``doc_id`` are one document when documents
are counted or the largest is picked; rows without ``doc_id`` are one document below all others;
text that loses all lines becomes empty; a null text that loses nothing stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import run_dir

MIN_CHARS = 20
MIN_DOCS = 3
SHARES = 10_000
HOT_ROWS = 1_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]
_NO_ID = -(1 << 63)
BITMAP = "array<struct<word:int,dropped:bigint>>"


def _lower_ascii(text: Column) -> Column:
    """A-Z only; where all is ASCII, ``lower`` does just that and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _stripped(line: Column) -> Column:
    return F.call_function("btrim", line, F.lit(" \t\n\x0b\x0c\r"))


def identified(docs: DataFrame) -> DataFrame:
    """``_row`` holds all columns, whatever their names."""
    return docs.select(F.struct("*").alias("_row"), F.coalesce("doc_id", F.lit(_NO_ID)).cast("long").alias("_doc"),
                       F.xxhash64(F.coalesce("text", F.lit("\0"))).alias("_text_hash"))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``_doc, _text_hash, pos, h1, h2`` of every line that is long enough."""
    lines = F.split(_lower_ascii(F.col("_row.text")), "\n", -1)
    keys = F.transform(lines, lambda line, pos: F.struct(pos.alias("pos"), _stripped(line).alias("key")))
    long = F.filter(keys, lambda x: F.char_length(x["key"]) >= min_chars)
    hashed = F.transform(long, lambda x: F.struct(x["pos"].alias("pos"), F.xxhash64(x["key"]).alias("h1"),
                                                  F.xxhash64(F.lit(1), x["key"]).alias("h2")))
    return identified(docs.where("text is not null").select("doc_id", "text")).select(
        "_doc", "_text_hash", F.explode(hashed).alias("x")).select("_doc", "_text_hash", "x.*")


def dropped_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """``_doc, _text_hash, pos`` of the lines to drop."""
    spark = rows.sparkSession
    per_key = rows.groupBy(*_KEY).agg(F.count("*").alias("rows"))
    total = rows.count()
    keys = per_key.where(F.col("rows") > max(HOT_ROWS, total // SHARES)).select(*_KEY)
    path = run_dir(spark, "hot-lines")
    of_hot = rows.join(F.broadcast(keys), _KEY).groupBy(*_KEY).agg(
        F.count_distinct("_doc").alias("docs"), F.max("_doc").alias("keeper"))
    of_hot.write.parquet(path)
    hot = F.broadcast(spark.read.parquet(path))  # fewer than SHARES rows

    moved = (rows.join(hot.select(*_KEY), _KEY, "left_anti").repartitionByRange(*_KEY)
             .sortWithinPartitions(*_KEY, F.col("_doc").desc(), "pos"))
    by_key = Window.partitionBy(*_KEY)
    ranked = moved.withColumns({
        "_nth": F.dense_rank().over(by_key.orderBy(F.col("_doc").desc())),
    }).withColumn("_docs", F.max("_nth").over(by_key))
    cold = ranked.where((F.col("_nth") > 1) & (F.col("_docs") >= min_docs))
    marked = rows.join(hot, _KEY).where((F.col("docs") >= min_docs) & (F.col("_doc") != F.col("keeper")))
    columns = ["_doc", "_text_hash", "pos"]
    return cold.select(*columns).unionByName(marked.select(*columns))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """``_doc, _text_hash, bitmap``: per document the 64-line words that lose a line, with the bits of those lines."""
    words = (dropped.groupBy("_doc", "_text_hash", F.shiftright("pos", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("dropped")))
    return words.groupBy("_doc", "_text_hash").agg(
        F.sort_array(F.collect_list(F.struct("word", "dropped"))).cast(BITMAP).alias("bitmap"))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    path = run_dir(docs.sparkSession, "lines")
    line_hashes(docs, min_chars).write.parquet(path)
    return keep_bitmaps(dropped_lines(docs.sparkSession.read.parquet(path), min_docs))


def with_kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``kept`` (the text that stays), ``n_lines, n_dropped``."""
    marked = identified(docs).join(bitmaps, ["_doc", "_text_hash"], "left")
    text = F.col("_row.text")
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    # Each step below hands its array on as the argument of a function, so it is computed once per document.
    dense = F.aggregate("bitmap", F.expr("cast(array() as array<bigint>)"), lambda words, x: F.concat(
        words, F.array_repeat(F.lit(0).cast("long"), x["word"] - F.size(words)), F.array(x["dropped"])))
    bits = F.flatten(F.transform(dense, lambda word: F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda bit: F.getbit(word, bit))))
    kept = F.array_join(F.zip_with(lines, bits, lambda line, bit: F.when(F.coalesce(bit, F.lit(0)) == 0, line)), "\n")
    return marked.select(
        "_row", F.when(F.col("bitmap").isNull(), text).otherwise(kept).alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("bitmap", F.lit(0), lambda n, x: n + F.bit_count(x["dropped"])), F.lit(0))
        .cast("long").alias("n_dropped"))


def report(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return with_kept_text(docs, line_bitmaps(docs)).select(
        "_row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the dropped lines; ``n_chars`` follows the text where there is such a column."""
    found = with_kept_text(docs, line_bitmaps(docs))
    changed = {"text": F.col("kept"), "n_chars": F.when(F.col("n_dropped") > 0, F.char_length("kept").cast("long"))
               .otherwise(F.col("_row.n_chars")) if "n_chars" in docs.columns else None}
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`") for c in docs.columns])


REPORT_SQL = r"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select r, coalesce(doc_id, -9223372036854775808) as doc, unnest(lines) as line, unnest(range(1, 1 + len(lines))) as pos from d),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
shared as (select key, max(doc) as keeper from k where length(key) >= 20 group by key having count(distinct doc) >= 3),
kept as (select r, line, pos, k.key is not null and s.key is not null and doc <> keeper as gone
         from k left join shared s on k.key = s.key)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from kept join d using (r) group by r, doc_id
"""
