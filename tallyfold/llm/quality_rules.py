"""Quality rules: per-document measures, and lines that very many documents of a host share.

Lines are normalised (white space at the ends stripped, A-Z lower-cased) and hashed; the distinct
documents of a line are counted per host (``source``). A line is boilerplate where more than
``min_docs`` documents and more than ``share`` of the host's documents hold it. Such lines are taken
away, and a document left with less than ``min_left`` of its words is rejected as depleted.

Documents are read once: measures and line hashes go to the shared folder, and counting and marking use
that. A document gives one row per distinct line, so hot lines are counted before the shuffle, and the
table of boilerplate lines is broadcast only if its measured size allows it.

Defined cases: a null or empty text has no words and fails the base rules; lines without a word are ignored;
documents without a host form a host of their own; repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import run_dir
from .text import list_column, slices, utf8

MIN_WORDS = 10
MAX_REPEATED = 0.20
MIN_DOCS = 10
SHARE = 0.02
MIN_LEFT = 0.20
BROADCAST_LINES = 100_000
_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of ``size`` words that are found twice or more. Windows are ranked by doubling, exactly."""
    n = len(words)
    if n <= size:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0

    def paired(a, b):
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].reshape(-1)

    two = paired(ids[:-1], ids[1:])
    four = paired(two[:-2], two[2:])
    _, inverse, counts = np.unique(four[:-1] * n + four[1:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse.reshape(-1)] > 1)
    marks = np.zeros(n + 1, np.int64)
    marks[starts] += 1
    marks[starts + size] -= 1
    return int(np.count_nonzero(np.cumsum(marks[:n])))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        numbers, hashes, sizes = [], [], []
        for text in part["_utf8"]:
            raw = text.as_py() or b""
            words = raw.split()
            seen, repeats, lines = set(), 0, {}
            for line in raw.split(b"\n"):
                n = len(line.split())
                if not n:
                    continue
                repeats += line in seen
                seen.add(line)
                key = xxhash.xxh3_64_intdigest(line.strip(_SPACES).lower())
                lines[key] = lines.get(key, 0) + n
            points = len(raw.translate(None, _CONTINUATION + _SPACES))
            numbers.append((len(words), points, len(raw) - len(raw.translate(None, _SYMBOLS)), repeats,
                            repeated_words(words)))
            hashes.append(np.fromiter(lines, np.uint64, len(lines)).view(np.int64))
            sizes.append(np.fromiter(lines.values(), np.int32, len(lines)))
        columns = np.array(numbers, np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], part["host"], *[pa.array(columns[:, i]) for i in range(5)],
             list_column(hashes, pa.int64()), list_column(sizes, pa.int32())],
            names=["doc_id", "host", *[f.split()[0] for f in MEASURES.split(", ")], "lines", "line_words"])


def measured(docs: DataFrame) -> DataFrame:
    """Measures and distinct line hashes of every document, from the shared folder."""
    spark = docs.sparkSession
    path = run_dir(spark, "measures")
    (docs.select("doc_id", F.col("source").cast("string").alias("host"), utf8("text").alias("_utf8"))
     .mapInArrow(_measure, f"doc_id bigint, host string, {MEASURES}, lines array<bigint>, line_words array<int>")
     .withColumn("_row", F.monotonically_increasing_id()).write.parquet(path))
    return spark.read.parquet(path)


def boilerplate(lines: DataFrame, hosts: DataFrame, min_docs: int, share: float) -> DataFrame:
    """``host_line`` of the lines above the limit of their host."""
    counts = lines.groupBy("host", "host_line").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
    found = counts.alias("c").join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
    return found.where(F.col("docs") > F.lit(share) * F.col("host_docs")).select("host_line")


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """Per document: measures, ``n_boilerplate_words`` and the verdicts ``base_failed, depleted, kept``."""
    base = measured(docs)
    lines = (base.select("_row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
             .select("_row", "host", F.xxhash64(F.coalesce("host", F.lit("\0")), "x.lines").alias("host_line"),
                     F.col("x.line_words").alias("words")))
    hosts = base.groupBy("host").agg(F.count("*").alias("host_docs"))
    path = run_dir(docs.sparkSession, "boilerplate")
    boilerplate(lines, hosts, min_docs, share).write.parquet(path)
    common = docs.sparkSession.read.schema("host_line bigint").parquet(path)
    if common.count() <= BROADCAST_LINES:
        common = F.broadcast(common)
    lost = (lines.join(common, "host_line").groupBy("_row").agg(F.sum("words").alias("_lost")))
    lost_words = F.coalesce("_lost", F.lit(0)).cast("long")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * F.col("n_words")))
    return (base.drop("lines", "line_words").join(lost, "_row", "left")
            .withColumns({"n_boilerplate_words": lost_words, "base_failed": failed,
                          "depleted": F.col("n_words") - lost_words < F.lit(min_left) * F.col("n_words")})
            .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")).drop("_row", "_lost", "host"))


def report(docs: DataFrame) -> DataFrame:
    return judge(docs)


REPORT_SQL = r"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from d),
win as (select r, i, array_to_string(w[i : i + 4], ' ') as g
        from (select r, w, unnest(range(1, cast(len(w) as bigint) - 3)) as i from w where len(w) >= 5)),
rep as (select r, count(distinct p) as n from (
          select win.r, unnest(range(win.i, win.i + 5)) as p
          from win join (select r, g from win group by r, g having count(*) > 1) x on win.r = x.r and win.g = x.g) group by r),
l as (select r, source, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
      from (select r, source, unnest(string_split(t, chr(10))) as line, unnest(range(1, 1 + len(string_split(t, chr(10))))) as pos from d)),
dup as (select r, sum(c - 1) as n from (select r, line, count(*) as c from l where n > 0 group by r, line) group by r),
common as (select k, source from (select source, k, count(distinct r) as c from l where n > 0 group by 1, 2) x
           join (select source, count(*) as total from d group by 1) h using (source)
           where c > 10 and c > cast(0.02 as double) * total),
lost as (select r, sum(n) as n from l semi join common on l.k = common.k and l.source = common.source where n > 0 group by r),
m as (select doc_id, cast(len(w.w) as bigint) as n_words,
             cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
             cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
             cast(coalesce(lost.n, 0) as bigint) as n_boilerplate_words
      from d join w using (r) left join dup using (r) left join rep using (r) left join lost using (r))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       n_words - n_boilerplate_words < cast(0.2 as double) * n_words as depleted,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
       and not (n_words - n_boilerplate_words < cast(0.2 as double) * n_words) as kept
from m
"""
