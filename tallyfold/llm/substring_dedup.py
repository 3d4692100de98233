"""Removal of passages that an earlier document holds, with a count-min sketch before the exact grouping.

A window is ``window`` consecutive words. Its anchor is the least hash among its runs of half as many words: windows
of equal words have equal anchors, and neighbouring windows mostly share one, so there are some 13 times fewer
anchors than windows. Each task sketches the anchors of its documents (``ROWS`` rows of ``CELLS`` cells, an anchor once
per document); the sketches are summed cell by cell, and a bitmap of the cells that reach 2 goes to all tasks. Sums only
overestimate: a window with an anchor cell below 2 is in one document alone. The other windows, with 128 bits
of hash, are grouped exactly in a second pass, whole stretches first and single windows where stretches differ: the
first document of each is found with partial aggregation, and joined back.

The bitmap has ``ROWS * CELLS`` bits (16 MB) whatever the input; a fuller sketch lets more windows through to the
second pass and loses none.

Defined cases: a null or empty text and one shorter than the window lose nothing; rows with one ``doc_id`` are one
document, none of which is before another; rows without ``doc_id`` come before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import stored
from .text import WordHashes, covered, list_column, mixed, slices, utf8, window_hashes

WINDOW = 50
ROWS, CELLS = 2, 1 << 26
_PAGE = 1 << 15  # bits of one native bitmap
_NO_ID = -(1 << 63)
_SECOND_SEED = 0xC2B2AE3D27D4EB4F


def window_anchors(words: np.ndarray, window: int) -> np.ndarray:
    """The anchor of every window: the least hash of its runs of ``window // 2`` words."""
    low = window_hashes(words, window // 2)
    wanted, span = window - window // 2 + 1, 1
    while span * 2 <= wanted:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = wanted - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def cells_of(anchors: np.ndarray) -> list[np.ndarray]:
    """The cell of each anchor in each row of the sketch, numbered through."""
    mask = np.uint64(CELLS - 1)
    return [((anchors >> np.uint64(32 * row)) & mask) + np.uint64(row * CELLS) for row in range(ROWS)]


def _sketch(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in slices(batches, 1024):
            anchors = [np.empty(0, np.uint64)]
            for text in part["_utf8"]:
                words = (text.as_py() or b"").split()
                if len(words) >= window:
                    anchors.append(np.unique(window_anchors(hashes.of(words), window)))
            values, counts = np.unique(np.concatenate(cells_of(np.concatenate(anchors))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int32)), pa.array(counts.astype(np.int64))],
                                             names=["cell", "n"])
    return run


def repeated_cells(docs: DataFrame, window: int) -> np.ndarray:
    """Bits of the cells that two documents or more reach, from the merged sketches."""
    sketches = docs.select(utf8("text").alias("_utf8")).mapInArrow(_sketch(window), "cell int, n bigint")
    full = sketches.groupBy("cell").agg(F.sum("n").alias("n")).where("n >= 2")
    pages = full.groupBy(F.shiftright("cell", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("cell").bitwiseAND(_PAGE - 1)).alias("bits"))
    out = np.zeros(ROWS * CELLS // 8, np.uint8)
    for page, bits in pages.collect():  # ROWS * CELLS / 2**15 rows of 4 KB at most
        out[page * (_PAGE // 8):][: _PAGE // 8] = np.frombuffer(bits, np.uint8)
    return out


def _suspect(anchors: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which anchors the sketch takes for repeated."""
    hit = np.ones(len(anchors), bool)
    for cells in cells_of(anchors):
        hit &= (bits[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def _runs(window: int, shared):
    """Stretches of suspect windows with one anchor: where they are, a mark of the whole stretch, a hash per window."""
    kinds = {"anchor": np.uint64, "r1": np.uint64, "r2": np.uint64, "start": np.int32, "n": np.int32}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), shared.value
        for part in slices(batches):
            rows, found, windows = [np.empty(0, np.int64)], [[np.empty(0, k) for k in kinds.values()]], []
            for row, text in enumerate(part["_utf8"]):
                words = (text.as_py() or b"").split()
                if len(words) < window:
                    continue
                hashed = hashes.of(words)
                anchors = window_anchors(hashed, window)
                starts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
                hit = _suspect(anchors[starts], bits)
                if not hit.any():
                    continue
                sizes = np.diff(np.append(starts, len(anchors)))
                step = np.arange(len(anchors), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
                one = window_hashes(hashed, window)
                marks = [np.add.reduceat(mixed(h + step * np.uint64(_SECOND_SEED)), starts)
                         for h in (one, window_hashes(hashed, window, _SECOND_SEED))]
                rows.append(np.full(int(hit.sum()), row))
                found.append([x[hit] for x in (anchors[starts], *marks, starts, sizes)])
                windows.extend(w for w, h in zip(np.split(one, starts[1:]), hit.tolist()) if h)
            at = pa.array(np.concatenate(rows))
            columns = {name: np.concatenate([f[i] for f in found]).astype(kind)
                       for i, (name, kind) in enumerate(kinds.items())}
            yield pa.RecordBatch.from_arrays(
                [part["_doc"].take(at), part["_text_hash"].take(at),
                 *[pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()],
                 list_column([w.view(np.int64) for w in windows], pa.int64())],
                names=["_doc", "_text_hash", *columns, "windows"])
    return run


def _finish(window: int, column: int):
    """``n_words, n_removed, kept`` from the text, a column of ``_row``, and the starts of the windows to remove."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kept, total, gone = [], [], []
            for text, starts in zip(part["_row"].field(column).cast(pa.binary()), part["starts"]):
                words = (text.as_py() or b"").split()
                total.append(len(words))
                if starts.is_valid and len(starts):
                    at = np.concatenate([np.arange(a, a + n) for a, n in
                                         zip(*(starts.values.field(f).to_numpy() for f in ("start", "n")))])
                    inside = covered(at, window, len(words))
                    words = [w for w, out in zip(words, inside.tolist()) if not out]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part["_row"], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                names=["_row", "n_words", "n_removed", "_kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``n_words, n_removed`` and ``_kept``: the words left, one space between."""
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce("doc_id", F.lit(_NO_ID)).cast("long").alias("_doc"),
                       F.xxhash64(F.coalesce("text", F.lit("\0"))).alias("_text_hash"))
    kind = rows.schema["_row"].dataType.simpleString()
    column = [c.lower() for c in docs.columns].index("text")
    shared = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, window))
    runs = stored(rows.select("_doc", "_text_hash", utf8("_row.text").alias("_utf8")).mapInArrow(
        _runs(window, shared), "_doc bigint, _text_hash bigint, anchor bigint, r1 bigint, r2 bigint, start int, n int, "
                               "windows array<bigint>"), "runs")
    starts = repeated_starts(runs).groupBy("_doc", "_text_hash").agg(
        F.collect_list(F.struct("start", "n")).alias("starts"))  # no more than its windows
    # The text moves once, inside its row.
    return (rows.join(starts, ["_doc", "_text_hash"], "left").select("_row", "starts")
            .mapInArrow(_finish(window, column), f"_row {kind}, n_words bigint, n_removed bigint, _kept binary"))


def repeated_starts(runs: DataFrame) -> DataFrame:
    """``_doc, _text_hash, start, n``: windows to remove, as stretches.

    Equal stretches are settled at once: all but the first document's go. The first ones alone are cut into windows,
    and only where an anchor has different stretches, since a window lies in a stretch of its own anchor.
    """
    key = ["anchor", "r1", "r2"]
    first = stored(runs.groupBy(*key).agg(F.min("_doc").alias("first")), "first-runs")
    contested = first.groupBy("anchor").agg(F.min(F.struct("r1", "r2")).alias("a"), F.max(F.struct("r1", "r2")).alias("b"))
    # What is joined back is written first: the joins can be split at hot keys where both sides come straight from a shuffle.
    contested = stored(contested.where("a <> b").select("anchor", F.lit(True).alias("contested")), "contested")
    judged = runs.join(first.join(contested, "anchor", "left"), key)
    later = F.col("_doc") > F.col("first")
    judged = stored(judged.where(later | F.col("contested")).select(
        "_doc", "_text_hash", "anchor", "start", "n", later.alias("later"),
        F.when(~later, F.col("windows")).alias("windows")), "judged-runs")
    places = ["_doc", "_text_hash", "start", "n"]
    single = judged.where("not later").select(
        "_doc", "_text_hash", "anchor", "start", F.posexplode("windows").alias("at", "hash"))
    earliest = stored(single.groupBy("anchor", "hash").agg(F.min("_doc").alias("first"), F.max("_doc").alias("last"))
                      .where("first < last"), "earliest")
    repeated = single.join(earliest, ["anchor", "hash"]).where(F.col("_doc") > F.col("first"))
    return judged.where("later").select(*places).unionByName(
        repeated.select("_doc", "_text_hash", (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("n")))


def report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text")).select(
        "_row.doc_id", "n_words", "n_removed", F.sha2("_kept", 256).alias("kept_sha256"))


REPORT_SQL = r"""
with d as (select row_number() over () as r, coalesce(doc_id, -9223372036854775808) as doc, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select r, doc, i, md5(array_to_string(w[i : i + 49], ' ')) as k
        from (select r, doc, w, unnest(range(1, cast(len(w) as bigint) - 48)) as i from d where len(w) >= 50)),
f as (select k, min(doc) as first from win group by k having min(doc) < max(doc)),
gone as (select distinct r, p from (select r, unnest(range(i, i + 50)) as p from win join f using (k) where doc > first)),
words as (select r, unnest(w) as word, unnest(range(1, 1 + cast(len(w) as bigint))) as p from d),
kept as (select words.r, count(*) filter (gone.p is not null) as n,
                string_agg(word, ' ' order by words.p) filter (gone.p is null) as k
         from words left join gone on words.r = gone.r and words.p = gone.p group by words.r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(k, '')) as kept_sha256
from d left join kept using (r)
"""
