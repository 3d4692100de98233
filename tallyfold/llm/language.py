"""Language identification as inference of a mixture of languages.

A language is a distribution over hashed byte trigrams, counted over all labelled documents that are not
held out. A text is taken as trigrams drawn from a mixture of languages: expectation-maximisation finds the
proportions, and the set of languages is the one with the best log-likelihood less ``penalty`` times
``log(n) / 2`` per language (n: independent trigrams), tried over the sets of the 1, 2, ... strongest.

The model has languages x ``BUCKETS`` counts. It is summed on the executors and its size, which depends on
the number of languages only, is checked before it is broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0; with no labelled document every text
is ``und``; documents without an id are never learned from and not held out; empty or white-space text has no letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import tune_batches
from .text import slices, utf8

BUCKETS = 1 << 15
FOLDS, HELD_OUT = 3, 1
STEPS = 8
PENALTY = 4.0
# A weaker language is not tried.
LEAST_SHARE = 0.02
# Languages a model may have (64 MB of numbers).
MAX_LANGUAGES = 256
UNKNOWN = "und"
# The pipeline rejects texts whose strongest language makes up less than this.
MIN_SCORE = 0.5

# Letters (A-Z as a-z) and non-ASCII bytes stay, all else is a space.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32) for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
PIECE = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode()))


def trigram_counts(text: bytes) -> np.ndarray:
    """Counts of the hashed byte trigrams of the whole text, runs of non-letters taken as one space."""
    out = np.zeros(BUCKETS, np.int64)
    flat = b" " + b" ".join(text.translate(_TABLE).split()) + b" "
    for at in range(0, len(flat), PIECE):
        x = np.frombuffer(flat[at: at + PIECE + 2], np.uint8).astype(np.uint32)
        if len(x) > 2:
            code = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)
            out += np.bincount(code >> np.uint32(17), minlength=BUCKETS)
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_probs: np.ndarray  # bucket x language

    def mixture(self, counts: np.ndarray) -> list[tuple[str, float]]:
        """Chosen languages with their proportions, strongest first."""
        used = np.flatnonzero(counts)
        weight = counts[used].astype(float)
        total = weight.sum()
        logs = self.log_probs[used]
        peak = logs.max(axis=1)
        probs = np.exp(logs - peak[:, None])
        base = weight @ peak

        def fit(columns, start):
            """Proportions and log-likelihood."""
            p, share = probs[:, columns], start
            for _ in range(STEPS):
                mixed = p * share
                share = (weight / mixed.sum(axis=1)) @ mixed / total
            return share, base + weight @ np.log((p * share).sum(axis=1))

        share, _ = fit(np.arange(len(self.languages)), np.full(len(self.languages), 1 / len(self.languages)))
        order = np.lexsort((np.arange(len(share)), -share))
        price = PENALTY * np.log(max(total / 3, 2)) / 2
        best = None
        for k in range(1, len(order) + 1):
            columns = order[:k]
            if k > 1 and share[columns[-1]] < LEAST_SHARE:
                break
            part, score = fit(columns, share[columns] / share[columns].sum()) if k > 1 else (
                np.ones(1), base + weight @ np.log(np.maximum(probs[:, columns[0]], 1e-300)))
            if best is None or score - k * price > best[0]:
                best = (score - k * price, columns, part)
        _, columns, part = best
        return sorted(((self.languages[c], float(s)) for c, s in zip(columns, part)), key=lambda x: (-x[1], x[0]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language of one task, given out once at its end."""
    counts: dict[str, np.ndarray] = {}
    for part in slices(batches):
        for lang, text in zip(part["lang"].to_pylist(), part["_utf8"]):
            raw = text.as_py()
            if has_letter(raw):
                found = trigram_counts(raw)
                if lang in counts:
                    counts[lang] += found
                else:
                    counts[lang] = found
    for lang, found in counts.items():
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])],
            names=["lang", "bucket", "n"])


def learn(labelled: DataFrame) -> Model:
    """Model of ``lang`` from ``text`` over all given rows."""
    parts = (labelled.where("lang is not null and text is not null")
             .select(F.col("lang").cast("string").alias("lang"), utf8("text").alias("_utf8"))
             .mapInArrow(_count, "lang string, bucket int, n bigint"))
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_language = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))  # <= BUCKETS each
    rows = per_language.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows.sort(key=lambda r: r["lang"])
    table = np.full((BUCKETS, len(rows)), 0.5)
    for column, row in enumerate(rows):
        pairs = np.array(row["counts"], np.int64)
        table[pairs[:, 0], column] += pairs[:, 1]
    return Model(tuple(r["lang"] for r in rows), np.log(table / table.sum(axis=0)) if rows else table)


def _tag(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for part in slices(batches):
            found = []
            for text in part["_utf8"]:
                raw = text.as_py()
                known = bool(model.languages) and has_letter(raw)
                found.append(model.mixture(trigram_counts(raw)) if known else [(UNKNOWN, 0.0)])
            yield pa.RecordBatch.from_arrays(
                [part["_row"], pa.array([f[0][0] for f in found], pa.string()),
                 pa.array([min(1.0, max(0.0, f[0][1])) for f in found], pa.float64()),
                 pa.array([[{"lang": n, "share": s} for n, s in f] for f in found],
                          pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                names=["_row", "lang_pred", "score", "mixture"])
    return run


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``lang_pred, score, mixture``. Only the text is looked at."""
    tune_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("_row"), utf8("text").alias("_utf8"))
    return rows.mapInArrow(
        _tag(docs.sparkSession.sparkContext.broadcast(model)),
        f"_row {rows.schema['_row'].dataType.simpleString()}, lang_pred string, score double, "
        "mixture array<struct<lang:string,share:double>>")


def train_fold(docs: DataFrame) -> Model:
    return learn(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))


def report(docs: DataFrame) -> DataFrame:
    return tag(docs.select("doc_id", "text"), train_fold(docs)).select(
        "_row.doc_id", F.coalesce(held_out(F.col("_row.doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` in a recognised language that makes up ``min_score`` of the text at least."""
    kept = tag(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*[f"_row.`{c}`" for c in docs.columns])
