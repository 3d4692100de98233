"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Document words stream
through it while the length of the longest run that ends at the current word is
tracked: once that length reaches the window, the last ``window`` words are a
run of some item.

Items are dealt to automata of at most about ``AUTOMATON_WORDS`` words each, built in tasks.
One automaton at a time passes through the driver on its way to the executors, so
what is broadcast has a fixed bound; documents pass the automata one after the other.

Defined cases: a null or empty text has no words and no hits; an item without words
never occurs; rows of one ``item_id`` are one item, rows without id the item ``null``;
repeated documents are judged one by one; an empty item table leaves all documents clean.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices, utf8

WINDOW = 10
# Words that one automaton holds, about (items are whole, unless longer than PIECE_WORDS).
AUTOMATON_WORDS = 200_000
PIECE_WORDS = 50_000
# The pipeline cuts hit spans out and drops a document with more than this part hit.
MAX_COVERAGE = 0.5

# A-Z become a-z; everything outside words [0-9A-Za-z and non-ASCII] becomes a space; lengths stay.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32)
               for c in range(256))
FIELDS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,stop:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, window: int):
        self.window, self.next, self.link, self.length = window, [{}], [-1], [0]
        self.items: list = []
        self.shortest = window

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """A copy of ``q`` for the runs that are no longer than one word after ``p``."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _append(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def build(self, items: list[tuple[str, list[bytes]]]) -> Automaton:
        for _, words in items:
            last = 0
            for word in words:
                last = self._append(last, word)
        # Per state: (run length, item ids) for each item run that ends there, by suffix links too.
        runs: list[dict[int, set]] = [{} for _ in self.length]
        for name, words in items:
            size, state = min(self.window, len(words)), 0
            self.shortest = min(self.shortest, size)
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 < size:
                    continue
                at = state
                while self.length[self.link[at]] >= size:
                    at = self.link[at]
                runs[at].setdefault(size, set()).add(name)
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.items = [()] * len(order)
        for v in order[1:]:
            self.items[v] = self.items[self.link[v]] + tuple((n, tuple(ids)) for n, ids in runs[v].items())
        return self

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Spans of hit words, in order and apart, and the items that occur."""
        moves, link, length, items, shortest = self.next, self.link, self.length, self.items, self.shortest
        root = here = moves[0]
        state = matched = 0
        spans: list[list[int]] = []
        found: set = set()
        for i, word in enumerate(words):
            to = here.get(word)
            if to is not None:
                matched += 1
            elif state:
                while state and to is None:
                    state = link[state]
                    to = moves[state].get(word)
                if to is None:
                    matched, here = 0, root
                    continue
                matched = length[state] + 1
            else:
                continue
            state = to
            here = moves[to]
            if matched >= shortest and items[to]:
                longest = 0
                for size, ids in items[to]:
                    if size <= matched:
                        found.update(ids)
                        longest = max(longest, size)
                if longest:
                    start = i + 1 - longest
                    while spans and spans[-1][0] >= start:
                        spans.pop()
                    if spans and spans[-1][1] >= start:
                        spans[-1][1] = i + 1
                    else:
                        spans.append([start, i + 1])
        return spans, found


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def _pieces(window: int, size: int):
    """Items as ``name, words``; a very long one as pieces that overlap by ``window - 1`` words."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["name"], batch["text"]):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), size) if words else ():
                    piece = words[at: at + size + window - 1]
                    rows.append((name, b" ".join(piece), len(piece)))
            yield pd.DataFrame(rows, columns=["name", "words", "n"])
    return cut


def automata(items: DataFrame, window: int = WINDOW, per_automaton: int = AUTOMATON_WORDS) -> Iterator[Automaton]:
    """Each is built in a task from its share of the items; without items there is one empty automaton."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"),
                         utf8("text").alias("text")).where("text is not null")
    pieces = named.mapInPandas(_pieces(window, PIECE_WORDS), "name string, words binary, n bigint")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // per_automaton))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = Automaton(window).build([(n, bytes(w).split(b" ")) for n, w in zip(rows["name"], rows["words"])])
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "automaton": [pickle.dumps(made)]})

    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("name", "words"), F.lit(parts)).cast("int"))
    built = dealt.groupBy("part").applyInPandas(build, "part int, automaton binary").select("automaton")
    if total == 0:
        yield Automaton(window).build([])
    for row in built.toLocalIterator():
        yield pickle.loads(bytes(row[0]))


def _stage(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: Automaton = shared.value
        for part in slices(batches):
            n_words, n_hit, items, spans = [], [], [], []
            for text, before, named in zip(part["_utf8"], part["spans"].to_pylist(), part["items"].to_pylist()):
                words = words_of(text.as_py())
                new, found = automaton.match(words)
                if before:
                    new = _merged(new + [[s["start"], s["stop"]] for s in before])
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in new))
                items.append(sorted(found.union(named)))
                spans.append([{"start": a, "stop": b} for a, b in new])
            columns = {"_row": part["_row"], "_utf8": part["_utf8"], "n_words": pa.array(n_words, pa.int64()),
                       "n_hit": pa.array(n_hit, pa.int64()), "items": pa.array(items, pa.list_(pa.string())),
                       "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return run


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW,
               per_automaton: int = AUTOMATON_WORDS) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``n_words, n_hit, items, spans`` per document; no shuffle of documents."""
    out = docs.select(F.struct("*").alias("_row"), utf8("text").alias("_utf8"),
                      F.expr("0L").alias("n_words"), F.expr("0L").alias("n_hit"),
                      F.expr("cast(array() as array<string>)").alias("items"),
                      F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))
    kind = out.schema["_row"].dataType.simpleString()
    for automaton in automata(items, window, per_automaton):
        out = out.mapInArrow(_stage(docs.sparkSession.sparkContext.broadcast(automaton)),
                             f"_row {kind}, _utf8 binary, {FIELDS}")
    return out.drop("_utf8")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items that occur."""
    ids = F.col("items")
    return find_leaks(docs.select("doc_id", "text"), items).select(
        "_row.doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for raw, found in zip(text, spans):
        if raw is None:
            out.append(None)
            continue
        raw = bytes(raw)
        at = [m.span() for m in re.finditer(rb"\S+", raw.translate(_TABLE))]
        kept, last = [], 0
        for span in found:
            kept.append(raw[last: at[span["start"]][0]])
            last = at[span["stop"] - 1][1]
        out.append(b"".join([*kept, raw[last:]]).decode())
    return pd.Series(out, dtype=object)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                  min_span: int = 1) -> DataFrame:
    """``docs`` without item passages: hit spans of ``min_span`` words or more are cut out of the text.

    A document with more than ``max_coverage`` of its words hit is dropped. Documents without a hit stay as they are.
    """
    found = find_leaks(docs, items, window)
    long = F.filter("spans", lambda s: s["stop"] - s["start"] >= min_span)
    hit = F.size(long) > 0
    cut = F.pandas_udf(_cut, "string")(F.when(hit, F.col("_row.text").cast("binary")), F.when(hit, long))
    text = F.when(hit, cut).otherwise(F.col("_row.text")).alias("text")
    left = found.where(F.col("n_hit") <= F.lit(max_coverage) * F.greatest("n_words", F.lit(1)))
    changed = left.select("_row", hit.alias("_hit"), text)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("_hit"), F.char_length("text").cast("long")).otherwise(
        F.col("_row.n_chars")) if "n_chars" in docs.columns else None}
    return changed.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])


REPORT_SQL = r"""
with item_words as (
    select coalesce(cast(item_id as varchar), 'null') as item,
           regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') as w
    from benchmark where text is not null),
item_runs as (
    select distinct item, least(10, len(w)) as size,
           unnest([array_to_string(w[i : i + least(10, len(w)) - 1], ' ') for i in range(1, len(w) - least(10, len(w)) + 2)]) as run
    from item_words where len(w) > 0),
doc_words as (
    select row_number() over () as r, doc_id,
           coalesce(regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+'), []) as w
    from documents),
doc_runs as (
    select r, size, i, array_to_string(w[i : i + size - 1], ' ') as run
    from (select r, w, size, unnest(range(1, cast(len(w) as bigint) - size + 2)) as i
          from doc_words, (select distinct size from item_runs) where len(w) >= size)),
hits as (select r, d.size, i, item from doc_runs d join item_runs t on d.run = t.run and d.size = t.size),
hit_words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + size)) as p from hits) group by r),
hit_items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
              from (select distinct r, item from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (r) left join hit_items using (r)
"""
