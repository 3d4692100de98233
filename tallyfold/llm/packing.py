"""Packing documents into sequences of a fixed number of tokens with bounded memory.

A document is its token ids and an end id. It is cut into whole sequences as long as it fills them; the rest is a piece to
be placed. Every partition keeps ``open_windows`` unfinished sequences and puts a piece where it leaves the least space
(best fit). If it fits nowhere, the fullest window is emitted; had it more than ``max_gap`` tokens to spare, the head of
the piece fills it first. A window without space is emitted at once.

What is still open at the end of a partition is merged: those windows' pieces are placed again by fewer tasks, ``FAN_IN``
partitions to one, until one task is left, which keeps a single window open, so that all but the last sequence are full to
``max_gap``. A task holds its open windows, one slice of documents and a bounded table of word tokens.

The vocabulary is a file of public size; the driver reads it and sends its text, so executors need no file.
With ``by_word`` the ids of a word are remembered, which is right for vocabularies that drop white space.

Defined cases: a null or empty text is the end id alone; every row is a document of its own, so rows with one ``doc_id``
give pieces that carry the same ``doc_id``; an empty table gives no piece; further columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .components import stored
from .text import byte_slices, utf8

WINDOW_TOKENS = 4096
OPEN_WINDOWS = 64
MAX_GAP = 32
FAN_IN = 32
END_ID = 2
VOCABULARY_FILE = "word_bpe_49k.json"
# Bytes of remembered words and their ids in one worker.
REMEMBERED_BYTES = 224 << 20
_ENTRY_BYTES = 200
_LONG_WORD = 256

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, ids array<int>, open boolean")


def vocabulary(path: str | None = None) -> str:
    """Text of a tokenizer file; without a path, of the public word vocabulary."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY_FILE)
    with open(path, encoding="utf-8") as file:
        return file.read()


# Letters that a word may be made of to skip the steps before the model, which leave such words whole.
_PLAIN = [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0xC0, 0x180)]


# Marks that stand for themselves beside a word; an apostrophe may begin an ending.
_MARKS = re.escape("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"))


def _plain_letters(tokenizer: Tokenizer) -> dict[int, str]:
    """What the steps before the model make of a letter, for letters that they treat alike wherever they stand in a word.

    Empty if a word of all these letters, with marks around it, does not come out as the marks and one piece made of theirs.
    """
    normal, pieces = tokenizer.normalizer, tokenizer.pre_tokenizer
    if normal is None or pieces is None:
        return {}
    table = {}
    for code in _PLAIN:
        lowered = normal.normalize_str(chr(code))
        made = pieces.pre_tokenize_str(lowered)
        if chr(code).isalpha() and len(lowered) == 1 and lowered.isalpha() and len(made) == 1:
            table[code] = made[0][0]
    every = "".join(map(chr, table))
    marks = "".join(chr(c) for c in range(33, 127) if re.fullmatch(f"[{_MARKS}]", chr(c)))
    made = pieces.pre_tokenize_str(normal.normalize_str(marks + every + marks))
    return table if [m[0] for m in made] == [marks, every.translate(table), marks] else {}


class WordIds(dict):
    """Ids of words, remembered. Letters with marks around them are put together from their parts; other words are encoded whole."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.letters = _plain_letters(tokenizer)
        class_ = "".join(map(chr, self.letters))
        self.plain = re.compile(f"([{_MARKS}]*)([{class_}]+)([{_MARKS}]*)").fullmatch if class_ else lambda text: None
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.stems: dict = {}
        self.bytes = 0

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes:
        ids = self.stems.get(stem)
        if ids is None:
            ids = self.stems[stem] = array("I", [t.id for t in self.tokenize(stem)]).tobytes()
            self.bytes += _ENTRY_BYTES
        return ids

    def _marks(self, marks: str) -> bytes:
        ids = self.stems.get(marks)
        if ids is None:
            ids = self.stems[marks] = self.whole(marks)
            self.bytes += _ENTRY_BYTES
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha() and self.letters:  # letters of ASCII only
            ids = self._stem(word.decode().lower())
        else:
            text = word.decode("utf-8", "replace")
            parts = self.plain(text)
            if parts is None or b"<" in word and any(special in word for special in self.special):
                ids = self.whole(text)
            else:
                before, stem, behind = parts.groups()
                ids = self._stem(stem.lower() if stem.isascii() else stem.translate(self.letters))
                if before or behind:
                    ids = (self._marks(before) if before else b"") + ids + (self._marks(behind) if behind else b"")
        if len(word) <= _LONG_WORD:
            self[word] = ids
            self.bytes += _ENTRY_BYTES
        return ids

    def trim(self) -> None:
        if self.bytes > REMEMBERED_BYTES:
            self.clear()
            self.stems.clear()
            self.bytes = 0


class TokenIds:
    """Ids of texts, as unsigned 32-bit numbers in little-endian order."""

    _made: dict[tuple, TokenIds] = {}

    def __init__(self, text: str, by_word: bool = True, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker per core already
        self.tokenizer = Tokenizer.from_str(text)
        self.words = WordIds(self.tokenizer) if by_word else None
        self.end = np.array([end_id], "<u4").tobytes()

    @classmethod
    def of_worker(cls, text: str, by_word: bool, end_id: int) -> TokenIds:
        """Made once in a worker and kept with its words for the tasks that follow."""
        key = (hash(text), by_word, end_id)
        if key not in cls._made:
            cls._made = {key: cls(text, by_word, end_id)}
        return cls._made[key]

    def of(self, texts: list[bytes]) -> list[bytes]:
        if self.words is None:
            made = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() + self.end for e in made]
        self.words.trim()
        ids = self.words.__getitem__
        return [b"".join(map(ids, t.split())) + self.end for t in texts]


@dataclass
class Window:
    number: int
    used: int = 0
    pieces: list[tuple] = field(default_factory=list)


class Packer:
    """Open windows of one partition. A piece is ``(doc_id, start, ids, doc_tokens)`` with ids as bytes."""

    def __init__(self, size: int = WINDOW_TOKENS, open_windows: int = OPEN_WINDOWS, max_gap: int = MAX_GAP):
        self.size, self.most, self.max_gap = size, open_windows, max_gap
        self.spaces: list[tuple[int, int]] = []  # (free tokens, window number), sorted
        self.open: dict[int, Window] = {}
        self.next = 0

    def _new(self) -> Window:
        window = self.open[self.next] = Window(self.next)
        insort(self.spaces, (self.size, self.next))
        self.next += 1
        return window

    def _put(self, window: Window, piece: tuple, at: int, stop: int) -> Window | None:
        """Tokens ``at`` to ``stop`` of the piece go to the window, which is returned if that fills it."""
        doc_id, start, ids, doc_tokens = piece
        self.spaces.remove((self.size - window.used, window.number))
        window.pieces.append((doc_id, start + at, ids[4 * at: 4 * stop], doc_tokens, window.used))
        window.used += stop - at
        if window.used == self.size:
            return self.open.pop(window.number)
        insort(self.spaces, (self.size - window.used, window.number))
        return None

    def add(self, piece: tuple) -> Iterator[Window]:
        """Place a piece; yields the windows that are emitted."""
        at, total = 0, len(piece[2]) // 4
        while total - at >= self.size:
            yield self._put(self._new(), piece, at, at + self.size)
            at += self.size
        while at < total:
            fit = bisect_left(self.spaces, (total - at,))
            if fit < len(self.spaces):
                window = self.open[self.spaces[fit][1]]
            elif len(self.open) < self.most:
                window = self._new()
            else:
                space, number = self.spaces[0]
                if space > self.max_gap:
                    yield self._put(self.open[number], piece, at, at + space)
                    at += space
                else:
                    del self.spaces[0]
                    yield self.open.pop(number)
                continue
            if full := self._put(window, piece, at, total):
                yield full
            at = total

    def rest(self) -> list[Window]:
        return list(self.open.values())


def _rows(windows: list[Window], first: int, still_open: bool) -> pa.RecordBatch:
    """``first`` is added to window numbers, so that they are sequence ids."""
    doc, start, length, crc, tokens, sequence, offset, ids = [], [], [], [], [], [], [], []
    for window in windows:
        for doc_id, at, raw, doc_tokens, place in window.pieces:
            doc.append(doc_id)
            start.append(at)
            length.append(len(raw) // 4)
            crc.append(zlib.crc32(raw))
            tokens.append(doc_tokens)
            sequence.append(first + window.number)
            offset.append(place)
            ids.append(raw)
    long = [pa.array(v, pa.int64()) for v in (doc, start, length, crc, tokens, sequence, offset)]
    ends = pa.array(np.cumsum([0, *length]), pa.int32())
    lists = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), "<u4").view(np.int32)))
    return pa.RecordBatch.from_arrays(
        [*long, lists, pa.array([still_open] * len(doc), pa.bool_())],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "open"])


def _packed(pieces, level: int, last: bool, size: int, open_windows: int, max_gap: int):
    """A task: ``pieces`` turns Arrow batches into lists of pieces, one list a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, 1 if last else open_windows, max_gap)
        first = level << 56 | TaskContext.get().partitionId() << 32
        for part in pieces(batches):
            done = [w for piece in part for w in packer.add(piece)]
            if done:
                yield _rows(done, first, False)
        if packer.open:
            yield _rows(packer.rest(), first, not last)
    return run


def _documents(shared, by_word: bool, end_id: int):
    def pieces(batches):
        ids = TokenIds.of_worker(shared.value, by_word, end_id)
        for part in byte_slices(batches, "_utf8"):
            made = ids.of([t or b"" for t in part["_utf8"].to_pylist()])
            yield [(doc, 0, raw, len(raw) // 4) for doc, raw in zip(part["doc_id"].to_pylist(), made)]
    return pieces


def _left(batches):
    for batch in batches:
        values, ends = batch["ids"].flatten().to_numpy().astype("<u4"), np.cumsum(batch["length"].to_numpy())
        yield [(doc, start, values[end - n: end].tobytes(), tokens) for doc, start, n, tokens, end in zip(
            *[batch[c].to_pylist() for c in ("doc_id", "start", "length", "doc_tokens")], ends)]


def pack(docs: DataFrame, tokenizer: str | None = None, by_word: bool = True, end_id: int = END_ID,
         size: int = WINDOW_TOKENS, open_windows: int = OPEN_WINDOWS, max_gap: int = MAX_GAP) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and its ``ids``.

    A sequence is the pieces of one ``sequence_id`` by ``offset``. The tables of all rounds are written.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("_utf8"))
    made = stored(texts.mapInArrow(_packed(_documents(shared, by_word, end_id), 0, False, size, open_windows, max_gap), PIECES),
                  "packed")
    out, level, parts = [made.where("not open")], 0, max(1, len(made.inputFiles()))
    while True:
        level, parts = level + 1, -(-parts // FAN_IN)
        # Read in file order without a shuffle: a task that is run again packs the same way.
        left = made.where("open").coalesce(parts)
        made = stored(left.mapInArrow(_packed(_left, level, parts == 1, size, open_windows, max_gap), PIECES), "packed")
        out.append(made.where("not open"))
        if parts == 1:
            break
    packed = out[0]
    for more in out[1:]:
        packed = packed.unionByName(more)
    return packed.drop("open")


def report(docs: DataFrame) -> DataFrame:
    """The pieces without their ids."""
    return pack(docs).drop("ids")
