"""Mining phrases whose words stand together more often than apart, per language.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into words. A candidate is a
phrase of 2 to ``max_words`` words that stands in pieces ``min_count`` times or more. Its score is the least over its
cuts of ``floor(SCALE * a * a / (l * r))``: ``a`` its own count, ``l`` and ``r`` those of the two parts.

Texts are split once. They are written as blocks of the numbers of their words among the distinct words of the block, which stand
beside them; every later pass looks a word up once per block.

Levels. A phrase can only be frequent if its first and its last words but one are. Words are counted first; then, level by
level, pairs of neighbouring frequent phrases are summed by 64-bit hashes. Hashes that meet only add, so no candidate is
lost. One level's frequent phrases are sent to the tasks as a sieve of bits with room for ``PART_HASHES``; what it lets
through beyond them finds no partner when the sums meet the phrases. A level is one pass over the texts.

Counting, one pass. The candidates go to the tasks as sieves, one for each number of words. At every text position the
longest run of words that a sieve lets through is taken; equal runs are summed as words. Runs and candidates are dealt to
shards of about ``SHARD_PHRASES`` by their first two words. A task makes a shard's candidates a double-array trie over words:
a word leads from ``state`` to ``base[state] + word`` if ``check`` there names ``state``. numpy moves the states of all runs of
the shard at once, one word a level, and adds their sums to the accepting states. The counts are exact, as words are compared
and not hashes. Every position meets one trie, whatever the number of candidates.

Defined cases: a null text has no words; a null ``lang`` is ``und``; without words there is no row; every row counts,
repeated or not; further columns are not read. Scores are exact for counts below 10**16.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import MAX_PARTITIONS, batch_rows, tune_batches
from .components import stored
from .text import WordHashes, byte_slices, mixed, utf8, window_hashes

MAX_WORDS = 3
MIN_COUNT = 10
SCALE = 1_000_000
# A phrase goes if a longer candidate around it has this percentage of its count.
INSIDE_PERCENT = 50
TOP = 2_000
UNKNOWN = "und"
# Phrases a sieve has room for (32 MB), bits for each, and candidates of one trie.
PART_HASHES, SIEVE_BITS = 16_000_000, 16
SHARD_PHRASES = 100_000
# Texts of one block of numbered words, and blocks that Python gets at a time.
BLOCK_ROWS, BLOCK_BYTES, BLOCKS_AT_ONCE = 4_096, 2 << 20, 8
# Entries a task holds and sums up before it passes them on, and rows it passes on at a time.
FLUSH, OUT_ROWS = 1_000_000, 100_000
_SALTS = 64
# Holes tried for a state's words when a trie is laid out, and states laid out before the holes are listed anew.
_TRIES, _REFRESH = 256, 64
# Bytes of UTF-8 text never have the value 255, so it can stand for the end of a piece.
_BREAK = b"\xff"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_BREAK_HASH = np.uint64(WordHashes()[_BREAK])


def word_hashes(words: list[bytes]) -> np.ndarray:
    """What ``WordHashes`` gives. Words that come once per block are hashed faster than remembered, and take no memory."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def words_of(text: bytes | None) -> list[bytes]:
    """Words, with ``_BREAK`` at the end of every piece."""
    return (text or b"").translate(_TABLE).replace(_BREAK, b" \xff ").split() + [_BREAK]


class Block:
    """Words of texts of one language: the distinct ones, and for every position the number of its word among them."""

    def __init__(self, lang: str, vocabulary: bytes, codes: bytes):
        self.lang, self.vocabulary = lang, vocabulary.split(b" ")
        self.codes = np.frombuffer(codes, np.uint16 if len(self.vocabulary) <= 1 << 16 else np.int32)


def split_words(texts: list[bytes]) -> pa.Array:
    """What ``words_of`` gives for the texts, one after the other, without an object per word."""
    marked = _BREAK.join([*texts, b""]).translate(_TABLE).replace(_BREAK, b" \xff ")
    chars = np.frombuffer(marked, np.uint8)
    inside = chars != 32
    # Every text ends in a break and a blank, so every word has a blank behind it.
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = np.cumsum(inside, dtype=np.int32)[ends]
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside])])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per language of a slice; ``vocabulary`` is joined by blanks, which no word has."""
    for part in byte_slices(batches, "_utf8", BLOCK_ROWS, BLOCK_BYTES):
        by_lang = defaultdict(list)
        for lang, text in zip(part["lang"].to_pylist(), part["_utf8"].to_pylist()):
            by_lang[lang].append(text)
        for lang, texts in by_lang.items():
            coded = split_words(texts).dictionary_encode()
            kind = np.uint16 if len(coded.dictionary) <= 1 << 16 else np.int32
            yield pa.RecordBatch.from_arrays([
                pa.array([lang], pa.string()), pa.array([b" ".join(coded.dictionary.to_pylist())], pa.binary()),
                pa.array([coded.indices.to_numpy().astype(kind).tobytes()], pa.binary())], names=["lang", "vocabulary", "codes"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for lang, vocabulary, codes in zip(batch["lang"], batch["vocabulary"], batch["codes"]):
            yield Block(lang.as_py(), vocabulary.as_py(), codes.as_py())


def prepared(docs: DataFrame) -> DataFrame:
    """The texts as blocks of numbered words, written once for all passes."""
    tune_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), utf8("text").alias("_utf8")).where(
        "_utf8 is not null")
    return stored(texts.mapInArrow(_encode, "lang string, vocabulary binary, codes binary"), "blocks")


def over_blocks(texts: DataFrame, run, schema: str, *keys: str, sums: str, purpose: str, least: int = 0) -> DataFrame:
    """What ``run`` makes of the blocks, in one pass, ``sums`` added up by ``keys``; ``least`` is the smallest sum kept. Written."""
    with batch_rows(texts.sparkSession, BLOCKS_AT_ONCE):
        summed = texts.mapInArrow(run, schema).groupBy(*keys).agg(F.sum(sums).alias(sums))
        return stored(summed.where(F.col(sums) >= least), purpose)


def _in_parts(tables: Iterator[tuple[str, pa.Table]]) -> Iterator[pa.RecordBatch]:
    """Rows of the tables (a language, and ``n`` with other columns); equal ones are summed, about ``FLUSH`` are held."""
    parts, waiting = defaultdict(list), 0

    def merge() -> int:
        for lang, held in parts.items():
            table = pa.concat_tables(held)
            table = table.group_by([c for c in table.column_names if c != "n"]).aggregate([("n", "sum")])
            parts[lang] = [table.rename_columns({"n_sum": "n"})]
        return sum(len(held[0]) for held in parts.values())

    def passed_on() -> Iterator[pa.RecordBatch]:
        for lang in list(parts):
            for batch in parts.pop(lang)[0].to_batches(max_chunksize=OUT_ROWS):
                yield batch.add_column(0, "lang", pa.repeat(pa.scalar(lang, pa.string()), batch.num_rows))

    for lang, table in tables:
        parts[lang].append(table)
        waiting += len(table)
        if waiting > 2 * FLUSH:
            waiting = merge()
            if waiting > FLUSH:
                yield from passed_on()
                waiting = 0
    merge()
    yield from passed_on()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for block in _blocks(batches):
            h = _phrase_hashes(word_hashes(block.vocabulary), block.lang, 1)[0].view(np.int64)
            table = pa.table({"phrase": pa.array(block.vocabulary, pa.binary()), "h": h, "n": np.bincount(block.codes, minlength=len(h))})
            yield block.lang, table.filter(pc.not_equal(table["phrase"], pa.scalar(_BREAK)))
    return _in_parts(found())


def _language_hash(lang: str) -> np.uint64:
    return mixed(np.array([WordHashes()[b"lang " + lang.encode()]], np.uint64))[0]


def _phrase_hashes(single: np.ndarray, lang: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from every word on, given as hashes, and whether they are inside a piece."""
    inside = single != _BREAK_HASH
    whole = inside[:max(0, len(inside) - size + 1)].copy()
    for more in range(1, size):
        whole &= inside[more: more + len(whole)]
    return window_hashes(single, size) ^ _language_hash(lang), whole


def _hashes_of(langs: np.ndarray, phrases: list[bytes], size: int) -> np.ndarray:
    """Hashes of phrases of ``size`` words."""
    h = np.empty(len(phrases), np.uint64)
    for lang in set(langs):
        at = np.flatnonzero(langs == lang)
        # Phrases one after the other; of the runs, those that begin at a phrase's first word.
        words = [w for i in at for w in phrases[i].split(b" ")]
        h[at] = _phrase_hashes(word_hashes(words), lang, size)[0][::size]
    return h


def hashed(phrases: DataFrame, size: int) -> DataFrame:
    """``phrases`` (``lang, phrase, f``) with the hash ``h`` that tasks give the phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = _hashes_of(np.array(batch["lang"].to_pylist(), object), batch["_utf8"].to_pylist(), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["phrase"], batch["f"], pa.array(h)], names=["lang", "phrase", "f", "h"])
    return phrases.select("lang", "phrase", "f", utf8("phrase").alias("_utf8")).mapInArrow(
        run, "lang string, phrase string, f bigint, h bigint")


class Sieve:
    """Bits of hashes: holds all that were put in and, while it has room, few others."""

    def __init__(self, n: int):
        bits = max(8, 1 << (SIEVE_BITS * min(n, PART_HASHES)).bit_length())
        self.last, self.bits = np.uint64(bits - 1), np.zeros(bits >> 3, np.uint8)

    def _places(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for shift in (0, 32):
            place = h >> np.uint64(shift) & self.last
            yield (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)

    def put(self, h: np.ndarray) -> None:
        for at, bit in self._places(h):
            np.bitwise_or.at(self.bits, at, bit)

    def holds(self, h: np.ndarray) -> np.ndarray:
        (at, bit), (other, second) = self._places(h)
        return (self.bits[at] & bit > 0) & (self.bits[other] & second > 0)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch["h"].to_numpy().tobytes()], pa.binary())], names=["packed"])


def sieve_of(phrases: DataFrame) -> Sieve:
    """The sieve of the hashes ``h``, which come to the driver a partition at a time."""
    sieve = Sieve(phrases.count())
    for row in phrases.select("h").mapInArrow(_packed, "packed binary").toLocalIterator(prefetchPartitions=True):
        sieve.put(np.frombuffer(row.packed, np.uint64))
    return sieve


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows of a two-column array as one, with the sum of their counts."""
    rows, n = np.concatenate(pairs), np.concatenate(counts)
    # One sort by both columns mixed; should two rows mix alike, equal ones may stay apart, and Spark adds them up.
    order = np.argsort(mixed(rows[:, 0]) ^ rows[:, 1])
    rows, n = rows[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])) if len(rows) else np.empty(0, np.int64)
    return rows[first], np.add.reduceat(n, first) if len(first) else n


def _neighbours(shared, size: int):
    """A task: pairs of neighbouring phrases of ``size`` words that may both be frequent, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        pairs, counts, waiting = [], [], 0
        for block in _blocks(batches):
            if len(block.codes) <= size:
                continue
            single = word_hashes(block.vocabulary)
            if size == 1:  # judged once per distinct word
                words, inside = _phrase_hashes(single, block.lang, 1)
                h, maybe = words[block.codes], (inside & frequent.holds(words))[block.codes]
            else:
                h, maybe = _phrase_hashes(single[block.codes], block.lang, size)
                at = np.flatnonzero(maybe)
                maybe[at] = frequent.holds(h[at])
            # Both phrases whole and one word apart: all their words are in one piece.
            at = np.flatnonzero(maybe[:-1] & maybe[1:])
            pairs.append(np.stack([h[at], h[at + 1]], axis=1))
            counts.append(np.ones(len(at), np.int64))
            waiting += len(at)
            if waiting > FLUSH:
                rows, n = _summed(pairs, counts)
                pairs, counts, waiting = [rows], [n], len(rows)
                if waiting > FLUSH // 2:
                    yield from _pair_rows(rows, n)
                    pairs, counts, waiting = [], [], 0
        if pairs:
            yield from _pair_rows(*_summed(pairs, counts))
    return run


def _pair_rows(rows: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), OUT_ROWS):
        some = rows[start: start + OUT_ROWS].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(some[:, 0]), pa.array(some[:, 1]), pa.array(n[start: start + OUT_ROWS])],
                                         names=["h1", "h2", "f"])


def grown(texts: DataFrame, frequent: DataFrame, size: int, min_count: int) -> DataFrame:
    """Candidates of ``size + 1`` words (``lang, phrase, f``, never below the true count) from the frequent phrases of ``size``."""
    shared = texts.sparkSession.sparkContext.broadcast(sieve_of(frequent))
    pairs = over_blocks(texts, _neighbours(shared, size), "h1 bigint, h2 bigint, f bigint", "h1", "h2", sums="f", purpose="pairs",
                        least=min_count)
    shared.destroy()
    left = frequent.select("lang", F.col("phrase").alias("p1"), F.col("h").alias("h1"))
    right = frequent.select(F.col("lang").alias("lang2"), F.col("phrase").alias("p2"), F.col("h").alias("h2"))
    last = F.substring_index("p2", " ", -1)
    both = pairs.join(left, "h1").join(right, "h2").where("lang = lang2")
    if size > 1:  # hashes that meet would put phrases together that do not overlap
        both = both.where(F.expr("substring(p1, locate(' ', p1) + 1)") == F.substring_index("p2", " ", size - 1))
    return stored(both.select("lang", F.concat_ws(" ", "p1", last).alias("phrase"), "f"), "candidates")


class Trie:
    """Double array over the words of a shard's phrases; slot 0 is the root, words have the numbers from 1 on."""

    def __init__(self, phrases: pa.Table):
        """``phrases`` has ``lang, phrase`` and ``id``."""
        langs = phrases["lang"].combine_chunks().dictionary_encode()
        words = pc.split_pattern(phrases["phrase"].combine_chunks().cast(pa.binary()), b" ")
        lengths = words.value_lengths().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        # A word of a language: the language's number, a blank, which no word has, and the word.
        of_lang = pc.take(langs.indices.cast(pa.string()).cast(pa.binary()), pa.array(row))
        coded = pc.binary_join_element_wise(of_lang, words.flatten(), b" ").dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        symbols = len(coded.dictionary)
        # Frequent words have small numbers, so that a state's words lie close together.
        number = np.empty(symbols, np.int64)
        number[np.argsort(-np.bincount(codes, minlength=symbols), kind="stable")] = np.arange(1, symbols + 1)
        self.langs, self.named, self.numbers = langs.dictionary.to_pylist(), coded.dictionary, number.astype(np.int32)
        self.symbols, self.levels = symbols, int(lengths.max(initial=0))
        size = 2 * (symbols + 1) + 2 * len(codes)
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[0] = 0
        self.last = 0  # the last slot taken
        self.ids = np.full(size, -1, np.int64)
        matrix = np.zeros((len(lengths), self.levels), np.int64)
        matrix[row, np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = number[codes]
        ids = phrases["id"].to_numpy()
        state = np.zeros(len(lengths), np.int64)
        for level in range(self.levels):
            at = np.flatnonzero(lengths > level)
            edges, inverse = np.unique(np.stack([state[at], matrix[at, level]], axis=1), axis=0, return_inverse=True)
            state[at] = self._place(edges)[inverse.ravel()]
            done = at[lengths[at] == level + 1]
            self.ids[state[done]] = ids[done]
        # Any state and any word give a slot inside the arrays.
        end = int(max(self.base.max() + symbols, self.last)) + 1
        grow = max(0, end - len(self.check))
        self.base = np.concatenate([self.base, np.zeros(grow, np.int64)])[:end].astype(np.int32)
        self.check = np.concatenate([self.check, np.full(grow, -1)])[:end].astype(np.int32)
        # Accepting states name a place among the ids.
        numbers = np.concatenate([self.ids, np.full(grow, -1)])[:end]
        self.names = numbers[numbers >= 0]
        self.ids = np.where(numbers >= 0, np.cumsum(numbers >= 0) - 1, -1).astype(np.int32)

    def known_words(self) -> dict[str, dict[bytes, int]]:
        """Per language the numbers of its words."""
        out: dict[str, dict[bytes, int]] = {lang: {} for lang in self.langs}
        for named, number in zip(self.named.to_pylist(), self.numbers.tolist()):
            lang, word = named.split(b" ")
            out[self.langs[int(lang)]][word] = number
        return out

    def _place(self, edges: np.ndarray) -> np.ndarray:
        """Slots of ``(state, word)`` rows, sorted; gives every state a base at which all its words find free slots."""
        starts = np.flatnonzero(np.concatenate([[True], edges[1:, 0] != edges[:-1, 0]]))
        sizes = np.diff(np.append(starts, len(edges)))
        slots = np.empty(len(edges), np.int64)
        draw, free, placed = np.random.default_rng(0), None, 0
        for g in np.argsort(-sizes, kind="stable"):
            start, n = starts[g], sizes[g]
            if n == 1:
                break
            parent, words = edges[start, 0], edges[start: start + n, 1]
            base = 0
            if parent:
                if placed % _REFRESH == 0:
                    free = np.flatnonzero(self.check[:self.last + 1] < 0)
                placed += 1
                tried = free if len(free) <= _TRIES else free[draw.integers(0, len(free), _TRIES)]
                tried = tried[tried > words[0]] - words[0]
                self._room(self.last + 2 + words[-1])
                tried = tried[tried + words[-1] < len(self.check)]
                good = tried[(self.check[tried[:, None] + words] < 0).all(axis=1)]
                # Behind everything that is taken if no hole fits.
                base = good.min() if len(good) else self.last + 1 - words[0]
            self.base[parent] = base
            slots[start: start + n] = base + words
            self.check[base + words] = parent
            self.last = max(self.last, base + words[-1])
        # A state with one word can take any free slot.
        single = starts[sizes == 1]
        roots = single[edges[single, 0] == 0]
        slots[roots] = edges[roots, 1]
        self.check[slots[roots]] = 0
        self.last = max(self.last, slots[roots].max(initial=0))
        single = single[edges[single, 0] != 0]
        self._room(max(self.last, self.symbols) + len(single) + 1)
        free = np.flatnonzero(self.check < 0)
        free = free[free > self.symbols][:len(single)]
        self.base[edges[single, 0]] = free - edges[single, 1]
        slots[single] = free
        self.check[free] = edges[single, 0]
        self.last = max(self.last, free.max(initial=0))
        return slots

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = size - len(self.check) + len(self.check) // 4
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1)])
            self.ids = np.concatenate([self.ids, np.full(more, -1)])

    def reached(self, symbol: np.ndarray) -> Iterator[np.ndarray]:
        """The accepting states that the positions of a text reach, level by level; a text is its words' numbers."""
        for _, states in self.walked(symbol, np.flatnonzero(symbol)):
            yield states

    def walked(self, symbol: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same from some positions: which of them reach an accepting state, and the states."""
        which, state = np.arange(len(at)), np.zeros(len(at), np.int64)
        for _ in range(self.levels):
            word = symbol[at]
            to = self.base[state] + word
            live = (word > 0) & (self.check[to] == state)
            at, state, which = at[live] + 1, to[live], which[live]
            done = self.ids[state] >= 0
            yield which[done], state[done]
            inside = at < len(symbol)
            at, state, which = at[inside], state[inside], which[inside]


class Numbered:
    """Words of several tries, looked up once: a word's place here, and per trie the number it has there."""

    def __init__(self, tries: list[Trie]):
        self.places: dict[str, dict[bytes, int]] = {}
        total, found = 1, []
        for trie in tries:
            numbers = []
            for lang, words in trie.known_words().items():
                places = self.places.setdefault(lang, {})
                for word, number in words.items():
                    if word not in places:
                        places[word] = total
                        total += 1
                    numbers.append((places[word], number))
            found.append(np.array(numbers, np.int64).reshape(-1, 2))
        self.of_trie = [np.zeros(total, np.int64) for _ in tries]
        for table, pairs in zip(self.of_trie, found):
            table[pairs[:, 0]] = pairs[:, 1]

    def texts(self, lang: str, words: list[bytes]) -> Iterator[np.ndarray]:
        """The words' numbers in each trie, 0 for those it does not have."""
        places = np.fromiter(map(self.places.get(lang, {}).get, words, repeat(0)), np.int64, len(words))
        for table in self.of_trie:
            yield table[places]


def _runs(codes: np.ndarray, at: np.ndarray, size: int, words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct runs of ``size`` numbers below ``words`` that begin at ``at``, a column for each place, and how often each does."""
    columns = [codes[at + k].astype(np.int64) for k in range(size)]
    if words ** size >= 1 << 63:
        rows, n = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
        return list(rows.T), n
    key = columns[0]
    for column in columns[1:]:
        key = key * words + column
    key, n = np.unique(key, return_counts=True)
    for k in reversed(range(size)):
        key, columns[k] = np.divmod(key, words)
    return columns, n


def _windows(shared):
    """A task: at every position the longest run of words that may be a candidate; equal runs, compared as words, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for block in _blocks(batches):
                single, words = word_hashes(block.vocabulary)[block.codes], pa.array(block.vocabulary, pa.binary())
                longest = np.zeros(len(block.codes), np.int64)
                for size in sorted(shared.value):
                    h, whole = _phrase_hashes(single, block.lang, size)
                    at = np.flatnonzero(whole)
                    longest[at[shared.value[size].holds(h[at])]] = size
                for size in shared.value:
                    columns, n = _runs(block.codes, np.flatnonzero(longest == size), size, len(words))
                    yield block.lang, pa.table({
                        "phrase": pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in columns], b" "), "n": n})
        return _in_parts(found())
    return run


def _sized_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases' hashes, by their number of words."""
    for batch in batches:
        langs, sizes = np.array(batch["lang"].to_pylist(), object), batch["size"].to_numpy()
        phrases = batch["_utf8"].to_pylist()
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            h = _hashes_of(langs[at], [phrases[i] for i in at], size)
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([h.tobytes()], pa.binary())], names=["size", "packed"])


def _sieves(candidates: DataFrame) -> dict[int, Sieve]:
    """A sieve for each number of words that candidates have."""
    sized = candidates.select("lang", F.size(F.split("phrase", " ")).alias("size"), utf8("phrase").alias("_utf8"))
    sieves = {row["size"]: Sieve(row["count"]) for row in sized.groupBy("size").count().collect()}
    for row in sized.mapInArrow(_sized_hashes, "size int, packed binary").toLocalIterator(prefetchPartitions=True):
        sieves[row["size"]].put(np.frombuffer(row.packed, np.uint64))
    return sieves


def _count_shard(phrases: pa.Table, windows: pa.Table) -> pa.Table:
    """Counts of a shard's candidates from its runs of words."""
    if len(phrases) == 0:
        return pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "a": pa.array([], pa.int64())})
    trie = Trie(phrases.append_column("id", pa.array(np.arange(len(phrases)))))
    numbered, total = Numbered([trie]), np.zeros(len(trie.names), np.int64)
    for lang in trie.langs:
        mine = windows.filter(pc.equal(windows["lang"], lang))
        words = pc.split_pattern(mine["phrase"].combine_chunks().cast(pa.binary()), b" ")
        lengths = words.value_lengths().to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        number = next(numbered.texts(lang, coded.dictionary.to_pylist()))
        # Runs one after the other, with a 0 behind each, which no word has.
        starts = np.cumsum(lengths) - lengths + np.arange(len(lengths))
        symbol = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
        symbol[np.arange(len(coded)) + np.repeat(np.arange(len(lengths)), lengths)] = number[coded.indices.to_numpy()]
        n = mine["n"].to_numpy()
        for which, states in trie.walked(symbol, starts):
            np.add.at(total, trie.ids[states], n[which])
    at = np.flatnonzero(total)
    rows = phrases.select(["lang", "phrase"]).take(pa.array(trie.names[at]))
    return rows.append_column("a", pa.array(total[at]))


def counted(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """``lang, phrase, a`` with exact counts of the candidates (``lang, phrase``, of two words or more) that stand in the texts."""
    distinct = stored(candidates.select("lang", "phrase").distinct(), "distinct")
    shared = texts.sparkSession.sparkContext.broadcast(_sieves(distinct))
    windows = over_blocks(texts, _windows(shared), "lang string, phrase binary, n bigint", "lang", "phrase", sums="n", purpose="windows")
    shared.destroy()
    windows = windows.withColumn("phrase", F.col("phrase").cast("string"))
    shards = min(max(1, -(-max(distinct.count(), windows.count()) // SHARD_PHRASES)), MAX_PARTITIONS)
    # By the first two words: a run and the candidates it may begin with meet, and phrases that begin alike share states.
    shard = F.pmod(F.xxhash64("lang", F.substring_index("phrase", " ", 2)), F.lit(shards)).cast("int")
    ours, theirs = (t.withColumn("shard", shard).repartition(shards, "shard").groupBy("shard") for t in (distinct, windows))
    return ours.cogroup(theirs).applyInArrow(_count_shard, "lang string, phrase string, a bigint")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates (``lang, phrase, a``) with ``l, r, score`` of their lowest cut."""
    split = phrases.withColumn("_words", F.split("phrase", " "))
    parts = words.select("lang", "phrase", "f").unionByName(phrases.select("lang", "phrase", F.col("a").alias("f")))
    cuts = split.select("lang", "phrase", "a", F.explode(F.transform(F.sequence(F.lit(1), F.size("_words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("_words", F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice("_words", k + 1, F.size("_words") - k), " ").alias("rest")))).alias("c")).select("lang", "phrase", "a", "c.*")
    of_first = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    of_rest = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = cuts.join(of_first, ["lang", "first"]).join(of_rest, ["lang", "rest"])
    exact = F.expr(f"(cast(a as decimal(19,0)) * cast(a as decimal(18,0)) * cast({SCALE} as decimal(7,0))) div "
                   "(cast(l as decimal(19,0)) * cast(r as decimal(18,0)))")
    return wide.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("_least")).select("lang", "phrase", "a", "_least.l", "_least.r", "_least.score")


def outermost(phrases: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Without the phrases inside a longer candidate that has ``percent`` of their count or more."""
    split = phrases.withColumn("_words", F.split("phrase", " ")).where(F.size("_words") > 2)
    size = F.size("_words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("_words", i, n), " "))))
    around = split.select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("_around"))
    return phrases.join(around, ["lang", "phrase"], "left").where(
        F.col("_around").isNull() | (F.lit(100) * F.col("_around") < F.lit(percent) * F.col("a"))).drop("_around")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 percent: int = INSIDE_PERCENT) -> DataFrame:
    """All phrases that stay, with ``lang, phrase, a, l, r, n, score``."""
    texts = prepared(docs)
    counts = over_blocks(texts, _count_words, "lang string, phrase binary, h bigint, n bigint", "lang", "phrase", "h", sums="n", purpose="words")
    words = counts.select("lang", F.col("phrase").cast("string").alias("phrase"), F.col("n").alias("f"), "h")
    level, candidates = words.where(F.col("f") >= min_count), None
    for size in range(1, max_words):
        found = grown(texts, level, size, min_count)
        candidates = found if candidates is None else candidates.unionByName(found)
        if size + 1 < max_words:
            level = stored(hashed(found, size + 1), "level")
    if candidates is None:
        candidates = level.where("false")
    phrases = stored(counted(texts, candidates).where(F.col("a") >= min_count), "phrases")
    kept = outermost(stored(scored(phrases, words), "scored"), percent)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return kept.join(totals, "lang")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of every language; a language's phrases are ranked in ``_SALTS`` parts first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    few = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def report(docs: DataFrame) -> DataFrame:
    return ranked(collocations(docs))


REPORT_SQL = r"""
with piece_words as (
    select row_number() over () as p, lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
    from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
          from documents)),
words as (select lang, unnest(w) as word from piece_words),
totals as (select lang, count(*) as n from words group by lang),
f as (
    select lang, word as phrase, 1 as size, count(*) as f from words group by 1, 2
    union all
    select lang, phrase, size, count(*) from (
        select lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') for i in range(1, len(w) - size + 2)]) as phrase
        from piece_words, (values (2), (3)) s(size) where len(w) >= size) group by 1, 2, 3),
candidates as (select lang, phrase, size, f as a, string_split(phrase, ' ') as w from f where size > 1 and f >= 10),
cuts as (
    select c.lang, c.phrase, c.size, c.a, k, x.f as l, y.f as r,
           (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : k], ' ')
    join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1 : c.size], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_phrases as (
    select lang, array_to_string(w[i : i + 1], ' ') as phrase, max(a) as around
    from (select lang, w, a, unnest([1, 2]) as i from candidates where size = 3) group by 1, 2),
kept as (select b.* from best b left join inner_phrases o on o.lang = b.lang and o.phrase = b.phrase and b.size = 2
         where o.around is null or 100 * o.around < 50 * b.a)
select k.lang, cast(row_number() over (partition by k.lang order by score desc, a desc, encode(phrase)) as bigint) as rank,
       phrase, a, l, r, t.n as n, cast(score as bigint) as score
from kept k join totals t on t.lang = k.lang
qualify row_number() over (partition by k.lang order by score desc, a desc, encode(phrase)) <= 2000
"""
