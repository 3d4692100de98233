"""Exact join of documents whose sets of word shingles have a Jaccard similarity of 3/4 or more.

Jaccard distance is a metric over all finite sets, so anything may be a pivot.

*Shingle pivots.* The set of one shingle is a point of the space too: a document is nearer than 1 to it only if it holds the
shingle, and all of a document's shingles are equally near. A document within 1/4 of another misses at
most a quarter of its shingles, so it is enough to put a document into the regions of the first
quarter (and one more) of its shingles, in an order all documents share: rare shingles first. Shingles
that very many documents hold are found from sums over all documents and come last. The order steers
the work, never the result. Regions of a single document end here.

Regions with equal members are one region.

*Document pivots.* In every region that is left, the document with most shared shingles is the pivot. Each document is first compared with
the one pivot it meets in most regions: documents within 1/4 of a pivot are linked to it, and so to each other,
and no pair among them is needed. A region whose documents are all in one component is done. Of the others, those of at most
``LEAF`` documents are the leaves, whose pairs of different components are compared. In larger ones all documents are
compared with the pivot, and the next pivot is the most central document not linked to one, for up to ``PIVOTS`` rounds. Then
a document has its home at its nearest pivot and is copied
into each cell that the triangle inequality leaves open to a partner: distances to that
pivot and to the home differ by no more than twice the radius. Cells are joined, again only pairs of
different components whose distances to every pivot differ by the radius at most, and the pairs compared exactly.

Equal sets are one member from the start. No region is gathered in a task: pivots are minima, members meet them in joins
that adaptive execution splits (it can where both sides come straight from a shuffle, so minima are written first).
Before texts travel, a pair must pass a bound: documents carry the counts of their shingles in buckets of the hash, a
quarter to half as many as they have shingles, and the sum of differences of two such profiles, folded to one
length, is never more than the number of shingles in one set only. Before that, in the joins that make pairs, documents are held against
each other by the odd and even of ``SKETCH_BITS`` buckets, which differ in no more places. A pair that meets in many regions is made in
the first: a member carries the marks of its last ``SEEN`` regions before this one, and what shares one of them has met there. With each
pivot, documents are also compared with the few of their region that chance deals to them: many links among near copies join them before cells are.

Defined cases: a null or empty text has an empty set, size 0, linked with nothing; fewer than five words make
one shingle; rows with one ``doc_id`` are one document for links, each with its own ``n_shingles``;
rows without ``doc_id`` are left out of the join, their ``component_id`` is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import tune_batches
from .components import components, discard, stored
from .text import WordHashes, list_column, slices, utf8, window_hashes

SIZE = 5
# Links need COMMON * intersection >= ... : 100 * intersection >= 75 * union.
PERCENT = 75
RADIUS = 0.25
# Rounds of document pivots in regions of more than LEAF documents.
PIVOTS, LEAF = 3, 256
# Documents in one of the parts that chance deals a larger region to.
DEALT = 32
# Regions before its own that a member names.
SEEN = 16
# A shingle counts as frequent from this many documents on; the list is as long as sums over all documents allow.
FREQUENT, LIST = 32, 500_000
BLOCK = 2_000_000
# Buckets of a profile at least.
LEAST_BUCKETS_LOG2 = 5
# Bits of a sketch, a power of two and whole longs.
SKETCH_BITS = 512
BROADCAST_PAIRS = 1_000_000
# Keys (8 bytes each) that are broadcast to mark rows of a larger table.
BROADCAST_KEYS = 2_000_000


def _lower_words(raw: bytes | None) -> list[bytes]:
    return raw.lower().split() if raw else []


def shingle_set(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(SIZE, len(words))))


def profile_of(found: np.ndarray) -> bytes:
    """Shingles per bucket of the hash's first bits, one byte each."""
    bits = max(LEAST_BUCKETS_LOG2, (len(found) // 4).bit_length())
    counts = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def sketch_of(found: np.ndarray) -> bytes:
    """Whether a bucket of the hash's last bits has an odd number of shingles, one bit each."""
    counts = np.bincount((found & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def least_difference(one: bytes, two: bytes) -> int:
    """A lower bound of the number of shingles that are in one of two sets only."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (one, two))
    size = min(len(a), len(b))
    a, b = (x.reshape(size, -1).sum(axis=1) for x in (a, b))
    return int(np.abs(a - b).sum())


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with size and 128-bit mark of its set; and per block, rows of the shingles found three times or more."""
    hashes, block, held = WordHashes(), [], 0
    names = ["doc_id", "n", "f1", "f2", "profile", "sketch", "token", "docs"]

    def frequent():
        tokens, counts = np.unique(np.concatenate(block), return_counts=True)
        tokens, counts = tokens[counts > 2].view(np.int64), counts[counts > 2]
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, *[pa.nulls(len(tokens), pa.binary())] * 2,
                                           pa.array(tokens), pa.array(counts)], names=names)

    for part in slices(batches):
        sizes, marks, profiles, sketches = [], [], [], []
        for text in part["_utf8"]:
            found = shingle_set(_lower_words(text.as_py()), hashes)
            sizes.append(len(found))
            profiles.append(profile_of(found))
            sketches.append(sketch_of(found))
            marks.append((found.sum(dtype=np.uint64), (found * (found | np.uint64(1))).sum(dtype=np.uint64)))
            block.append(found)
            held += len(found)
        both = np.array(marks, np.uint64).reshape(-1, 2).view(np.int64)
        none = pa.nulls(part.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sizes, pa.int64()), pa.array(both[:, 0].copy()),
                                          pa.array(both[:, 1].copy()), pa.array(profiles, pa.binary()),
                                          pa.array(sketches, pa.binary()), none, none], names=names)
        if held >= BLOCK:
            yield frequent()
            block, held = [], 0
    if block:
        yield frequent()


def _prefixes(shared):
    """``token, doc_id, n, at, late`` for the first quarter of each document's shingles and one more, rare ones first.

    ``at`` is the place in the order, ``late`` the class of the shingle, by which the order goes before the hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        listed, classes = shared.value
        for part in slices(batches):
            tokens, at, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            places, late = [np.empty(0, np.int32)], [np.empty(0, np.int8)]
            for row, text in enumerate(part["_utf8"]):
                found = shingle_set(_lower_words(text.as_py()), hashes)
                n = len(found)
                if not n:
                    continue
                first = n - -(-PERCENT * n // 100) + 1
                rank = np.zeros(n, np.int8)
                if len(listed):
                    spot = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
                    rank = np.where(listed[spot] == found, classes[spot], rank)
                    if rank.any():
                        order = np.argsort(rank, kind="stable")
                        found, rank = found[order], rank[order]
                tokens.append(found[:first])
                late.append(rank[:first])
                places.append(np.arange(first, dtype=np.int32))
                at.append(np.full(first, row))
                sizes.append(np.full(first, n, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), part["doc_id"].take(pa.array(np.concatenate(at))),
                 pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places)), pa.array(np.concatenate(late))],
                names=["token", "doc_id", "n", "at", "late"])
    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact distance and link of each pair, by the shingles themselves."""
    def shingles(raw):
        words = _lower_words(raw)
        return set(zip(*[words[i:] for i in range(SIZE)])) if len(words) >= SIZE else {tuple(words)} if words else set()

    pivot_text, pivot_set = None, set()
    for part in slices(batches):
        distance, linked = [], []
        for own, pivot in zip(part["own"], part["pivot_text"]):
            raw = pivot.as_py()
            if raw != pivot_text:
                pivot_text, pivot_set = raw, shingles(raw)
            mine = shingles(own.as_py())
            common = len(mine & pivot_set)
            union = len(mine) + len(pivot_set) - common
            distance.append(1 - common / union if union else 1.0)
            linked.append(union > 0 and 100 * common >= PERCENT * union)
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], part["pivot"], pa.array(distance, pa.float64()), pa.array(linked, pa.bool_())],
            names=["doc_id", "pivot", "distance", "linked"])


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least distance a pair can have by sizes and profiles, and whether that leaves room for a link."""
    for part in slices(batches, 4096):
        differ = np.fromiter((least_difference(x, y) for x, y in zip(part["px"].to_pylist(), part["py"].to_pylist())),
                             np.int64, part.num_rows)
        nx, ny = (part[c].to_numpy().astype(np.int64) for c in ("nx", "ny"))
        common = np.minimum((nx + ny - differ) // 2, np.minimum(nx, ny))
        union = nx + ny - common
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], part["pivot"], pa.array(1 - common / union), pa.array(100 * common >= PERCENT * union)],
            names=["doc_id", "pivot", "low", "possible"])


def _met(own: DataFrame, pivots: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``own`` and ``pivots`` that are a pair of the written ``pairs``.

    Only what is in a pair travels: pairs are broadcast to the rows where their measured number allows it.
    """
    hint = F.broadcast if pairs.count() <= BROADCAST_PAIRS else (lambda df: df)
    return own.join(hint(pairs), "doc_id").join(pivots.join(hint(pairs.select("pivot")), "pivot", "left_semi"), "pivot")


def compared(docs: DataFrame, profiles: DataFrame, pairs: DataFrame, repeated: bool) -> DataFrame:
    """``doc_id, pivot, low, high, linked`` of the distinct pairs ``doc_id, pivot``: bounds of the distance, equal if exact.

    Only texts of pairs that the bound leaves open travel. Pairs have several rows only where documents are ``repeated``.
    """
    one = profiles.select("doc_id", F.col("n").alias("nx"), F.col("profile").alias("px"))
    two = profiles.select(F.col("doc_id").alias("pivot"), F.col("n").alias("ny"), F.col("profile").alias("py"))
    bounds = _met(one, two, stored(pairs.distinct(), "pairs")).mapInArrow(
        _bound, "doc_id bigint, pivot bigint, low double, possible boolean")
    if repeated:
        bounds = bounds.groupBy("doc_id", "pivot").agg(F.min("low").alias("low"), F.max("possible").alias("possible"))
    bounds = stored(bounds, "bounds")
    own = docs.select("doc_id", utf8("text").alias("own"))
    pivots = docs.select(F.col("doc_id").alias("pivot"), utf8("text").alias("pivot_text"))
    exact = _met(own, pivots, bounds.where("possible").select("doc_id", "pivot")).select("doc_id", "pivot", "own", "pivot_text").mapInArrow(
        _compare, "doc_id bigint, pivot bigint, distance double, linked boolean")
    if repeated:
        exact = exact.groupBy("doc_id", "pivot").agg(
            F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("linked").alias("linked"))
    else:
        exact = exact.select("doc_id", "pivot", F.col("distance").alias("low"), F.col("distance").alias("high"), "linked")
    far = bounds.where("not possible").select("doc_id", "pivot", "low", F.lit(1.0).alias("high"), F.lit(False).alias("linked"))
    return stored(exact.unionByName(far), "compared")


def frequent_list(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, with the log2 class of their number of documents; ``LIST`` entries at most."""
    counts = survey.where("token is not null").groupBy("token").agg(F.sum("docs").alias("docs"))
    total = survey.agg(F.sum("docs")).first()[0] or 0
    # Fewer than LIST shingles can have more than total / LIST documents each.
    rows = counts.where(F.col("docs") > max(FREQUENT, total // LIST)).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(np.maximum(rows["docs"].to_numpy(np.float64)[order], 1)).astype(np.int8)


def _if_small(keys: DataFrame) -> DataFrame:
    """A written table of keys, marked for broadcast where its measured size allows it."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


# The first shingle two documents share leaves room for a link: of what follows it in either, enough can be common.
ROOM = "{p} * least(nx - atx, ny - aty) >= {q} * (nx + ny)".format(p=100 + PERCENT, q=PERCENT)
# The same for the smaller document of a pair alone, whatever its partner.
SHORT = f"{100 + PERCENT} * (n - at) >= {2 * PERCENT} * n"


# Sketches differ in no more bits than there are shingles in one set only, and those are a seventh of both sizes at most.
WORDS = [f"s{i}" for i in range(SKETCH_BITS // 64)]
ALIKE = "{a} * ({bits}) <= {b} * (nx + ny)".format(
    a=100 + PERCENT, b=100 - PERCENT, bits=" + ".join(f"bit_count(x{w} ^ y{w})" for w in WORDS))


def sketches_of(first: DataFrame) -> DataFrame:
    """``doc_id, n`` and the longs of the sketch."""
    return first.select(F.col("member").alias("doc_id"), F.col("n").cast("int").alias("n"), *[
        F.expr(f"cast(conv(hex(substring(sketch, {8 * i + 1}, 8)), 16, -10) as bigint)").alias(w) for i, w in enumerate(WORDS)])


# The pair has not met in a region before this one, as far as both remember.
FIRST = "not arrays_overlap(seenx, seeny)"


def _side(members: DataFrame, side: str, *more: str) -> DataFrame:
    """``members`` as one side of a join of pairs."""
    return members.select("token", F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"), F.col("at").alias(f"at{side}"),
                          F.col("component").alias(f"c{side}"), F.col("seen").alias(f"seen{side}"), *[F.col(w).alias(f"{side}{w}") for w in WORDS], *more)


def documents_of_several_rows(survey: DataFrame) -> DataFrame:
    return stored(survey.where("token is null and doc_id is not null").groupBy("doc_id").count()
                  .where("count > 1").select("doc_id"), "several")


def region_members(docs: DataFrame, survey: DataFrame, first: DataFrame, several: DataFrame, repeated: bool) -> DataFrame:
    """``token, doc_id, n, at, degree, seen``, each once, in the regions two members can be linked in; copies are left to their first document.

    ``seen`` are the marks of the ``SEEN`` regions that come before this one in the document's order, none for documents of several rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_list(survey))
    kept = first.select(F.col("member").alias("doc_id"), "n")
    ids = kept.select("doc_id")
    if repeated:
        kept, ids = kept.distinct(), ids.distinct()
    few = ids.count() <= BROADCAST_KEYS
    source = docs.join(F.broadcast(ids), "doc_id", "left_semi") if few else docs
    rows = prefixes = stored(source.select("doc_id", utf8("text").alias("_utf8")).mapInArrow(
        _prefixes(shared), "token bigint, doc_id bigint, n int, at int, late tinyint"), "prefixes")
    # The smaller document of a linked pair meets the other among the first seventh of its shingles.
    # A document's shingles are distinct: without documents in several rows their number is that of its documents.
    met = F.min("doc_id") < F.max("doc_id") if repeated else F.count("*") > 1
    tokens = stored(rows.groupBy("token").agg(met.alias("met"), F.max(F.expr(SHORT)).alias("short"))
                    .where("met and short").select("token"), "shared")
    rows = rows.join(_if_small(tokens), "token")
    if repeated or not few:
        rows = rows.join(kept.withColumn("n", F.col("n").cast("int")), ["doc_id", "n"])
    rows = stored(rows, "members")
    discard(prefixes)
    # A document in several rows is one member: sums by exclusive-or would cancel it. Without such rows nothing has to move.
    if repeated:
        rows = stored(rows.distinct(), "members")
    # Of equal regions the one earliest in the shared order stays: it is the first that any two of its members share.
    order = F.struct("late", F.col("token").bitwiseXOR(F.lit(-(1 << 63))).alias("place"), "token")
    sets = rows.groupBy("token").agg(
        F.count("*").alias("docs"), F.bit_xor(F.xxhash64("doc_id", "n")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc_id", "n")).alias("x2"), F.first("late").alias("late"))
    # A region's mark is null where another has the same: marks then stand for one region each.
    mark = F.hash("token")
    regions = stored(sets.where("docs > 1").groupBy("docs", "x1", "x2").agg(F.min(order).alias("o")).select("o.token").withColumn(
        "mark", F.when(F.count("*").over(Window.partitionBy(mark)) == 1, mark)), "kept")
    # Documents that share most of their shingles are central: copies of one text meet at the text, not at each other.
    shared_by = stored(rows.groupBy("doc_id").agg(F.count("*").alias("degree")), "degrees")
    rows = rows.drop("late").join(_if_small(regions), "token").join(shared_by, "doc_id")
    if repeated:
        # Places of different rows are in different orders: a pair that meets in one of them may have room in another only.
        rows = rows.join(_if_small(several.withColumn("_several", F.lit(True))), "doc_id", "left").withColumn(
            "mark", F.when(F.col("_several").isNull(), F.col("mark"))).drop("_several")
    before = Window.partitionBy("doc_id").orderBy("at").rowsBetween(-SEEN, -1)
    return rows.withColumn("seen", F.collect_list("mark").over(before)).drop("mark")


def _open_regions(active: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, in the regions that still hold two components or more."""
    named = active.drop("component").join(labels, F.col("doc_id") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "doc_id")).drop("node")
    named = stored(named, "regions")
    mixed = named.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    return named.join(stored(mixed.select("token"), "mixed"), "token")


DISTANCES = "array<struct<low:double,high:double>>"


def _links(found: DataFrame) -> DataFrame:
    return found.where("linked").select(F.col("doc_id").alias("u"), F.col("pivot").alias("v"))


def _pivots(active: DataFrame) -> DataFrame:
    """Per region, its most central document that no earlier pivot is linked to."""
    free = active.where(F.coalesce(F.array_min("distances.high"), F.lit(1.0)) > RADIUS)
    central = F.max(F.struct("degree", (-F.col("doc_id")).alias("negative")))
    return stored(free.groupBy("token").agg(central.alias("p")).select(
        "token", (-F.col("p.negative")).alias("pivot")), "pivots")


def _main_pivot(active: DataFrame) -> DataFrame:
    """Pairs of each document with the pivot it shares most regions with."""
    met = active.join(_pivots(active), "token").where("doc_id <> pivot")
    counts = met.groupBy("doc_id", "pivot").agg(F.count("*").alias("shared"))
    return counts.groupBy("doc_id").agg(F.max(F.struct("shared", "pivot")).alias("p")).select("doc_id", "p.pivot")


def chance_pairs(active: DataFrame, turn: int) -> DataFrame:
    """Pairs of different components that meet in one of a region's parts of about ``DEALT`` documents, dealt anew in every turn.

    In a group where most pairs are links a few pairs for each document join nearly all of it, and its cells hold few others. The number of
    parts is a power of two, so that regions with nearly equal members give equal pairs.
    """
    parts = F.expr(f"shiftleft(1L, greatest(0, cast(ceil(log2(docs / {DEALT})) as int)))")
    dealt = active.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(turn)), parts))
    met = _side(dealt.where(SHORT), "x", "part").join(_side(dealt, "y", "part"), ["token", "part"]).where(
        (F.col("cx") != F.col("cy")) & F.expr("(nx < ny or nx = ny and x > y)") & F.expr(ROOM) & F.expr(ALIKE) & F.expr(FIRST))
    return met.select(F.greatest("x", "y").alias("doc_id"), F.least("x", "y").alias("pivot"))


def _pivot_round(docs: DataFrame, profiles: DataFrame, active: DataFrame, turn: int, repeated: bool) -> tuple[DataFrame, DataFrame]:
    """Members with the bounds of one more distance, and the links found, those of ``chance_pairs`` too."""
    met = active.join(_pivots(active), "token", "left")
    found = compared(docs, profiles, met.where("doc_id <> pivot").select("doc_id", "pivot").unionByName(chance_pairs(active, turn)), repeated)
    own = F.col("doc_id") == F.col("pivot")
    bounds = F.struct(F.when(own, 0.0).otherwise(F.col("low")).alias("low"),
                      F.when(own, 0.0).otherwise(F.col("high")).alias("high"))
    with_distance = met.join(found.drop("linked"), ["doc_id", "pivot"], "left").withColumn(
        "distances", F.when(F.col("pivot").isNull(), F.col("distances")).otherwise(
            F.concat("distances", F.array(bounds).cast(DISTANCES))))
    return stored(with_distance.drop("pivot", "low", "high"), "regions"), _links(found)


def leaf_pairs(leaves: DataFrame) -> DataFrame:
    """Pairs of different components in regions of a few documents."""
    met = _side(leaves.where(SHORT), "x").join(_side(leaves, "y"), "token").where(
        (F.col("cx") != F.col("cy")) & F.expr("(nx < ny or nx = ny and x > y)") & F.expr(ROOM) & F.expr(ALIKE) & F.expr(FIRST))
    return met.select(F.greatest("x", "y").alias("doc_id"), F.least("x", "y").alias("pivot"))


def _split(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves, and larger regions with their number of members ``docs``."""
    large = stored(active.groupBy("token").agg(F.count("*").alias("docs")).where(F.col("docs") > LEAF), "large")
    return active.join(_if_small(large.select("token")), "token", "left_anti"), active.join(_if_small(large), "token")


def cell_pairs(active: DataFrame) -> DataFrame:
    """Pairs to compare: members of different components that meet in a Voronoi cell of their region.

    A member's home is the pivot with the least upper bound of its distance; a partner at the radius or nearer has its
    home there too, or at a pivot no further from the partner than twice the radius more than its own home.
    """
    rounding = 1e-9
    home = F.expr("array_position(distances.high, array_min(distances.high))")
    here = _side(active, "x", F.col("distances").alias("dx"), home.alias("cell"))
    there = _side(active, "y", F.col("distances").alias("dy"), F.posexplode("distances").alias("at", "d")).where(
        F.col("d.low") - F.array_min("dy.high") <= 2 * RADIUS + rounding).withColumn("cell", F.col("at") + 1)
    apart = F.exists(F.zip_with("dx", "dy", lambda a, b: F.greatest(a["low"] - b["high"], b["low"] - a["high"])),
                     lambda gap: gap > RADIUS + rounding)
    met = here.join(there, ["token", "cell"]).where((F.col("cx") != F.col("cy")) & F.expr(ROOM) & F.expr(ALIKE) & ~apart & F.expr(FIRST))
    return met.select(F.greatest("x", "y").alias("doc_id"), F.least("x", "y").alias("pivot")).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    spark = tune_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    survey = stored(docs.select("doc_id", utf8("text").alias("_utf8")).mapInArrow(
        _survey, "doc_id bigint, n bigint, f1 bigint, f2 bigint, profile binary, sketch binary, token bigint, docs bigint"), "survey")
    rows = survey.where("token is null").select("doc_id", "n", "f1", "f2", "profile", "sketch")
    sets = rows.where("n > 0 and doc_id is not null")
    first = stored(sets.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("member"), F.min("profile").alias("profile"),
                                                       F.min("sketch").alias("sketch")), "first")
    several = documents_of_several_rows(survey)
    repeated = not several.isEmpty()
    members = sets.drop("profile", "sketch").join(first.drop("profile", "sketch"), ["n", "f1", "f2"]).select("doc_id", "n", "member")
    members = stored(members.distinct() if repeated else members, "members")
    profiles = first.select(F.col("member").alias("doc_id"), "n", "profile")
    texts = docs.where("doc_id is not null")

    active = stored(region_members(texts, survey, first, several, repeated).withColumn(
        "distances", F.expr(f"cast(array() as {DISTANCES})")), "regions")
    links = _links(compared(texts, profiles, _main_pivot(active), repeated))
    if repeated:
        # One document with several sets: its sets count as linked.
        same = members.groupBy("doc_id").agg(F.min("member").alias("v"), F.max("member").alias("u")).where("u <> v")
        links = links.unionByName(members.join(same.select("doc_id", "v"), "doc_id").select(F.col("member").alias("u"), "v"))
    labels = components(spark, links)
    active = stored(_open_regions(active, labels).join(sketches_of(first), ["doc_id", "n"]), "regions")
    leaves, large = _split(active)
    pairs = leaf_pairs(leaves)
    large = stored(large, "regions")
    for turn in range(PIVOTS):
        if large.isEmpty():
            break
        large, new = _pivot_round(texts, profiles, large, turn, repeated)
        labels = components(spark, new, labels)
        large = stored(_open_regions(large, labels), "regions")
    if not large.isEmpty():
        pairs = pairs.unionByName(cell_pairs(large))
    labels = components(spark, _links(compared(texts, profiles, pairs, repeated)), labels)
    ends = members.join(labels, F.col("member") == F.col("node"), "left").select(
        "doc_id", "n", F.coalesce("component", "member").alias("_component"))
    if repeated:
        ends = ends.groupBy("doc_id", "n").agg(F.min("_component").alias("_component"))
    return rows.select("doc_id", "n").join(ends, ["doc_id", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("_component", "doc_id").alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: of the document with the smallest id, the row with the longest text.

    Rows without id are not compared, not even with each other, and all stay.
    """
    gone = stored(jaccard_components(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(_if_small(gone), docs["doc_id"] == gone["_gone"], "left_anti")
    again = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(
        F.col("doc_id").alias("_again")), "again")
    if again.isEmpty():
        return kept
    # Only texts of ids in several rows move.
    several = F.col("doc_id") == F.col("_again")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last(), F.xxhash64("text")))
    one = kept.join(_if_small(again), several, "left_semi").withColumn("_rank_of_row", rank).where("_rank_of_row = 1").drop("_rank_of_row")
    return kept.join(_if_small(again), several, "left_anti").unionByName(one)


REPORT_SQL = r"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct r, doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') as g
      from (select r, doc_id, w, unnest(range(1, cast(len(w) as bigint) - least(5, len(w)) + 2)) as i from d where len(w) > 0)),
n as (select r, doc_id, count(*) as n from s group by r, doc_id),
reps as (select min(doc_id) as doc_id, k, any_value(n) as n from
         (select doc_id, count(*) as n, md5(string_agg(g, '|' order by g)) as k from s group by r, doc_id) group by k),
q as (select s.doc_id, g from s join reps using (doc_id)),
f as (select g from q group by g having count(*) > 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from (q join f using (g)) a join (q join f using (g)) b
      on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join reps nx on x = nx.doc_id join reps ny on y = ny.doc_id
      where 100 * c >= 75 * (nx.n + ny.n - c)),
copies as (select a.doc_id as x, b.doc_id as y from
         (select doc_id, md5(string_agg(g, '|' order by g)) as k from s group by r, doc_id) a
         join reps b on a.k = b.k and a.doc_id <> b.doc_id),
sym as (select x, y from e union select y, x from e union select x, y from copies union select y, x from copies),
reach(x, y) as (select x, y from sym union select reach.x, sym.y from reach join sym on reach.y = sym.x),
lowest as (select x, least(x, min(y)) as m from reach group by x)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(m, d.doc_id) as component_id
from d left join n using (r) left join lowest on lowest.x = d.doc_id
"""
