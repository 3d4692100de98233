"""Mixing sources to target weights along a curriculum that changes over training time.

Each source has a target number of words: all targets are ``share`` times all words, split by weight, none above
``max_repeats`` times its source's size, the excess shared again by weight. A source's weight over training time
``t`` in [0, 1] is its target times a schedule, piecewise linear between ``KNOTS`` and integrating to 1. A source's
documents stand in a fixed pseudo-random order and repeat from the start; the words before a document in that order are its
cumulative demand, and the time at which the integral of the schedule reaches that part of the target is its
training position. The mix is the documents sorted by position.

Running sums do not put a source into one task: a source is cut into buckets of about ``BUCKET_ROWS`` documents by
the order's hash, sums run inside buckets, and bucket totals are summed before them. Per-source values
are joined with broadcast only if the measured number of sources allows it.

Defined cases: a null or empty text has size 0 and is never taken; a source of size 0 has target 0; the null source is a
source, last in order; with no words at all every target is 0; the document at the end of a target is taken in part;
equal documents stand in order of their text's hash, and exact copies with one id take turns in any order, having equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import run_dir
from .components import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2.0
BUCKET_ROWS = 2_000
BROADCAST_SOURCES = 100_000
# Times at which schedules may bend, and schedule heights by weight class: heavy sources early, light ones late.
KNOTS = (0.0, 0.5, 1.0)
SCHEDULES = ((1.5, 1.0, 0.5), (0.5, 1.5, 0.5), (0.5, 1.0, 1.5))
_BUCKETS = "_buckets"


def sized(docs: DataFrame) -> DataFrame:
    """Size, source and order of every document; the text is read once and does not go on."""
    text = F.coalesce("text", F.lit(""))
    words = F.char_length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), r"[\x20\x09-\x0D]+", ""))
    order = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("order")))
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), words.cast("long").alias("size"),
        order.alias("_order"), F.xxhash64(text).alias("_tie"))


def _targets(sources: DataFrame, weights: tuple, share: float, max_repeats: float) -> DataFrame:
    """``sources`` with ``target``: shares by weight, with a limit, the excess shared again among the others.

    Sources reach their limit in order of limit per weight. With all before source i at their limits, the others share the
    rest at a level that rises with i as long as source i would go over its limit at it, and falls after that: the final
    level is the highest of them, and running sums over the sources give them all.
    """
    ranked = sources.withColumn("_class", (F.row_number().over(
        Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_class") + 1)
    limits = ranked.withColumns({"_weight": weight, "_limit": F.lit(max_repeats) * F.col("source_size")})
    by_level = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    wanted = F.lit(share) * F.sum("source_size").over(everything)
    level = (F.col("_wanted") - F.col("_full")) / F.col("_open")
    levels = (limits.withColumns({"_wanted": wanted, "_full": F.coalesce(F.sum("_limit").over(before), F.lit(0.0)),
                                  "_open": F.sum("_weight").over(after)})
              .withColumn("_final", F.max(level).over(everything)))
    return levels.select("source", "source_size", "_docs", "_class", F.least(
        F.col("_limit"), F.col("_final") * F.col("_weight")).alias("target"))


def _time(done: Column, kind: Column, knots: tuple, schedules: tuple) -> Column:
    """Time at which the integral of schedule number ``kind`` reaches the part ``done`` of its whole."""
    out = F.lit(1.0)
    for number, heights in reversed(list(enumerate(schedules))):
        areas = [(b - a) * (p + q) / 2 for a, b, p, q in zip(knots, knots[1:], heights, heights[1:])]
        total, before, inverse = sum(areas), 0.0, []
        for a, b, p, q, area in zip(knots, knots[1:], heights, heights[1:], areas):
            # p*x + slope*x*x/2 = need, in the form that also holds for a level piece
            need, slope = F.greatest(done * total - before, F.lit(0.0)), (q - p) / (b - a)
            at = a + 2 * need / (p + F.sqrt(F.greatest(F.lit(p * p) + 2 * slope * need, F.lit(0.0))))
            before += area
            inverse.append((before / total, F.least(at, F.lit(float(b)))))
        piece = inverse[-1][1]
        for end, at in reversed(inverse[:-1]):
            piece = F.when(done < end, at).otherwise(piece)
        out = F.when(kind == number, piece).otherwise(out)
    return out


def plan_mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS,
             knots: tuple = KNOTS, schedules: tuple = SCHEDULES) -> DataFrame:
    """Per document: ``size, source_size, target, taken`` and ``positions``, the training times of its copies."""
    spark = docs.sparkSession
    path, totals_path = run_dir(spark, "sizes"), run_dir(spark, "sources")
    sized(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    _targets(sources, weights, share, max_repeats).write.parquet(totals_path)
    totals = spark.read.parquet(totals_path).withColumn(
        _BUCKETS, F.ceil(F.col("_docs") / BUCKET_ROWS).cast("long")).drop("_docs").withColumnRenamed("source", "_source")
    if totals.count() <= BROADCAST_SOURCES:
        totals = F.broadcast(totals)
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    # The first 52 bits of the order, as a number in [0, 1), say which bucket a document is in.
    place = F.conv(F.substring("_order", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    placed = rows.join(totals, same_source).drop("_source").withColumn(
        "_bucket", F.floor(place * F.col(_BUCKETS)).cast("long"))
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id", "_tie").rowsBetween(
        Window.unboundedPreceding, -1)
    summed = placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    buckets = placed.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    offsets = buckets.select(
        F.col("source").alias("_source"), F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_words").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    located = summed.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
    start = F.col("_offset") + F.col("_before")
    target = F.floor("target").cast("long")
    # Copy number c of a document takes the words from c * source_size + start on, as far as the target goes.
    rounds = max(1, -(-int(max_repeats * 1000) // 1000))
    copies = [(F.lit(c) * F.col("source_size") + F.col("_start")) for c in range(rounds)]
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), F.col("_words_due") - at)) for at in copies), F.lit(0))
    times = F.array(*[F.when((F.col("size") > 0) & (at < F.col("_words_due")), F.round(
        _time(at / F.col("_words_due"), F.col("_class"), knots, schedules), 9)) for at in copies])
    return (located.withColumns({"_start": start, "_words_due": target})
            .select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                    F.array_compact(times).alias("positions"), "_tie"))


def _ordered(plan: DataFrame, *more: str) -> DataFrame:
    copies = plan.select("doc_id", F.col("_tie").alias("text_hash"), "source", "size", "taken", *more,
                         F.posexplode("positions").alias("copy", "position"))
    words = F.least("size", F.col("taken") - F.col("copy") * F.col("size"))
    return copies.select("doc_id", "text_hash", "source", "size", "copy", words.alias("words"), "position", *more).orderBy(
        "position", "source", "doc_id", "copy")


def training_order(docs: DataFrame) -> DataFrame:
    """The mix itself: one row per copy of a document, ``position`` and ``words`` taken, sorted by position."""
    return _ordered(plan_mix(docs))


def written_mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The plan and the mix, both written: the mix range-sorted by position, ``_number`` names the plan's row of a copy."""
    plan = stored(plan_mix(docs).withColumn("_number", F.monotonically_increasing_id()), "plan")
    return plan, stored(_ordered(plan, "_number"), "mix")


def documents_of_mix(docs: DataFrame) -> DataFrame:
    """Per document what the written mix holds of it: words ``taken``, first ``position`` and ``positions`` of all copies."""
    plan, mix = written_mix(docs)
    # A document has as many copies as its source is repeated.
    places = mix.groupBy("_number").agg(F.sum("words").alias("_words"), F.sort_array(F.collect_list("position")).alias("_places"))
    return plan.join(places, "_number", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("_words", F.lit(0)).cast("long").alias("taken"),
        F.when(F.size("_places") > 0, F.element_at("_places", 1)).alias("position"),
        F.coalesce("_places", F.array().cast("array<double>")).alias("positions"))


def report(docs: DataFrame) -> DataFrame:
    """``documents_of_mix`` in the columns of the checking SQL, which names the first position only."""
    return documents_of_mix(docs).drop("positions")


REPORT_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
                  md5(coalesce(cast(doc_id as varchar), '') || '|order') as o from documents),
s as (select source, sum(size) as source_size from d group by source),
c as (select *, (row_number() over (order by source is null, encode(source)) - 1) % 3 as class from s),
w as (select *, case class when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
             2.0::double * source_size as lim, 1.5::double * (select sum(source_size) from s) as wanted from c),
lv as (select *, (wanted - coalesce(sum(lim) over (order by lim / weight, source is null, encode(source) rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by lim / weight, source is null, encode(source) rows between current row and unbounded following) as lev from w),
t as (select source, source_size, class, least(lim, weight * (select max(lev) from lv)) as target from lv),
p as (select d.*, source_size, target, class, floor(target) as due,
             coalesce(sum(size) over (partition by d.source order by o, doc_id rows between unbounded preceding and 1 preceding), 0) as start
      from d join t on d.source is not distinct from t.source),
f as (select *, start / nullif(due, 0)::double as done from p),
g as (select *, case class when 0 then
        case when done < 0.625::double then 2 * greatest(done, 0) / (1.5::double + sqrt(2.25::double - 2 * done))
             else least(0.5::double + 2 * greatest(done - 0.625::double, 0) / (1.0::double + sqrt(greatest(1.0::double - 2 * (done - 0.625::double), 0))), 1.0) end
      when 1 then
        case when done < 0.5::double then 2 * greatest(done, 0) / (0.5::double + sqrt(0.25::double + 4 * done))
             else least(0.5::double + 2 * greatest(done - 0.5::double, 0) / (1.5::double + sqrt(greatest(2.25::double - 4 * (done - 0.5::double), 0))), 1.0) end
      else
        case when done < 0.375::double then 2 * greatest(done, 0) / (0.5::double + sqrt(0.25::double + 2 * done))
             else least(0.5::double + 2 * greatest(done - 0.375::double, 0) / (1.0::double + sqrt(1.0::double + 2 * (done - 0.375::double))), 1.0) end
      end as due_at from f)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
       cast(greatest(0, least(size, due - start)) + greatest(0, least(size, due - start - source_size)) as bigint) as taken,
       case when size > 0 and start < due then round(due_at, 9) end as position
from g
"""
