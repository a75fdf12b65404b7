"""Mixing sources to target weights over a time-varying curriculum.

Every source has a weight schedule: straight lines between knots (time, weight),
time running from 0 to 1 over the training run. Its integral is the source's
weight; integrals share the words to be taken, a source being capped at a
multiple of its own size and its excess going to the others. A source's
documents stand in a fixed pseudo-random order, each covering an interval of
the source's word stream; the inverse of the cumulative demand turns the start
of that interval into the time at which training reaches the document, and a
range sort by time lays the documents out.

Only DataFrame functions are used. The running sum of words never gathers a
source in one task: order hashes are cut into about sqrt(rows) buckets, whose
sums are added up first, and each bucket is then summed by itself.

Defined cases: a null or empty text has size 0 and takes 0 words; a null source
is one source, last in order; a null doc_id is an id of its own; rows of one
doc_id stand in the order of their size, then of a hash of their whole text, and
equal rows are separate documents; an empty table gives an empty result; other
columns may have any names. The document in
which a source's demand ends is taken in part (its first words).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.llm.common import hash60, quoted, store

#: Words of the size rule: runs of anything but blanks and the five control blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Unit-mean shapes that the sources take in turn: rising, level, falling.
SHAPES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (1.0, 0.5)))
WEIGHTS = (3.0, 1.0, 2.0)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pick(values: Sequence, index: Column) -> Column:
    """values[index] for a short list of constants."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def arrival(share: Column, shape: Column, shapes: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """The time at which the integral of schedule number ``shape`` reaches ``share`` of its whole."""
    out = F.lit(None).cast("double")
    for number, knots in enumerate(shapes):
        whole = sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
        done, inverse = 0.0, F.lit(knots[-1][0])
        pieces = []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            slope, area = (w1 - w0) / (t1 - t0), (w0 + w1) / 2 * (t1 - t0)
            left = share * whole - done
            rate = F.lit(w0) + F.sqrt(F.lit(w0 * w0) + F.lit(2.0 * slope) * left)
            at = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * left, rate), F.lit(0.0))
            pieces.append((done + area, at if w0 or w1 else F.lit(t0)))
            done += area
        for until, at in reversed(pieces):
            inverse = F.when(share * whole <= until, at).otherwise(inverse)
        out = F.when(shape == number, inverse).otherwise(out)
    return out


def targets(sources: DataFrame, share: float, cap: float, weights: Sequence[float]) -> DataFrame:
    """Words wanted of each source: (.., place, target).

    ``sources`` has one row per source (source, source_size). A source gets
    min(cap * size, level * weight); the level is where capped sources, in the
    order in which they fill up, leave the rest enough room.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    placed = sources.withColumn("place", F.row_number().over(order) - 1)
    placed = placed.withColumn("weight", pick(weights, F.col("place") % len(weights)))
    placed = placed.withColumn("most", F.col("source_size") * F.lit(cap))
    fill = W.orderBy(F.col("most") / F.col("weight"), "place")
    everything = W.partitionBy()
    level = placed.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share)
         - F.coalesce(F.sum("most").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))).alias("left"),
        F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)).alias("open"))
    level = level.withColumn("level", F.col("left") / F.col("open"))
    # the first source in filling order that isn't capped at its own level
    full = F.col("most") / F.col("weight")
    fits = F.min(F.when(F.col("level") <= full, F.struct(full.alias("at"), "place", "level"))).over(everything)
    first = level.withColumn("level", fits["level"])
    return first.select("source", "source_size", "place",
                        F.when(F.col("level").isNull(), F.col("most"))
                        .otherwise(F.least("most", F.col("level") * F.col("weight"))).alias("target"))


def curriculum(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[float] = WEIGHTS,
               shapes: Sequence[Sequence[tuple[float, float]]] = SHAPES, text: str = "text",
               source: str = "source", doc_id: str = "doc_id", keep: Sequence[str] | None = None) -> DataFrame:
    """Each document with what the mix takes of it and when.

    Returns (doc, size, source_size, target, taken, first, position, again):
    ``doc`` is the row (its columns ``keep``, by default all), ``first`` its
    place in the source's word stream, ``position`` and ``again`` the times of
    its first and second reading (null if it isn't read).
    """
    carried = docs.select(F.struct(*[docs[quoted(c)].alias(c) for c in (keep or docs.columns)]).alias("doc"),
                          docs[source].cast("string").alias("source"), words(docs[text]).alias("size"),
                          docs[doc_id].cast("string").alias("id"), F.xxhash64(docs[text]).alias("mark"))
    carried = carried.withColumn("order", hash60(F.coalesce("id", F.lit(""))))
    carried = carried.select("doc", "size", "id", "mark", "order", F.coalesce("source", F.lit("")).alias("source"),
                             F.col("source").isNull().alias("unnamed"))
    wide = keep is None
    narrow = store(carried.drop("doc") if wide else carried, "mix-sizes")

    count = narrow.count()
    buckets = max(1, int(count ** 0.5))
    bucket = F.floor(F.col("order") / F.lit(float(1 << 60)) * buckets).cast("int")
    sums = narrow.groupBy("source", "unnamed", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    sums = store(sums, "mix-buckets")
    sources = sums.groupBy("source", "unnamed").agg(F.sum("words").alias("source_size"))
    named = sources.select(F.when(~F.col("unnamed"), F.col("source")).alias("source"), "source_size")
    wanted = targets(named, share, cap, weights).select(
        F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("unnamed"),
        "source_size", "place", "target")
    before = W.partitionBy("source", "unnamed").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    offsets = offsets.join(wanted, ["source", "unnamed"])

    body = carried if wide else narrow
    keys = ["source", "unnamed", "bucket"]
    body = body.withColumn("bucket", bucket).join(offsets, keys)
    inside = W.partitionBy(*keys).orderBy("order", "id", "size", "mark").rowsBetween(W.unboundedPreceding, -1)
    body = body.withColumn("first", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))

    quota = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("long")
    rest = quota - rounds * F.col("source_size") - F.col("first")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))

    def when(turn: int) -> Column:
        start = F.col("first") + F.lit(turn) * F.col("source_size")
        share_done = start.cast("double") / F.col("quota")
        return F.when(F.col("taken") > F.lit(turn) * F.col("size"),
                      arrival(share_done, F.col("place") % len(shapes), shapes))

    body = body.withColumns({"quota": quota, "taken": taken.cast("long")})
    return body.select("doc", "size", "source_size", "target", "taken", "first",
                       when(0).alias("position"), when(1).alias("again"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The training order itself: rows of ``docs``, once for each reading, range-sorted by position.

    A reading of less than half a document (where a source's demand ends) is
    left out, more than half is the whole document.
    """
    plan = curriculum(docs, **options)
    readings = plan.select("doc", F.expr(
        "explode(filter(array(struct(position as at, 1 as turn), struct(again as at, 2 as turn)), "
        "r -> r.at is not null and 2 * (taken - (r.turn - 1) * size) >= size))").alias("reading"))
    ordered = readings.select("doc", "reading.at").orderBy("at")
    return ordered.select("doc.*")
