"""Backward as-of left join on keys of any size, by merged sequences or by validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.operators.ordered import Previous, Running, ordered_windows
from slatecast.session import store


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str,
              values: Sequence[str], by: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Left rows with the ``values`` of the latest right row whose time is
    earlier (``strict``) or not later, inside the same ``by`` keys.

    Distinct left times and right rows are merged into one ordered sequence
    per key; the last right value runs forward over it (split if the key is
    hot), and an equi-join on (by, time) brings it back to the left rows.
    Several right rows at one time: the greatest value struct wins.
    """
    by, values = list(by), list(values)
    picked = F.struct(F.col(right_ts).alias("_t"), *values)
    facts = (right.filter(F.col(right_ts).isNotNull()).groupBy(*by, F.col(right_ts).alias("_t"))
             .agg(F.max(picked).alias("_fact")))
    asks = left.filter(F.col(left_ts).isNotNull()).select(*by, F.col(left_ts).alias("_t")).distinct()
    none = F.lit(None).cast(facts.schema["_fact"].dataType)
    # at equal times a strict question sorts before the fact, an inclusive one after
    side = 0 if strict else 2
    events = store(facts.withColumn("_side", F.lit(1)).unionByName(
        asks.withColumn("_fact", none).withColumn("_side", F.lit(side))), "asof-events")
    ran = ordered_windows(events, by, ["_t", "_side"], {"_last": Running("last", F.col("_fact"))})
    answers = ran.filter(F.col("_side") == side).select(
        *[F.col(b).alias(f"_by_{b}") for b in by], "_t", *[F.col(f"_last.{v}").alias(v) for v in values])
    cond = left[left_ts] == answers["_t"]
    for b in by:
        cond = cond & left[b].eqNullSafe(answers[f"_by_{b}"])
    return left.join(answers, cond, "left").select(left["*"], *[answers[v] for v in values])


def _number(ts: Column, kind: T.DataType) -> Column:
    """Time as a whole number; dates and timestamps in microseconds."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(ts.cast("timestamp"))
    return F.floor(ts).cast("long")


def validity(right: DataFrame, ts: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Facts as intervals: (by, values, valid_from, valid_to); the last one of a key stays open (NULL).

    Several facts at one time: the greatest value struct wins.
    """
    by, values = list(by), list(values)
    picked = F.struct(F.col(ts).alias("_t"), *values)
    facts = store(right.filter(F.col(ts).isNotNull()).groupBy(*by, F.col(ts).alias("_t"))
                  .agg(F.max(picked).alias("_fact")), "facts")
    # a fact ends the one before it
    ran = ordered_windows(facts, by, ["_t"], {"_before": Previous(F.col("_fact"))})
    ended = ran.filter(F.col("_before").isNotNull()).select(
        *by, *[F.col(f"_before.{v}").alias(v) for v in values], F.col("_before._t").alias("valid_from"),
        F.col("_t").alias("valid_to"))
    newest = facts.groupBy(*by).agg(F.max(F.struct("_t", "_fact")).alias("_last"))
    lasting = newest.select(*by, *[F.col(f"_last._fact.{v}").alias(v) for v in values],
                            F.col("_last._t").alias("valid_from"),
                            F.lit(None).cast(facts.schema["_t"].dataType).alias("valid_to"))
    return ended.unionByName(lasting)


def interval_join(left: DataFrame, intervals: DataFrame, left_ts: str, values: Sequence[str], by: Sequence[str] = (),
                  strict: bool = True, bin_width: int | None = None) -> DataFrame:
    """Left rows with the ``values`` of the interval of their key that holds their time.

    ``intervals`` (by, values, valid_from, valid_to) don't overlap inside a key;
    a NULL end is open. Strict: valid_from < time <= valid_to, otherwise
    valid_from <= time < valid_to. Both sides meet on (key, time bin), so a range
    condition never needs a nested loop and a hot key is spread over its bins;
    an interval stands in every bin it touches, which for bins of the mean
    length is about three times in all.
    """
    by, values = list(by), list(values)
    kind = left.schema[left_ts].dataType
    at = _number(F.col(left_ts), kind)
    first, last = left.agg(F.min(at), F.max(at)).first()
    start, end = _number(F.col("valid_from"), kind), _number(F.col("valid_to"), kind)
    if first is None:
        first = last = 0
    cut = intervals.withColumns({"_from": F.greatest(start, F.lit(first)), "_to": F.least(end, F.lit(last))})
    cut = store(cut.filter("_from <= _to"), "intervals")
    if bin_width is None:
        bin_width = max(1, int(cut.agg(F.avg(F.col("_to") - F.col("_from"))).first()[0] or 1))
    number = F.expr(f"sequence(floor(_from / {bin_width}), floor(_to / {bin_width}))")
    binned = cut.select(*[F.col(b).alias(f"_by_{b}") for b in by], *[F.col(v).alias(f"_v_{v}") for v in values],
                        "valid_from", "valid_to", F.explode(number).alias("_bin"))
    asked = left.withColumn("_ask", F.floor(at / bin_width))
    time = F.col(left_ts)
    inside = (F.col("valid_from") < time) & (F.coalesce(time <= F.col("valid_to"), F.lit(True))) if strict else \
        (F.col("valid_from") <= time) & (F.coalesce(time < F.col("valid_to"), F.lit(True)))
    met = (F.col("_ask") == F.col("_bin")) & inside
    for b in by:
        met = met & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return asked.join(binned, met, "left").select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_v_{v}").alias(v) for v in values])
