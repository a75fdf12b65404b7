"""Running, recent-n and previous-row columns over ordered groups of any size.

A plain window puts a whole group on one task. That is right for the usual
group and wrong for one that holds a third of the table, so the groups are
counted first and only those above the limit take the split path:

1. hot rows are range-partitioned by (keys, order), sorted and written; the
   row's place in its file plus the row counts of earlier files give its exact
   position in its group;
2. positions are cut into blocks of fixed length, and the last few rows of a
   block are copied into the next one so bounded frames stay exact;
3. running columns are computed inside a block and joined with the totals of
   the blocks before it.

Every step works on pieces of at most ``max_rows`` rows (plus the copied
rows), so no task grows with the hottest group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.session import max_group_rows, store


@dataclass(frozen=True)
class Running:
    """Aggregate of all earlier rows; ``within`` narrows the group (its value can't use the index)."""

    how: str                      # count | sum | max | min | last
    value: Column | None = None   # last: latest non-NULL value
    within: tuple[str, ...] = ()


@dataclass(frozen=True)
class Recent:
    """Aggregate of the last ``rows`` rows."""

    how: str                      # avg | sum | count | max | min
    value: Column | None
    rows: int


@dataclass(frozen=True)
class RecentMeans:
    """Means over several last-n windows at once, NULLs skipped; the output
    name is followed by each n.

    Rows are summed between consecutive lengths (rows 1-5, 6-10, 11-20, ...)
    and the pieces added up. A piece as long as all before it (6-10 after 1-5)
    is the total that the row so many places before has found already, one
    look instead of a frame; only other pieces are summed row by row.
    """

    value: Column
    rows: tuple[int, ...]

    def pieces(self) -> list[tuple[int, int]]:
        ends = sorted(self.rows)
        return [(start + 1, end) for start, end in zip([0, *ends], ends)]


@dataclass(frozen=True)
class Previous:
    """Value of the row before."""

    value: Column


Spec = Running | Recent | RecentMeans | Previous


def _columns(outputs: Mapping[str, Spec]) -> list[str]:
    return [c for name, spec in outputs.items()
            for c in ([f"{name}{n}" for n in spec.rows] if isinstance(spec, RecentMeans) else [name])]


def _with_means(df: DataFrame, cols: dict[str, Column], outputs: Mapping[str, Spec], seq,
                include_current: bool) -> DataFrame:
    """Add ``cols`` and every RecentMeans output, from the shortest length to the longest."""
    shift = 1 if include_current else 0
    specs = {n: s for n, s in outputs.items() if isinstance(s, RecentMeans)}
    if not specs:
        return df.withColumns(cols)
    for level in range(max([len(s.rows) for s in specs.values()], default=0)):
        pieces, totals, means, done = {}, {}, {}, []
        for name, spec in specs.items():
            if level >= len(spec.rows):
                continue
            near, far = spec.pieces()[level]
            total, n = f"_s_{name}", f"_c_{name}"
            if level and far - near + 1 == near - 1:
                pieces |= {f"{total}_": F.lag(total, near - 1).over(seq), f"{n}_": F.lag(n, near - 1).over(seq)}
            else:
                frame = seq.rowsBetween(shift - far, shift - near)
                pieces |= {f"{total}_": F.sum(spec.value.cast("double")).over(frame),
                           f"{n}_": F.count(spec.value).over(frame)}
            for c, zero in ((total, 0.0), (n, 0)):
                piece = F.coalesce(F.col(f"{c}_"), F.lit(zero))
                totals[c] = F.col(c) + piece if level else piece
            means[f"{name}{far}"] = F.col(total) / F.nullif(F.col(n), F.lit(0))
            done += [total, n] if level + 1 == len(spec.rows) else []
        df = df.withColumns(pieces if level else {**cols, **pieces}).withColumns(totals).drop(*pieces).withColumns(means).drop(*done)
    return df


_BUILTIN = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}


def _aggregate(how: str, value: Column | None, keep: Column | None = None) -> Column:
    if value is None:
        value = F.lit(1)
    if keep is not None:
        value = F.when(keep, value)
    return _BUILTIN[how](value)


def ordered_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    outputs: Mapping[str, Spec], *, index: str | None = None,
                    include_current: bool = False, max_rows: int | None = None,
                    sized_by: DataFrame | None = None) -> DataFrame:
    """Add ``outputs`` to ``df``; frames end before the current row unless
    ``include_current``. ``index`` names a 1-based position column, which the
    output values may use. (keys, order) should be unique per row, and ``df``
    cheap to read twice (a table or a stored result), for it is read once to
    count groups; ``sized_by`` names another table with the same keys to count
    instead.
    """
    keys, order = list(keys), list(order)
    if not keys:   # one group: give it a key, the count below decides how it runs
        out = ordered_windows(df.withColumn("_all", F.lit(0)), ["_all"], order, outputs, index=index,
                              include_current=include_current, max_rows=max_rows,
                              sized_by=None if sized_by is None else sized_by.withColumn("_all", F.lit(0)))
        return out.drop("_all")
    limit = max_rows or max_group_rows(df.sparkSession)
    hot = _hot_groups(df if sized_by is None else sized_by, keys, limit)
    idx = index or "_idx"
    if hot is None:
        return _plain(df, keys, order, outputs, idx, index is not None, include_current)
    if sized_by is not None:
        df = store(df, "windowed")
    cold_rows = df.join(hot, _same(df, hot, keys), "left_anti")
    hot_rows = df.join(hot, _same(df, hot, keys), "left_semi")
    cold = _plain(cold_rows, keys, order, outputs, idx, index is not None, include_current)
    split = _split(hot_rows, keys, order, outputs, idx, include_current, limit)
    return cold.unionByName(split.select(*cold.columns))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_hot_{k}"])
    return cond


def _hot_groups(df: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Groups above the limit as a stored table: at most rows / limit of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    hot = counts.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    return None if hot.isEmpty() else store(hot, "hot-groups")


def _plain(df, keys, order, outputs, idx, with_index, include_current) -> DataFrame:
    ordering = [F.col(c).asc_nulls_last() for c in order]
    seq = W.partitionBy(*keys).orderBy(*ordering)
    before = df.columns
    last = 0 if include_current else -1
    cols, narrowed = {}, {}
    for name, spec in outputs.items():
        if isinstance(spec, RecentMeans):
            continue
        if isinstance(spec, Previous):
            cols[name] = F.lag(spec.value).over(seq)
        elif isinstance(spec, Recent):
            first = -(spec.rows - 1) if include_current else -spec.rows
            cols[name] = _aggregate(spec.how, spec.value).over(seq.rowsBetween(first, last))
        else:
            part = W.partitionBy(*keys, *spec.within).orderBy(*ordering)
            frame = part.rowsBetween(W.unboundedPreceding, last)
            mine = narrowed if spec.within else cols
            if spec.how == "last":
                mine[name] = F.last(spec.value, ignorenulls=True).over(frame)
            else:
                mine[name] = _aggregate(spec.how, spec.value).over(frame)
    names = [*before, *([idx] if with_index else []), *_columns(outputs)]
    # narrower groups need a sort of their own: first, while rows are narrow; the next one serves all the rest
    df = df.withColumns(narrowed)
    if with_index:
        df = df.withColumn(idx, F.row_number().over(seq).cast("long"))
    return _with_means(df, cols, outputs, seq, include_current).select(*names)


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                  limit: int) -> DataFrame:
    """Exact 1-based position of each row in its group, without one task per group."""
    spark = df.sparkSession
    total = df.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // limit))
    ordering = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    # the id is (file number << 33) + row number in the file; writing it pins it
    placed = store(df.repartitionByRange(parts, *ordering).sortWithinPartitions(*ordering)
                   .withColumn("_place", F.monotonically_increasing_id()), "placed")
    chunk = F.shiftright("_place", 33).alias("_chunk")
    pieces = placed.groupBy(*keys, chunk).agg(F.min("_place").alias("_first"),
                                              F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    # one row per (group, file): stored so that the join below sees its true size
    starts = store(pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
                   .select(*[F.col(k).alias(f"_hot_{k}") for k in keys],
                           F.col("_chunk").alias("_hot_chunk"), "_first", "_before"), "starts")
    placed = placed.withColumn("_chunk", F.shiftright("_place", 33))
    joined = placed.join(starts, _same(placed, starts, keys)
                         & (placed["_chunk"] == starts["_hot_chunk"]))
    position = (F.col("_before") + F.col("_place") - F.col("_first") + 1).cast("long")
    return joined.withColumn(name, position).select(*df.columns, name)


def _split(df, keys, order, outputs, idx, include_current, limit) -> DataFrame:
    lookback = max([1] + [s.rows for s in outputs.values() if isinstance(s, Recent)]
                   + [max(s.rows) for s in outputs.values() if isinstance(s, RecentMeans)])
    length = max(limit, lookback)
    rows = with_position(df, keys, order, idx, limit)
    rows = rows.withColumn("_block", F.expr(f"({idx} - 1) div {length}"))
    source = rows.columns

    # copy the tail of every block into the next one
    tail = F.col(idx) - 1 - F.col("_block") * length >= length - lookback
    copies = F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = rows.withColumn("_copy", F.explode(copies)) \
                 .withColumn("_block", F.col("_block") + F.col("_copy"))
    own = F.col("_copy") == 0

    seq = W.partitionBy(*keys, "_block").orderBy(idx)
    last = 0 if include_current else -1
    cols = {}
    for name, spec in outputs.items():
        if isinstance(spec, RecentMeans):
            continue
        if isinstance(spec, Previous):
            cols[name] = F.lag(spec.value).over(seq)
        elif isinstance(spec, Recent):
            first = -(spec.rows - 1) if include_current else -spec.rows
            cols[name] = _aggregate(spec.how, spec.value).over(seq.rowsBetween(first, last))
        else:
            part = W.partitionBy(*keys, *spec.within, "_block").orderBy(idx)
            frame = part.rowsBetween(W.unboundedPreceding, last)
            if spec.how == "last":
                cols[name] = F.last(F.when(own, spec.value), ignorenulls=True).over(frame)
            else:
                cols[name] = _aggregate(spec.how, spec.value, own).over(frame)
    out = _with_means(spread, cols, outputs, seq, include_current).filter(own).drop("_copy")

    running = {n: s for n, s in outputs.items() if isinstance(s, Running)}
    for within in {s.within for s in running.values()}:
        mine = {n: s for n, s in running.items() if s.within == within}
        group = [*keys, *within]
        totals = rows.groupBy(*group, "_block").agg(*[_total(n, s, idx) for n, s in mine.items()])
        earlier = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
        carried = [_carry(n, s, earlier) for n, s in mine.items()]
        # one row per block and group: stored so that the join sees its true size
        carry = store(totals.select(*[F.col(g).alias(f"_hot_{g}") for g in group],
                                    F.col("_block").alias("_hot_block"), *carried), "carry")
        out = out.join(carry, _same(out, carry, group)
                       & (out["_block"] == carry["_hot_block"]), "left")
        out = out.withColumns({n: _combine(n, s) for n, s in mine.items()})
        out = out.drop("_hot_block", *[f"_hot_{g}" for g in group],
                       *[f"_carry_{n}" for n in mine])
    return out.select(*[c for c in source if c != "_block"], *_columns(outputs))


def _total(name: str, spec: Running, idx: str) -> Column:
    if spec.how == "last":
        return F.max_by(spec.value, F.when(spec.value.isNotNull(), F.col(idx))).alias(name)
    return _aggregate(spec.how, spec.value).alias(name)


def _carry(name: str, spec: Running, earlier) -> Column:
    if spec.how == "last":
        value = F.last(F.col(name), ignorenulls=True)
    else:
        value = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[spec.how](name)
    return value.over(earlier).alias(f"_carry_{name}")


def _combine(name: str, spec: Running) -> Column:
    here, before = F.col(name), F.col(f"_carry_{name}")
    if spec.how == "count":
        return here + F.coalesce(before, F.lit(0))
    if spec.how == "sum":
        return F.coalesce(here + before, here, before)
    if spec.how == "max":
        return F.greatest(here, before)
    if spec.how == "min":
        return F.least(here, before)
    return F.coalesce(here, before)
