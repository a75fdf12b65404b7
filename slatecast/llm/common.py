"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slatecast.session import store

__all__ = ["hash60", "in_order", "join_hot", "positions", "quoted", "runs", "store", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column name as it is, also with dots in it."""
    return "`" + name.replace("`", "``") + "`"


def hash60(col: Column) -> Column:
    """The first 60 bits of MD5 as a long: the same in every engine and run."""
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("long")


def runs(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows with equal values in the first ``keys`` columns, of batches sorted by them.

    Only one group is held at a time, so groups must be of bounded size.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for part in parts:
        if not part.num_rows:
            continue
        columns = [part.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *change], [*change, part.num_rows]):
            now = tuple(c[a] for c in columns)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(part.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


#: A key may send so many rows to one task; beyond, at most HOT_KEYS keys are hot.
HOT_ROWS, HOT_KEYS = 2000, 10_000


def join_hot(rows: DataFrame, facts: DataFrame, keys: list[str], spread: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``facts``, one row per key with its number ``n`` of rows, where keys may be hot.

    A key with more than max(HOT_ROWS, all rows / HOT_KEYS) rows is dealt out by
    a hash of the columns ``spread``, its fact repeated for every part. There
    are fewer than HOT_KEYS such keys, whatever the size of the tables, so the
    list of them may be broadcast. ``facts`` should be a stored table.
    """
    total = facts.agg(F.sum("n")).first()[0] or 0
    parts = F.ceil(F.col("n") / F.lit(float(max(HOT_ROWS, total // HOT_KEYS)))).cast("int")
    sized = facts.withColumn("_parts", F.greatest(parts, F.lit(1)))
    hot = sized.filter("_parts > 1").select(*keys, "_parts")
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_part", F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(1)).cast("long")).cast("int")).drop("_parts")
    sized = sized.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return dealt.join(sized, [*keys, "_part"], how).drop("_part")


def in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` written in the order of ``keys`` (nulls first) with its place ``_at``.

    ``_at`` rises with the order; its high bits are the range partition. Rows
    with equal keys are told apart by a row number, so that any number of them
    may be dealt out over several partitions.
    """
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col("_row").asc()]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    return store(placed.withColumn("_at", F.monotonically_increasing_id()), name)


def positions(placed: DataFrame, group: list[str]) -> DataFrame:
    """Position (from 0) of every row of :func:`in_order` in its group, and the group's rows ``n``.

    ``group`` are the leading sort columns, without nulls. No group is brought
    together: partitions hold runs of it, whose lengths are added up.
    """
    part = F.shiftright("_at", 33)
    pieces = placed.groupBy(*group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = W.partitionBy(*group)
    pieces = pieces.select(
        *group, "_part", "_first", F.sum("_rows").over(whole).alias("n"),
        (F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")).alias("_before"))
    pieces = store(pieces, "pieces")
    placed = placed.withColumn("_part", part).join(pieces, [*group, "_part"])
    return placed.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_first", "_before")
