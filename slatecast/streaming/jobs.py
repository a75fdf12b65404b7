"""Structured Streaming jobs over landed files.

The checkpoint is the cursor: a restart reads only files that no committed
batch has seen. ``availableNow`` runs drain what has landed and stop, which is
the scheduled-job form; the same queries run continuously with another trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slatecast.operators.dedup import latest_wins
from slatecast.session import store


def landed_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000,
                  fmt: str = "parquet") -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .format(fmt).load(path))


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write what has landed as Parquet, exactly once per row, then stop."""
    query = (df.writeStream.outputMode(mode).format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def dedup_stream(rows: DataFrame, keys: Sequence[str], event_time: str | None = None,
                 lateness: str = "7 days") -> DataFrame:
    """First row per key. With an event time the state forgets keys older than
    the watermark, so it holds a window of keys instead of all of them."""
    if event_time is None:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))


def sliding_window(rows: DataFrame, date: str, days: int) -> DataFrame:
    """Accept rows up to ``days`` older than the newest date seen; ignore older ones.

    The watermark drops late rows in the stateful dedup that follows it.
    """
    stamp = F.col(date).cast("timestamp")
    return rows.withColumn("_event_time", stamp).withWatermark("_event_time", f"{days} days")


def late_tolerant(rows: DataFrame, keys: Sequence[str], date: str, days: int) -> DataFrame:
    kept = sliding_window(rows, date, days).dropDuplicates([*keys, "_event_time"])
    return kept.drop("_event_time")


class BucketedTable:
    """A keyed table laid out by a hash of its key, one folder per bucket.

    A batch rewrites only the buckets its keys fall into, by overwriting those
    partitions; their earlier files go with them. The merged rows are written
    aside first, so the overwrite never reads what it replaces, and merging a
    batch a second time changes nothing: a replayed batch is harmless. The
    number of buckets belongs to the table; at a given batch it bounds what is
    rewritten, and a bucket should fit a task.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str],
                 order: Sequence[Column], buckets: int = 64):
        self.spark, self.root, self.schema = spark, root, schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(self.BUCKET)

    def _stored(self) -> DataFrame:
        layout = T.StructType([*self.schema.fields, T.StructField(self.BUCKET, T.IntegerType())])
        try:
            return self.spark.read.schema(layout).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], layout)

    def current(self) -> DataFrame:
        return self._stored().select(*[F.col(f"`{c}`") for c in self.schema.names])

    def merge(self, batch: DataFrame) -> None:
        """Keep the latest row per key of the table and the batch."""
        fresh = store(batch.select("*", self._bucket()), "merge-batch")
        touched = [r[0] for r in fresh.select(self.BUCKET).distinct().collect()]     # at most ``buckets`` numbers
        if not touched:
            return
        known = self._stored().filter(F.col(self.BUCKET).isin(touched))
        merged = store(latest_wins(known.unionByName(fresh), self.keys, self.order), "merged-buckets")
        (merged.repartition(self.BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.BUCKET).parquet(self.root))


def latest_stream(rows: DataFrame, table: BucketedTable, checkpoint: str) -> StreamingQuery:
    """Keep the latest row per key: each batch is merged into the buckets it touches."""
    query = (rows.writeStream.foreachBatch(lambda batch, _: table.merge(batch))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def land_and_run(slices: Sequence[DataFrame], path: str, run: Callable[[], object]) -> None:
    """Scheduled runs: each slice lands as new files, then a run drains what has landed."""
    for rows in slices:
        rows.write.mode("append").parquet(path)
        run()


def grade_stream(outcomes: DataFrame, predictions: DataFrame, event_time: str | None = None) -> DataFrame:
    """Arriving outcomes joined to the logged predictions they grade.

    An outcome that lands again (overlapping reloads) grades once; with an
    event time the state forgets outcomes older than the watermark.
    """
    once = dedup_stream(outcomes, ["game_pk", "batter_id"], event_time)
    graded = once.select("game_pk", "batter_id", "has_hit", "hits", "pa")
    return graded.join(predictions, ["game_pk", "batter_id"])


def weekly_brier(graded: DataFrame, event_time: str, lateness: str = "7 days") -> DataFrame:
    """Brier score per closed week (from Monday) of arriving graded predictions: (week, n, brier).

    A prediction that lands again counts once. State holds the keys and the open
    weeks inside the watermark; a week comes out once, when no row of it can
    still be accepted, so a restart from the checkpoint neither repeats nor
    loses one.
    """
    once = dedup_stream(graded, ["game_pk", "batter_id"], event_time, lateness)
    # weeks counted from the epoch begin on Thursdays
    week = F.window(event_time, "7 days", "7 days", "4 days")
    error = F.col("p_hit") - F.col("has_hit")
    sums = once.groupBy(week.alias("_week")).agg(F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("brier"))
    return sums.select(F.col("_week.start").cast("date").alias("week"), "n", "brier")
