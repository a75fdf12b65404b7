"""Append-only tables: landed rows, heartbeats, predictions, run ledger."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.schemas import DATE_COLUMN, RAW
from slatecast.sources.readers import conform, table_or_empty


def append_raw(df: DataFrame, path: str, table: str) -> None:
    """Append landed rows; dated feeds are laid out by season for pruning."""
    column = DATE_COLUMN.get(table)
    typed = conform(df, RAW[table])
    if column is None or column in ("season", "year_id"):
        typed.write.mode("append").parquet(path)
        return
    season = F.substring(F.col(column), 1, 4).try_cast("int")
    typed.withColumn("load_season", season).write.mode("append").partitionBy("load_season").parquet(path)


def append_heartbeat(spark: SparkSession, path: str, run_at: str, runner: str, sha: str) -> None:
    row = spark.range(1).select(F.lit(run_at).cast("timestamp").alias("run_at"),
                                F.lit(runner).alias("runner"), F.lit(sha).alias("git_sha"))
    row.write.mode("append").parquet(path)


def append_predictions(scored: DataFrame, path: str) -> None:
    """Add a run to the log; the first run creates it. Earlier rows are never touched."""
    conform_strict(scored, "predictions").write.mode("append").parquet(path)


def conform_strict(df: DataFrame, table: str) -> DataFrame:
    """The table's columns and types, or an error when a column is absent."""
    missing = [c for c in RAW[table].names if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[table]])


def append_run(metrics: DataFrame, path: str, run_name: str, run_at: str, top5: float) -> int:
    """Record an evaluation in the ledger; returns how many there are now."""
    spark = metrics.sparkSession
    prior = table_or_empty(spark, path, "runs").filter(F.col("run_name").startswith("backtest")).count()
    row = metrics.select(F.lit(run_name).alias("run_name"), F.lit(run_at).cast("timestamp").alias("run_at"),
                         "log_loss", "brier", "auc", "n", F.lit(top5).alias("top5_hit_rate"),
                         F.lit(prior + 1).cast("long").alias("evaluations_to_date"))
    conform_strict(row, "runs").write.mode("append").parquet(path)
    return prior + 1


def cached_frame(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                 refresh: bool = False) -> DataFrame:
    """Frame written once and read back; ``refresh`` rebuilds it."""
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


LAYER_KIND = {"staging": "view", "intermediate": "view", "output": "view", "marts": "table", "ml": "table"}


def materialize(layer: str, name: str, df: DataFrame) -> DataFrame:
    """Views for the thin layers, catalog tables for marts and features."""
    if LAYER_KIND[layer] == "view":
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def incremental_slice(landed: DataFrame, target: DataFrame, date: str, today: str,
                      default_start: str = "2021-03-01", cap_days: int = 21) -> DataFrame:
    """Landed rows from the target's newest date (inclusive, so a part-loaded
    day completes) to yesterday, at most ``cap_days`` further on."""
    newest = target.agg(F.max(F.to_date(date))).first()[0]   # one value
    start = dt.date.fromisoformat(str(newest or default_start))
    end = min(dt.date.fromisoformat(str(today)) - dt.timedelta(1), start + dt.timedelta(cap_days))
    return between_days(landed, date, start, end)


def between_days(landed: DataFrame, date: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows from start to end; literal bounds reach the scan and prune season folders."""
    if isinstance(landed.schema[date].dataType, T.StringType):
        # ISO text (a time part after it or not) sorts as its date
        rows = landed.filter((F.col(date) >= str(start)) & (F.col(date) < str(end + dt.timedelta(1))))
    else:
        rows = landed.filter((F.to_date(date) >= F.lit(start)) & (F.to_date(date) <= F.lit(end)))
    if "load_season" in landed.columns:
        rows = rows.filter(F.col("load_season").between(start.year, end.year))
    return rows


def segments(start: dt.date, end: dt.date, days: int = 28) -> list[tuple[dt.date, dt.date]]:
    """Slices of a catch-up load, oldest first; each is loaded and committed by itself."""
    out = []
    while start <= end:
        last = min(end, start + dt.timedelta(days - 1))
        out.append((start, last))
        start = last + dt.timedelta(1)
    return out


def reload_window(landed: DataFrame, date: str, today: str, back: int, ahead: int) -> DataFrame:
    """Rows of a small window around today; appended again on every run and
    made harmless by latest-wins staging."""
    now = dt.date.fromisoformat(str(today))
    return between_days(landed, date, now - dt.timedelta(back), now + dt.timedelta(ahead))


def coverage(spark: SparkSession, tables: Mapping[str, DataFrame | None],
             dates: Mapping[str, str] = DATE_COLUMN) -> DataFrame:
    """Rows and date range per landed table; MISSING where there is none."""
    schema = "table string, state string, n long, first_date string, last_date string"
    absent = [(t, "MISSING", None, None, None) for t, df in tables.items() if df is None]
    out = spark.createDataFrame(absent, schema)
    for name, df in tables.items():
        if df is None:
            continue
        day = F.col(dates[name]).cast("string")
        out = out.unionByName(df.agg(
            F.lit(name).alias("table"), F.lit("ok").alias("state"), F.count(F.lit(1)).alias("n"),
            F.min(day).alias("first_date"), F.max(day).alias("last_date")))
    return out
