"""Typed reads of landed files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from slatecast.schemas import RAW


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], RAW[name])


def table_or_empty(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The table at ``path``, or an empty one of the right type before its first load."""
    try:
        return spark.read.schema(RAW[name]).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, name)
        raise


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: absent ones NULL, unreadable values NULL, NaN NULL."""
    cols = []
    for field in schema:
        if field.name not in df.columns:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name)
        given = df.schema[field.name].dataType
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            if isinstance(given, T.IntegralType):
                value = value.try_cast(field.dataType)
            elif isinstance(given, T.FractionalType):
                value = F.when(~F.isnan(value.cast("double")), value).try_cast(field.dataType)
            else:
                # whole numbers may arrive as "5.0" text; plain ones stay exact
                text = value.cast("string")
                number = text.try_cast("double")
                value = F.coalesce(text.try_cast(field.dataType),
                                   F.when(~F.isnan(number), number).try_cast(field.dataType))
        elif isinstance(field.dataType, T.DoubleType):
            number = value.try_cast("double") if isinstance(given, T.NumericType) \
                else value.cast("string").try_cast("double")
            value = F.when(~F.isnan(number), number)
        elif isinstance(field.dataType, T.StringType):
            value = value.cast("string")
        else:
            value = value.try_cast(field.dataType)
        cols.append(value.alias(field.name))
    return df.select(*cols)


def load_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders at or below ``path`` that hold Parquet files (names only; no file is opened)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True) \
        .option("pathGlobFilter", "*.parquet").load(path)
    folders = files.select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).distinct().collect()
    return sorted(r["folder"] for r in folders) or [path]


def read_pitches(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pitch files with the kept columns and pinned types, whatever each file carries."""
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)   # all text, typed below
        typed = conform(raw, RAW["pitches"])
    else:
        # files of one load agree; loads may not, so each folder has its own types
        loads = [conform(spark.read.parquet(folder), RAW["pitches"]) for folder in load_folders(spark, path)]
        typed = reduce(DataFrame.unionByName, loads)
    return typed.withColumn("game_date", F.date_format(F.col("game_date").try_cast("timestamp"), "yyyy-MM-dd"))


def read_war(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """WAR text file: ``NULL`` marks a missing value; seasons first..last.

    Columns outside the schema become numbers when at least 99 % of their
    values parse: one aggregate over the file decides for all of them.
    """
    raw = spark.read.option("header", True).option("nullValue", "NULL").csv(path)
    # Names of the published file -> ours
    raw = raw.withColumnsRenamed({"mlb_ID": "mlb_id", "year_ID": "year_id", "stint_ID": "stint_id",
                                  "PA": "pa", "G": "g", "WAR": "war", "team_ID": "team_id", "lg_ID": "lg_id"})
    season = F.col("year_id").try_cast("double")
    rows = raw.filter(season.between(first, last))
    known = conform(rows, RAW["war_seasons"]).columns
    extra = [c for c in rows.columns if c not in known]
    numeric = numeric_columns(rows, extra)
    typed = {f.name: f.dataType for f in RAW["war_seasons"]}
    cols = [F.col(c).try_cast("double").try_cast(typed[c]).alias(c)
            if not isinstance(typed[c], T.StringType) else F.col(c) for c in known if c in rows.columns]
    cols += [F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in extra]
    return rows.select(*cols)


def numeric_columns(df: DataFrame, columns: Sequence[str], share: float = 0.99) -> set[str]:
    """Columns whose non-NULL values parse as numbers at least ``share`` of the time."""
    if not columns:
        return set()
    counts = [F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)]
    parsed = [F.count(F.col(c).try_cast("double")).alias(f"p_{i}") for i, c in enumerate(columns)]
    row = df.agg(*counts, *parsed).first()   # one row
    return {c for i, c in enumerate(columns) if row[f"p_{i}"] >= share * row[f"n_{i}"]}


def snapshot_war(war: DataFrame, season: int, date: str) -> DataFrame:
    """Season-to-date rows stamped with the day they were taken."""
    return war.filter(F.col("year_id") == season).withColumn("snapshot_date", F.lit(date))
