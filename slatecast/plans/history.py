"""Slowly changing dimensions: attribute values with the dates they held."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.operators.asof import interval_join, validity
from slatecast.operators.ordered import Previous, Running, ordered_windows
from slatecast.session import store


def changing_dimension(rows: DataFrame, key: str, date: str, attributes: Sequence[str]) -> DataFrame:
    """(key, version, attributes, valid_from, valid_to): one row per unbroken run of equal attributes.

    A run begins where the attributes differ from the day before in the key's
    history (gaps between days don't end it) and lasts until the next one; the
    last has no end. Of several rows on a day the greatest attributes count.
    """
    attributes = list(attributes)
    value = F.struct(*attributes)
    daily = store(rows.filter(F.col(key).isNotNull() & F.col(date).isNotNull()).groupBy(key, F.col(date).alias("_day"))
                  .agg(F.max(value).alias("_value")), "daily-values")
    seen = store(ordered_windows(daily, [key], ["_day"], {"_before": Previous(F.col("_value"))}, index="_at"), "changes")
    starts = (F.col("_at") == 1) | ~F.col("_value").eqNullSafe(F.col("_before"))
    changes = store(seen.filter(starts).select(key, "_day", *[F.col(f"_value.{a}").alias(a) for a in attributes]), "versions")
    versions = validity(changes, "_day", attributes, [key])
    numbered = ordered_windows(store(versions, "validity"), [key], ["valid_from"], {"_n": Running("count")})
    return numbered.select(key, (F.col("_n") + 1).cast("int").alias("version"), *attributes, "valid_from", "valid_to")


def overlapping(dimension: DataFrame, key: str) -> DataFrame:
    """Versions that begin before the one before them has ended; empty when the dimension is sound."""
    ran = ordered_windows(store(dimension, "dimension"), [key], ["valid_from", "version"],
                          {"_end": Previous(F.col("valid_to")), "_start": Previous(F.col("valid_from"))})
    return ran.filter(F.col("_start").isNotNull() & (F.col("_end").isNull() | (F.col("valid_from") < F.col("_end"))))


def dim_venue(games: DataFrame) -> DataFrame:
    """Venues with their name and home team over time."""
    return changing_dimension(games, "venue_id", "official_date", ["venue_name", "home_team_id", "home_team_name"])


def with_venue(games: DataFrame, venues: DataFrame) -> DataFrame:
    """Games with the version of their venue that held on their date."""
    rows = games.select("game_pk", "venue_id", "official_date")
    return interval_join(rows, venues, "official_date", ["version", "venue_name", "home_team_name"], ["venue_id"], strict=False)
