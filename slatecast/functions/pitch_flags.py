"""Pitch classification: sixteen boolean flags, NULL in gives NULL out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The outcome vocabularies of the pitch feed.
WHIFFS = ["swinging_strike", "swinging_strike_blocked"]
CONTACTS = ["foul", "foul_tip", "foul_bunt",
            "hit_into_play", "hit_into_play_no_out", "hit_into_play_score"]
SWINGS = WHIFFS + CONTACTS
HITS = ["single", "double", "triple", "home_run"]
NOT_AT_BATS = ["walk", "hit_by_pitch", "sac_fly", "sac_bunt",
               "sac_fly_double_play", "catcher_interf"]
PITCH_TYPES = ["FF", "SI", "FC", "SL", "ST", "CU", "KC", "CH", "FS"]


def barrel_window(speed: Column) -> tuple[Column, Column]:
    """Launch angles that count as a barrel at this exit speed."""
    widen = (speed - 98) * F.lit(1.5)
    return F.greatest(26 - widen, F.lit(8.0)), F.least(30 + widen, F.lit(50.0))


#: Columns that a flag is read from, if not the event.
_READS = {**dict.fromkeys(["is_swing", "is_contact", "is_whiff"], {"description"}),
          **dict.fromkeys(["is_in_zone", "is_out_zone"], {"zone"}), "is_chase": {"zone", "description"},
          "is_bip": {"pitch_result_type"}, "is_hard_hit": {"pitch_result_type", "launch_speed"},
          "is_sweet_spot": {"pitch_result_type", "launch_angle"}, "is_line_drive": {"pitch_result_type", "bb_type"},
          "is_barrel": {"pitch_result_type", "launch_speed", "launch_angle"}}


def pitch_flags(pitches: DataFrame) -> DataFrame:
    """All flags whose columns the table holds."""
    desc, event, zone = F.col("description"), F.col("events"), F.col("zone")
    speed, angle = F.col("launch_speed"), F.col("launch_angle")
    in_play = F.col("pitch_result_type") == "X"
    out_zone = zone.between(11, 14)
    swing = desc.isin(SWINGS)
    flags = {
        "is_swing": swing,
        "is_contact": desc.isin(CONTACTS),
        "is_whiff": desc.isin(WHIFFS),
        "is_in_zone": zone.between(1, 9),
        "is_out_zone": out_zone,
        "is_chase": out_zone & swing,
        "is_pa_end": event.isNotNull(),
        "is_hit": event.isin(HITS),
        "is_k": event == "strikeout",
        "is_bb": event == "walk",
        "is_ab": event.isNotNull() & ~event.isin(NOT_AT_BATS),
        "is_bip": in_play,
        "is_hard_hit": in_play & (speed >= 95),
        "is_sweet_spot": in_play & angle.between(8, 32),
        "is_line_drive": in_play & (F.col("bb_type") == "line_drive"),
        "is_barrel": in_play & (speed >= 98) & angle.between(*barrel_window(speed)),
    }
    return pitches.withColumns({n: c for n, c in flags.items() if _READS.get(n, {"events"}) <= set(pitches.columns)})


FLAGS = ["is_swing", "is_contact", "is_whiff", "is_in_zone", "is_out_zone", "is_chase",
         "is_pa_end", "is_hit", "is_k", "is_bb", "is_ab", "is_bip", "is_hard_hit",
         "is_sweet_spot", "is_line_drive", "is_barrel"]
