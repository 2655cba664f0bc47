"""Explicit schemas for every raw and audit table (no inference, T24).

Built from type objects so that importing needs no running session; every
schema also exposes a DDL string through ``schema.simpleString()``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DataType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructField, StructType, TimestampType,
)

S, L, D, I, TS = StringType(), LongType(), DoubleType(), IntegerType(), TimestampType()


def schema_of(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


_LINEAGE = (("extraction_time", S), ("source", S), ("endpoint", S))

GAMES = schema_of(("record_type", S), ("game_id", S), ("game_name", S),
                ("box_art_url", S), *_LINEAGE)

STREAMS = schema_of(("record_type", S), ("stream_id", S), ("stream_title", S),
                  ("game_id", S), ("game_name", S), ("user_id", S),
                  ("user_name", S), ("viewer_count", L), ("started_at", S),
                  ("language", S), *_LINEAGE)

POKEDEX = schema_of(("record_type", S), ("pokemon_id", S), ("name", S),
                  ("types", ArrayType(S)), ("baseStats", MapType(S, I)),
                  ("abilities", MapType(S, S)), *_LINEAGE)

HLTB = schema_of(("record_type", S), ("game_name", S), ("game_image_url", S),
               ("review_score", D), ("main_story", D), ("main_extra", D),
               ("completionist", D), *_LINEAGE)

# ladder and profile records share one landing; numbers land as text
PROFILES = schema_of(("record_type", S), ("username", S), ("format", S),
                   ("elo", S), ("rating", S), ("wins", S), ("losses", S), ("games", S),
                   ("win_ratio", S), ("gxe", S), ("games_played", S), ("levels", S), *_LINEAGE)

# One row per pipeline step (K6/K7/K9). duration_seconds is derived.
# records_count: rows the step wrote; rejected_count: values or rows it set aside;
# step_id: the step's opening in the write-ahead record.
AUDIT = schema_of(("run_id", S), ("step", S), ("load_start_time", TS),
                ("load_end_time", TS), ("records_count", L), ("rejected_count", L), ("source", S),
                ("endpoint", S), ("output_file", S), ("status", S),
                ("error_message", S), ("created_at", TS), ("step_id", S))

# Landing name -> raw schema. The twitch landing mixes games
# and streams, so its schema is the stream schema plus the game-only column.
LANDING_SCHEMAS = {
    "twitch": schema_of(*[(f.name, f.dataType) for f in STREAMS.fields], ("box_art_url", S)),
    "twitch_games": GAMES,
    "twitch_streams": STREAMS,
    "showdown_pokedex": POKEDEX,
    "howlongtobeat": HLTB,
    "showdown": PROFILES,
    "showdown_profiles": PROFILES,
}
