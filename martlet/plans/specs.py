"""Declarative per-source cleaning.

A :class:`SourceSpec` lists, per record kind, which rule applies to which
column. :func:`clean` turns it into one logical plan: kind filter (pushed to
the scan), required-field filter *before* dedup (T1), all value rules in a
single ``withColumns`` projection, deterministic keep-first dedup, union by
name, warehouse columns. Rules naming a column the input lacks are skipped
(P15), so one spec serves old and new landings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from martlet.functions import casts, nested, text
from martlet.functions.names import normalize_column_names
from martlet.operators.audit import with_audit_columns
from martlet.operators.dedup import keep_first
from martlet.operators.kinds import union_kinds
from martlet.sources.schemas import GAMES, HLTB as HLTB_RAW, STREAMS


@dataclass(frozen=True)
class KindRules:
    kind: str | None                       # record_type value; None = all rows
    key: tuple[str, ...] = ()              # dedup key (empty: no dedup)
    order: tuple = ()                      # keep-first order before tie-breaks
    require: tuple[str, ...] = ()          # P4: not null / not blank
    trim: tuple[str, ...] = ()             # P5
    blank_to_null: tuple[str, ...] = ()    # P6
    blank_to_null_trim: tuple[str, ...] = ()  # P7
    null_to_zero: tuple[str, ...] = ()     # P8
    default_unknown: tuple[str, ...] = ()  # P9
    positive_decimal: tuple[str, ...] = ()  # P10, decimal(6,2)
    any_of: tuple[str, ...] = ()           # P11: at least one present
    to_bool: tuple[str, ...] = ()          # P12
    timestamps: tuple[str, ...] = ()       # P13: ISO text
    utc_timestamps: tuple[str, ...] = ()   # P14: ...ssX pattern
    ints: tuple[str, ...] = ()             # P18
    doubles: tuple[str, ...] = ()          # P18
    as_string: tuple[str, ...] = ()
    map_fields: tuple[tuple[str, str, str, str], ...] = ()  # (out, map, key, type)
    array_items: tuple[tuple[str, str, int], ...] = ()      # (out, array, 1-based)
    json_cols: tuple[tuple[str, str], ...] = ()             # (out, source)
    drop: tuple[str, ...] = ()
    own: tuple[str, ...] = ()              # columns the kind fills (empty: all)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    dw_source: str
    endpoint: str
    kinds: tuple[KindRules, ...]
    drop: tuple[str, ...] = ("source", "endpoint")
    kind_col: str = "record_type"


def _rule_columns(df: DataFrame, r: KindRules) -> dict[str, Column]:
    have = set(df.columns)
    out: dict[str, Column] = {}

    def put(c: str, expr: Column) -> None:
        if c in have:
            out[c] = expr

    for c in r.trim:
        put(c, text.trimmed(c))
    for c in r.blank_to_null:
        put(c, text.blank_to_null(c))
    for c in r.blank_to_null_trim:
        put(c, text.blank_to_null(c, trim=True))
    for c in r.null_to_zero:
        put(c, casts.null_to_zero_int(c))
    for c in r.default_unknown:
        put(c, text.default_if_blank(c))
    for c in r.positive_decimal:
        put(c, casts.positive_decimal(c))
    for c in r.to_bool:
        put(c, casts.to_bool(c))
    for c in r.ints:
        put(c, casts.safe_cast(c, "int"))
    for c in r.doubles:
        put(c, casts.safe_cast(c, "double"))
    for c in r.as_string:
        put(c, F.col(c).cast("string"))
    for c in r.timestamps:
        if c in have and isinstance(df.schema[c].dataType, StringType):
            out[c] = casts.iso_to_timestamp(c)
    for c in r.utc_timestamps:
        if c in have and isinstance(df.schema[c].dataType, StringType):
            out[c] = casts.utc_to_timestamp(c)
    for o, m, k, t in r.map_fields:
        if m in have:
            out[o] = nested.map_value(m, k, t)
    for o, a, pos in r.array_items:
        if a in have:
            out[o] = nested.array_first(a) if pos == 1 else nested.array_nth(a, pos)
    for o, s in r.json_cols:
        if s in have:
            out[o] = nested.json_text(s)
    return out


def clean_kind(df: DataFrame, r: KindRules) -> DataFrame:
    """Apply one kind's rules (P3-P18) in plan order: required-field filter,
    value rules, at-least-one filter, keep-first dedup.

    Ties of the dedup order are broken by the columns the kind fills, maps by their
    entries in key order, so one row stays whatever the partitioning. Rows
    whose key columns are missing raise: they could not be told apart."""
    have = set(df.columns)
    req = [c for c in r.require if c in have]
    if req:
        df = df.filter(reduce(lambda a, b: a & b, [text.is_present(c) for c in req]))
    cols = _rule_columns(df, r)
    if cols:
        df = df.withColumns(cols)
    anys = [c for c in r.any_of if c in df.columns]
    if anys and len(anys) == len(r.any_of):
        df = df.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in anys]))
    if r.key:
        absent = [k for k in r.key if k not in df.columns]
        if absent:  # fine for a landing without rows of this kind
            return df.filter(F.raise_error(F.lit(
                f"rows of kind {r.kind!r} without their key columns {absent}")).cast("boolean"))
        order = [o for o in r.order if (o if isinstance(o, str) else o[0]) in df.columns]
        named = {o if isinstance(o, str) else o[0] for o in order}
        tie = [nested.canonical(F.col(c), df.schema[c].dataType) for c in df.columns
               if c not in r.key and c not in named and (not r.own or c in r.own)]
        df = keep_first(df, list(r.key), order + tie)
    drops = [c for c in r.drop if c in df.columns]
    return df.drop(*drops) if drops else df


def _align_types(raw: DataFrame, parts: list[DataFrame]) -> list[DataFrame]:
    """A rule that retypes a column for one kind (text -> timestamp) must
    not be undone by the union: the other kinds' copy of that column (NULL
    there) is cast to the converted type instead of widening to string."""
    raw_t = {f.name: f.dataType for f in raw.schema.fields}
    target = {}
    for p in parts:
        for f in p.schema.fields:
            if f.name in raw_t and f.dataType != raw_t[f.name]:
                target.setdefault(f.name, f.dataType)
    out = []
    for p in parts:
        fix = {c: F.col(c).try_cast(t) for c, t in target.items()
               if c in p.columns and p.schema[c].dataType != t}
        out.append(p.withColumns(fix) if fix else p)
    return out


def clean(df: DataFrame, spec: SourceSpec, run_id: str | None = None,
          strip_accents: bool = False) -> DataFrame:
    """Full cleaning plan for one source."""
    df = normalize_column_names(df, strip_accents)
    if ("extraction_time" in df.columns
            and isinstance(df.schema["extraction_time"].dataType, StringType)):
        df = df.withColumn("extraction_time", casts.iso_to_timestamp("extraction_time"))
    # constants stay out of the dedup sorts: landing labels go at the end anyway,
    # and the kind is put back as a literal
    df = df.drop(*[c for c in spec.drop if c in df.columns])
    parts = []
    for r in spec.kinds:
        if r.kind is None:
            parts.append(clean_kind(df, r))
            continue
        part = clean_kind(df.filter(F.col(spec.kind_col) == F.lit(r.kind)).drop(spec.kind_col), r)
        parts.append(part.select(F.lit(r.kind).alias(spec.kind_col), "*"))
    out = union_kinds(_align_types(df, parts))
    return with_audit_columns(out, spec.dw_source, spec.endpoint, run_id)


_NEWEST = (("extraction_time", "desc"),)

# Source labels, endpoints and per-kind rules of the four
# landed sources (names as the extractors emit them).
TWITCH = SourceSpec(
    name="twitch", dw_source="TWITCH", endpoint="twitch_api",
    kinds=(
        KindRules(kind="game", key=("game_id",), order=_NEWEST,
                  require=("game_name",), trim=("game_name",),
                  blank_to_null=("box_art_url", "igdb_id"),
                  own=tuple(GAMES.fieldNames()) + ("igdb_id",)),
        KindRules(kind="stream", key=("stream_id",), order=_NEWEST,
                  require=("user_name",), trim=("stream_title",),
                  null_to_zero=("viewer_count",), utc_timestamps=("started_at",),
                  default_unknown=("language",), to_bool=("is_mature",),
                  own=tuple(STREAMS.fieldNames()) + ("is_mature",)),
    ))

POKEDEX = SourceSpec(
    name="showdown_pokedex", dw_source="SHOWDOWN", endpoint="showdown_pokedex",
    kinds=(
        KindRules(kind=None, key=("pokemon_id",), order=_NEWEST,
                  trim=("name",), as_string=("pokemon_id",),
                  map_fields=tuple((s, "basestats", s, "int")
                                   for s in ("hp", "atk", "def", "spa", "spd", "spe")),
                  array_items=(("type1", "types", 1), ("type2", "types", 2)),
                  json_cols=(("abilities_json", "abilities"),),
                  drop=("basestats", "abilities")),
    ))

HLTB = SourceSpec(
    name="howlongtobeat", dw_source="HLTB", endpoint="howlongtobeat_api",
    kinds=(
        KindRules(kind=None, key=("game_name",), order=_NEWEST,
                  require=("game_name",), trim=("game_name",),
                  blank_to_null_trim=("game_alias",),
                  positive_decimal=("main_story", "main_extra", "completionist",
                                    "review_score"),
                  null_to_zero=("count_comp", "count_review"),
                  any_of=("main_story", "main_extra", "completionist"),
                  own=tuple(c for c in HLTB_RAW.fieldNames() if c != "record_type")
                  + ("game_alias", "count_comp", "count_review")),
    ))

PROFILES = SourceSpec(
    name="showdown", dw_source="SHOWDOWN", endpoint="showdown_api",
    kinds=(
        KindRules(kind="ladder", key=("username", "format"), order=_NEWEST,
                  doubles=("elo", "rating"), ints=("wins", "losses", "games")),
        KindRules(kind="profile", key=("username", "format"), order=_NEWEST,
                  doubles=("win_ratio", "gxe", "rating"),
                  ints=("games_played", "levels")),
    ))

SPECS = {
    "twitch_games": TWITCH, "twitch_streams": TWITCH, "twitch": TWITCH,
    "howlongtobeat": HLTB, "hltb": HLTB,
    "showdown_pokedex": POKEDEX,
    "showdown": PROFILES, "showdown_profiles": PROFILES,
}


def _typed_rules(df: DataFrame, r: KindRules) -> dict[str, Column]:
    """The rules of ``r`` that convert a value and can therefore reject one."""
    have = set(df.columns)
    conv: dict[str, Column] = {}
    for c in r.null_to_zero:
        conv[c] = casts.null_to_zero_int(c)
    for c in r.positive_decimal:
        # a positive value that does not fit decimal(6,2) is a reject; a
        # non-positive one is "no data", not a reject
        conv[c] = F.when(F.col(c).try_cast("double") <= 0, F.lit(0)).otherwise(
            casts.positive_decimal(c))
    for c in r.to_bool:
        conv[c] = casts.to_bool(c)
    for c in r.ints:
        conv[c] = casts.safe_cast(c, "int")
    for c in r.doubles:
        conv[c] = casts.safe_cast(c, "double")
    for c in r.timestamps:
        if c in have and isinstance(df.schema[c].dataType, StringType):
            conv[c] = casts.iso_to_timestamp(c)
    for c in r.utc_timestamps:
        if c in have and isinstance(df.schema[c].dataType, StringType):
            conv[c] = casts.utc_to_timestamp(c)
    return {c: e for c, e in conv.items() if c in have}


def reject_counts(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Values that were present but did not convert, per (kind, column), in
    one aggregate pass over the input (T6): long form (kind, column_name,
    rejected); only columns with at least one reject are returned."""
    df = normalize_column_names(df)
    aggs, labels = [F.count(F.lit(1)).alias("_rows")], []
    if ("extraction_time" in df.columns
            and isinstance(df.schema["extraction_time"].dataType, StringType)):
        aggs.append(F.count_if(casts.is_rejected(
            "extraction_time", casts.iso_to_timestamp("extraction_time"))).alias("r_et"))
        labels.append(("*", "extraction_time", "r_et"))
    for i, r in enumerate(spec.kinds):
        in_kind = F.lit(True) if r.kind is None else (F.col(spec.kind_col) == F.lit(r.kind))
        for j, (c, conv) in enumerate(_typed_rules(df, r).items()):
            a = f"r{i}_{j}"
            aggs.append(F.count_if(in_kind & casts.is_rejected(c, conv)).alias(a))
            labels.append((r.kind or "*", c, a))
    kinds = [r.kind for r in spec.kinds]
    if None not in kinds and spec.kind_col in df.columns:
        # rows of no listed kind are left out by the plan: count them here
        aggs.append(F.count_if(~F.coalesce(F.col(spec.kind_col).isin(kinds), F.lit(False))).alias("r_kind"))
        labels.append(("*", spec.kind_col, "r_kind"))
    if not labels:
        return df.sparkSession.createDataFrame([], "kind string, column_name string, "
                                                   "rejected bigint")
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"),
                     F.col(a).alias("rejected")) for k, c, a in labels]
    return one.select(F.inline(F.array(*rows))).filter(F.col("rejected") > 0)


def clean_source(df: DataFrame, source: str, run_id: str | None = None) -> DataFrame:
    """Dispatch by source name, case-insensitive; unknown names raise."""
    spec = SPECS.get(source.lower())
    if spec is None:
        raise ValueError(f"unsupported source: {source}")
    return clean(df, spec, run_id)
