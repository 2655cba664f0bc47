"""KPI operators of the analytics mart.

Aggregates are pushed below joins by hand where Catalyst cannot: the child
table (the big one) is reduced to one row per join key with a partial
(map-side) aggregate before it meets the parent, so neither a hot key nor a
high fan-out ever reaches the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlet.functions.bands import band, DURATION_BANDS, DURATION_ELSE
from martlet.functions.casts import iso_to_timestamp
from martlet.operators.dedup import keep_first
from martlet.operators.quantiles import exact_quantiles, with_exact_quantiles


def live_rows(flag: str = "dw_deleted", missing_is_live: bool = False) -> Column:
    """Soft-delete predicate. ``flag = FALSE`` drops NULL flags (P19);
    ``missing_is_live`` also keeps them, as after a LEFT JOIN (P20)."""
    c = F.col(flag)
    return (~c) | c.isNull() if missing_is_live else F.coalesce(~c, F.lit(False))


def exact_avg(c) -> Column:
    """sum/count in double. For decimals the sum is exact, so the mean does
    not depend on how rows were split across tasks."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def _latest_run(of: DataFrame, run_col: str, time_col: str) -> Column:
    """The run loaded last into ``of``: by load time where the table has it
    (run ids need not sort by time), else by id."""
    last = F.max_by(run_col, F.struct(time_col, run_col)) if time_col in of.columns else F.max(run_col)
    return of.agg(last).scalar()


def _stream_stats(streams: DataFrame, key: str, stream_id: str, value: str,
                  deleted: str) -> DataFrame:
    """Per-key partials of the stream table in one partial (map-side)
    aggregate; rows count as live as after a LEFT JOIN (P20)."""
    live = live_rows(deleted, missing_is_live=True)
    v = F.when(live, F.col(value))
    return streams.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(live).alias("_live"),
        F.count(F.when(live, F.col(stream_id))).alias("_cnt"),
        F.sum(v).alias("_sum"), F.avg(v).alias("_avg"), F.max(v).alias("_max"))


def _popular(games: DataFrame, s: DataFrame, key: str, name: str, deleted: str,
             keep_key: bool, nulls: str) -> DataFrame:
    g = (games.filter(live_rows(deleted)).groupBy(key, name)
         .agg(F.count(F.lit(1)).alias("_m")))
    j = (g.join(s, key, "left")
         .filter(F.col("_rows").isNull() | (F.col("_live") > 0)))
    out = j.select(
        *([key] if keep_key else []), name,
        (F.coalesce(F.col("_cnt"), F.lit(0)) * F.col("_m")).alias("active_streams"),
        F.col("_avg").alias("avg_viewers"),
        (F.col("_sum") * F.col("_m")).alias("total_viewers"),
        F.col("_max").alias("max_viewers"),
        *([] if keep_key else [F.col(key).alias("_key")]))
    tv = F.col("total_viewers")
    o = tv.desc_nulls_first() if nulls == "first" else tv.desc_nulls_last()
    out = out.orderBy(o, F.col(key if keep_key else "_key"))
    return out if keep_key else out.drop("_key")


def popular_entities(games: DataFrame, streams: DataFrame, key: str = "game_id",
                     name: str = "game_name", stream_id: str = "stream_id",
                     value: str = "viewer_count", deleted: str = "dw_deleted",
                     run_col: str | None = None, keep_key: bool = False,
                     nulls: str = "last") -> DataFrame:
    """Popular-games view.

    Same result as ``games LEFT JOIN streams ON key WHERE g.deleted = FALSE
    AND (s.deleted = FALSE OR s.deleted IS NULL) GROUP BY key, name``:
    a game with no streams stays (count 0, sums NULL), a game whose streams
    are all deleted disappears, and duplicated (key, name) game rows multiply
    counts and sums as the plain join does. ``run_col`` restricts both sides
    to one run first, the one loaded last into ``games``. Ordered by
    total_viewers DESC NULLS LAST (or FIRST, the PostgreSQL default), then key.
    """
    if run_col:
        last = _latest_run(games, run_col, "dw_fecha_registro")
        games, streams = games.filter(F.col(run_col) == last), streams.filter(F.col(run_col) == last)
    s = _stream_stats(streams, key, stream_id, value, deleted)
    return _popular(games, s, key, name, deleted, keep_key, nulls)


def entity_kpis(games: DataFrame, streams: DataFrame, key: str = "game_id",
                name: str = "game_name", stream_id: str = "stream_id",
                value: str = "viewer_count", deleted: str = "dw_deleted",
                nulls: str = "last", approx_distinct: bool = False) -> DataFrame:
    """One-row KPI record (A4, A5, O4): distinct live games, live streams,
    mean viewers per live stream, and the top game with its viewers.

    Each figure is a scalar subquery (no join of one-row frames); name and
    viewers of the top game come from the same single top-1 row. Stream
    count and mean are one global aggregate (map-side partials, no keyed
    shuffle); the ranking pre-aggregates streams per game before its join.
    ``approx_distinct`` counts games with HyperLogLog++ (no shuffle by key,
    about 1% error) instead of the exact distinct count.
    """
    spark = games.sparkSession
    s = _stream_stats(streams, key, stream_id, value, deleted)
    pop = _popular(games, s, key, name, deleted, keep_key=True, nulls=nulls)
    top = pop.limit(1).select(F.struct(F.col(name).alias("n"),
                                       F.col("total_viewers").alias("v")))
    st = streams.filter(live_rows(deleted)).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.avg(value).alias("a")))
    return spark.range(1, numPartitions=1).select(
        games.filter(live_rows(deleted)).agg(
            F.approx_count_distinct(key) if approx_distinct else F.count_distinct(key)
        ).scalar().cast("int").alias("total_games"),
        st.scalar().alias("_st"),
        top.scalar().alias("_top"),
    ).select("total_games", F.col("_st.n").cast("int").alias("total_active_streams"),
             F.col("_st.a").alias("avg_viewers_per_stream"),
             F.col("_top.n").alias("top_game"),
             F.col("_top.v").cast("bigint").alias("top_game_viewers"))


def load_summary(logs: DataFrame, source: str | None = None) -> DataFrame:
    """Per-source load summary (A2, A3, P22, F2): loads, records, mean
    duration, last load, success share in percent (2 decimals)."""
    if source is not None:
        logs = logs.filter(F.col("source") == F.lit(source))
    return (logs.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_loads"),
        F.sum("records_count").cast("bigint").alias("total_records"),
        exact_avg("duration_seconds").alias("avg_duration_seconds"),
        F.max("load_end_time").alias("last_load_time"),
        F.round(F.count_if(F.col("status") == "SUCCESS") / F.count(F.lit(1))
                * F.lit(100.0), 2).alias("success_rate"))
        .orderBy(F.desc_nulls_last("total_records"), "source"))


def log_kpis(logs: DataFrame) -> DataFrame:
    """Loads per source, last load, errors."""
    return logs.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_loads"),
        F.max("load_end_time").alias("last_load_time"),
        F.count_if(F.col("status") == "ERROR").alias("error_loads"),
        F.sum("records_count").cast("bigint").alias("total_records"))


def duration_view(df: DataFrame, measure: str = "main_story",
                  keep: list[str] | None = None, deleted: str | None = "dw_deleted",
                  bands=DURATION_BANDS, otherwise: str = DURATION_ELSE) -> DataFrame:
    """Rows with a measure, banded first-match, longest first.
    Rows with equal measures follow the other columns' order: the result is
    deterministic, and the sort can split a common value among tasks."""
    if deleted:
        df = df.filter(live_rows(deleted))
    keep = keep if keep is not None else [c for c in df.columns if c != deleted]
    return (df.filter(F.col(measure).isNotNull())
            .select(*keep, band(measure, bands, otherwise).alias("duration_category"))
            .orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_first(c) for c in keep if c != measure]))


def longest(df: DataFrame, measure: str = "main_story", n: int = 10,
            tie: list[str] | None = None, deleted: str | None = "dw_deleted") -> DataFrame:
    """The n rows with the largest measure, ties by the ``tie`` columns
    ascending, NULLs first (A13, "longest games"). Planned as
    TakeOrderedAndProject: every task keeps n rows."""
    if deleted:
        df = df.filter(live_rows(deleted))
    order = [F.desc_nulls_last(measure)] + [F.col(c).asc_nulls_first() for c in tie or []]
    return df.filter(F.col(measure).isNotNull()).orderBy(*order).limit(n)


def casted_view(df: DataFrame, text_col: str, out_col: str | None = None) -> DataFrame:
    """All columns plus the ISO text parsed to a timestamp; rows without the
    text dropped (P24)."""
    return (df.filter(F.col(text_col).isNotNull())
            .select("*", iso_to_timestamp(text_col).alias(out_col or f"{text_col}_casted")))


def count_per_category(children: DataFrame, parents: DataFrame | None = None,
                       key: str | None = None, category: str = "category",
                       out: str = "n_rows") -> DataFrame:
    """Rows per category (A12). When the category lives on the parent, the
    child side is first reduced to counts per key, then joined."""
    if parents is None:
        return children.groupBy(category).agg(F.count(F.lit(1)).alias(out))
    per_key = children.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.join(parents.select(key, category), key, "inner")
            .groupBy(category).agg(F.sum("_n").cast("bigint").alias(out)))


def mode_comparison(df: DataFrame, modes: list[str], ids: list[str] | None = None,
                    mode_col: str = "mode", value_col: str = "hours") -> DataFrame:
    """Compare measures side by side (A13): unpivot, then per mode count,
    exact mean, median (``percentile_disc(0.5)``: a value of the data), min, max. The
    median comes from refined histograms (:func:`exact_quantiles`), so no task holds a
    mode's distinct values."""
    long = df.unpivot(ids or [], modes, mode_col, value_col)
    medians = exact_quantiles(long.select(mode_col, value_col), mode_col, value_col)
    known = long.groupBy(mode_col).agg(
        F.count(value_col).alias("n_values"), exact_avg(value_col).alias("avg_value"),
        F.min(value_col).alias("min_value"), F.max(value_col).alias("max_value"))
    return with_exact_quantiles(known, mode_col, medians, "median_value", long.schema[value_col].dataType).select(
        mode_col, "n_values", "avg_value", "median_value", "min_value", "max_value")


def stat_leaders(df: DataFrame, id_col: str, stats: list[str] | None = None,
                 array_col: str | None = None) -> DataFrame:
    """Top entity of every stat (A14): unpivot named stat columns, or the
    positions of an array column, then keep the highest value per stat
    (ties: smallest id)."""
    if array_col:
        long = df.select(id_col, F.posexplode(array_col).alias("_pos", "value")) \
                 .select(id_col, F.col("_pos").cast("string").alias("stat"), "value")
    else:
        long = df.unpivot([id_col], stats, "stat", "value")
    return keep_first(long.filter(F.col("value").isNotNull()), ["stat"],
                      [("value", "desc"), id_col]).select("stat", id_col, "value")


def value_distribution(df: DataFrame, array_col: str, out: str = "value",
                       count_col: str = "n_rows") -> DataFrame:
    """Distribution of array elements, e.g. entities per type."""
    return (df.select(F.explode(array_col).alias(out))
            .groupBy(out).agg(F.count(F.lit(1)).alias(count_col)))


def usage_ranking(df: DataFrame, name: str, fmt: str, usage: str, period: str,
                  deleted: str | None = "dw_deleted") -> DataFrame:
    """Mean usage per (name, format) with months tracked and latest month,
    highest first (A11, O6)."""
    if deleted:
        df = df.filter(live_rows(deleted))
    return (df.groupBy(name, fmt).agg(
        exact_avg(usage).alias("avg_usage_percentage"),
        F.count(F.lit(1)).alias("months_tracked"),
        F.max(period).alias("latest_month"))
        .orderBy(F.desc_nulls_last("avg_usage_percentage"), name, fmt))
