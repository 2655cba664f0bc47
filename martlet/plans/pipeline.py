"""Pipeline phases (G1-G4): land -> clean -> publish, one audit row per step.

Every phase reads what the previous one *wrote*, so lineage is cut at each
table and a lost executor only re-runs tasks of the current phase. Raw and
clean tables have one folder per run, which landing or cleaning the run again
replaces whole; publishing skips keys already stored for that run (C7), so
re-running a whole run changes nothing. Rows that break a mart constraint go to
a rejects table beside the mart, and every row left out is counted in the audit.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from martlet.operators.audit import audit_frame, observe_count
from martlet.operators.dedup import distinct_values
from martlet.operators.lookup import first_match_lookup, unmatched_titles
from martlet.operators.quality import quality_report
from martlet.operators.signatures import similar_titles
from martlet.plans.specs import SPECS, clean_source, reject_counts
from martlet.plans.steplog import StepLog
from martlet.sinks.writers import (
    append_new_rows, constraint_breaks, export_csv, restamp_lineage, select_target_columns,
)
from martlet.sinks.single_file import export_csv_file
from martlet.sources.readers import conform_to_schema, read_json
from martlet.sources.schemas import HLTB, LANDING_SCHEMAS

RUN_COL = "dw_id_carga"


@dataclass(frozen=True)
class Landing:
    """A landed source: JSON (or Parquet) files at ``path``, read with a
    fixed ``schema``."""
    name: str
    path: str
    schema: StructType
    multi_line: bool = False
    fmt: str = "json"


@dataclass(frozen=True)
class MartTable:
    """A publish target (K8): rows of ``kind`` (None = all) of a source, and the
    constraints that a row must meet to be stored (C1, C4)."""
    table: str
    keys: tuple[str, ...]
    kind: str | None = None
    columns: tuple[str, ...] | None = None
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)


# Source -> mart tables, with the mart's UNIQUE, NOT NULL and
# VARCHAR(n) rules. Twitch lands either mixed ("twitch") or as separate game
# and stream sets; ladder and profile records land together.
ROUTES: dict[str, tuple[MartTable, ...]] = {
    "twitch": (MartTable("twitch_games", ("game_id",), "game",
                         ("record_type", "game_id", "game_name", "box_art_url",
                          "extraction_time"),
                         ("game_id", "game_name"),
                         {"record_type": 20, "game_id": 50, "game_name": 500}),
               MartTable("twitch_streams", ("stream_id",), "stream",
                         ("record_type", "stream_id", "user_id", "user_name", "game_id",
                          "game_name", "stream_title", "viewer_count", "started_at",
                          "language", "extraction_time"),
                         ("stream_id", "user_id"),
                         {"record_type": 20, "stream_id": 50, "user_id": 50, "user_name": 100,
                          "game_id": 50, "game_name": 500, "language": 10})),
    "showdown_pokedex": (MartTable("showdown_pokedex", ("pokemon_id",),
                                   not_null=("record_type", "pokemon_id"),
                                   max_length={"record_type": 20, "pokemon_id": 100, "name": 100,
                                               "type1": 30, "type2": 30}),),
    "howlongtobeat": (MartTable("hltb_games", ("game_name",), not_null=("game_name",)),),
    "showdown": (MartTable("showdown_ladder", ("username", "format"), "ladder",
                           ("record_type", "username", "format", "elo", "rating", "wins", "losses",
                            "games", "extraction_time"), ("username",)),
                 MartTable("showdown_profiles", ("username", "format"), "profile",
                           ("record_type", "username", "format", "win_ratio", "gxe", "rating",
                            "games_played", "levels", "extraction_time"), ("username",))),
}
ROUTES["twitch_games"] = (ROUTES["twitch"][0],)
ROUTES["twitch_streams"] = (ROUTES["twitch"][1],)
ROUTES["showdown_profiles"] = ROUTES["showdown"]
#: bytes of the raw table that a cleaning task sorts: Parquet is some thirteen times as dense as the landing
CLEAN_SPLIT = 32 << 20
DW_COLS = ("dw_fecha_registro", "dw_id_carga", "dw_deleted", "dw_source", "dw_endpoint")


def _now():
    return _dt.datetime.now(_dt.timezone.utc)


def new_run_id() -> str:
    return _now().strftime("%Y%m%d%H%M%S") + "-" + uuid.uuid4().hex[:8]


def routes_of(name: str) -> tuple[MartTable, ...]:
    """Mart tables of a source, by name in any case; a source that the mart
    doesn't know raises instead of vanishing (K8)."""
    try:
        return ROUTES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown source: {name!r}; known: {sorted(ROUTES)}") from None


def _run_path(table: str, run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run id must be of letters, digits, '.', '_' and '-': {run_id!r}")
    return os.path.join(table, f"{RUN_COL}={run_id}")


@contextmanager
def _settings(spark: SparkSession, **conf):
    """Session settings (``a__b`` for ``spark.sql.a.b``) for the jobs of a block."""
    names = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _write_run(df: DataFrame, table: str, run_id: str,
               extra_partitions: tuple[str, ...] = ()) -> int:
    """Replace a run's folder of ``table`` by the rows of ``df``, none included."""
    obs_df, obs = observe_count(df, f"w{uuid.uuid4().hex[:6]}")
    w = obs_df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    # a task keeps a file open per kind, so its rows needn't be sorted by kind
    with _settings(df.sparkSession, maxConcurrentOutputFileWriters=8):
        (w.partitionBy(*extra_partitions) if extra_partitions else w).parquet(_run_path(table, run_id))
    return int(obs.get.get("rows", 0))


def _append(df: DataFrame, table: str, run_id: str) -> int:
    """Add rows of a run to ``table``. Without rows it still leaves a file with
    the columns, so that an empty table can be read."""
    obs_df, obs = observe_count(df.drop(RUN_COL), f"w{uuid.uuid4().hex[:6]}")
    obs_df.write.mode("append").parquet(_run_path(table, run_id))
    return int(obs.get.get("rows", 0))


def land(spark: SparkSession, src: Landing, raw_dir: str, run_id: str) -> dict:
    """Landed JSON -> raw Parquet folder of this run.

    A landing that mixes record kinds is also partitioned by kind, so the
    per-kind branches of the cleaning plan read only their own files
    (partition pruning instead of one full scan per kind)."""
    start = _now()
    if src.fmt == "json":
        df = read_json(spark, src.path, src.schema, src.multi_line)
    elif src.fmt == "parquet":
        df = spark.read.schema(src.schema).parquet(src.path)
    else:
        raise ValueError(f"unsupported landing format {src.fmt!r}")
    out = os.path.join(raw_dir, src.name.lower())
    spec = SPECS[src.name.lower()]
    by_kind = (spec.kind_col,) if (spec.kind_col in df.columns
                                   and any(k.kind for k in spec.kinds)) else ()
    n = _write_run(df, out, run_id, by_kind)
    return {"run_id": run_id, "step": "land", "source": src.name.upper(),
            "endpoint": f"parquet/{src.name.lower()}", "output_file": out,
            "records_count": n, "load_start_time": start, "load_end_time": _now()}


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table read with its known schema: a table that holds no
    rows yet (an empty landing writes no data files) reads as zero typed
    rows instead of failing schema inference (T24)."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _of_run(spark: SparkSession, table: str, schema: StructType, run_id: str) -> DataFrame:
    """One run's rows of a table, the run id as text whatever it looks like."""
    if RUN_COL not in schema.fieldNames():
        schema = StructType(schema.fields + [StructField(RUN_COL, StringType(), True)])
    return _read(spark, table, schema).filter(F.col(RUN_COL) == run_id)


def _raw(spark: SparkSession, name: str, raw_dir: str, run_id: str) -> DataFrame:
    return _of_run(spark, os.path.join(raw_dir, name.lower()), LANDING_SCHEMAS[name.lower()],
                   run_id).drop(RUN_COL)


def clean_phase(spark: SparkSession, name: str, raw_dir: str, clean_dir: str,
                run_id: str) -> tuple[DataFrame, dict]:
    """This run's raw rows, cleaned by the source's spec (P30) and written; the
    table read back, and the step's audit row (A6): rows after cleaning, rows
    before it, and per column the values that were there but did not convert
    (T6) or rows of no known kind."""
    start = _now()
    raw = _raw(spark, name, raw_dir, run_id)
    cleaned = clean_source(raw, name, run_id)
    out = os.path.join(clean_dir, name.lower())
    with _settings(spark, files__maxPartitionBytes=CLEAN_SPLIT):
        n = _write_run(cleaned.drop(RUN_COL), out, run_id)
    rejects = reject_counts(raw, SPECS[name.lower()]).collect()  # one row per kind and column
    note = {"rows_before": raw.count(), "rows_after": n}
    if rejects:
        note["rejected"] = {f"{r.kind}.{r.column_name}": r.rejected for r in rejects}
    audit = {"run_id": run_id, "step": "clean", "source": name.upper(),
             "endpoint": f"transform/{name.lower()}", "output_file": out, "records_count": n,
             "rejected_count": sum(r.rejected for r in rejects), "status": "SUCCESS",
             "error_message": json.dumps(note, sort_keys=True),
             "load_start_time": start, "load_end_time": _now()}
    return _of_run(spark, out, cleaned.schema, run_id).select(*cleaned.columns), audit


def _not_stored(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`append_new_rows`, but whole rows are only shuffled if a part of them is stored:
    of a run published for the first time none is, and of one published again, all."""
    if existing.isEmpty():
        return df
    if append_new_rows(df.select(*keys), existing, keys).isEmpty():
        return df.limit(0)
    return append_new_rows(df, existing, keys)


def publish_table(spark: SparkSession, df: DataFrame, name: str, t: MartTable, mart_dir: str,
                  run_id: str) -> dict:
    """Append a source's rows to one mart table, those whose (key, run) is new (K8,
    C2, C7); rows that break NOT NULL or a length go to ``_rejects/{table}`` with the
    names of the columns. Returns the counts for the step's audit row."""
    path = os.path.join(mart_dir, t.table)
    part = df if t.kind is None else df.filter(F.col("record_type") == t.kind)
    if t.columns:
        part = select_target_columns(part, list(t.columns) + list(DW_COLS))
    # lineage of the load, one rule for every source
    part = restamp_lineage(part, name, f"load/core_{name.lower()}", run_id)
    have = set(part.columns)
    checked = part.withColumn("violated", constraint_breaks(
        [c for c in t.not_null if c in have], {c: n for c, n in t.max_length.items() if c in have}))
    bad = checked.filter(F.size("violated") > 0)
    n_bad = _write_run(bad.drop(RUN_COL), os.path.join(mart_dir, "_rejects", t.table), run_id)
    good = checked.filter(F.size("violated") == 0).drop("violated")
    existing = _read(spark, path, part.schema).filter(F.col(RUN_COL) == run_id)
    n = _append(_not_stored(good, existing, list(t.keys) + [RUN_COL]), path, run_id)
    return {"records_count": n, "rejected_count": n_bad}


def publish(spark: SparkSession, df: DataFrame, name: str, mart_dir: str, run_id: str,
            log: StepLog | None = None) -> list[dict]:
    """Route to mart tables, each a step of its own (see :func:`publish_table`). A
    failing target yields an ERROR audit row and the others go on (T21); an unknown
    source raises. With a ``log`` the rows are written there as each step ends."""
    rows = []
    for t in routes_of(name):
        path, endpoint = os.path.join(mart_dir, t.table), f"load/core_{name.lower()}"
        row = (log.open("publish", name, endpoint, path) if log else
               {"run_id": run_id, "step": "publish", "source": name.upper(), "endpoint": endpoint,
                "output_file": path, "load_start_time": _now()})
        try:
            done = publish_table(spark, df, name, t, mart_dir, run_id) | {"status": "SUCCESS"}
        except Exception as e:  # noqa: BLE001 - recorded, caller decides
            done = {"records_count": 0, "status": "ERROR", "error_message": str(e)}
        done["load_end_time"] = _now()
        if log:
            log.close(row, [done])
        rows.append(row | done)
    return rows


def rejected_rows(spark: SparkSession, table: MartTable, schema: StructType, mart_dir: str) -> DataFrame:
    """Rows kept out of a mart table, with the columns that broke a constraint."""
    fields = [f for f in schema.fields if f.name != RUN_COL]
    full = StructType(fields + [StructField("violated", ArrayType(StringType()), True),
                                StructField(RUN_COL, StringType(), True)])
    return _read(spark, os.path.join(mart_dir, "_rejects", table.table), full)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on the file system that its scheme names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A mart table with its run ids as text: left to inference, the folder
    name of run ``0001`` would come back as the number 1."""
    fields = [f if f.name != RUN_COL else StructField(RUN_COL, StringType(), True)
              for f in spark.read.parquet(path).schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def quality_audit(spark: SparkSession, name: str, mart_dir: str, run_id: str) -> list[dict]:
    """Quality report (A10) of this run's rows in every table the source
    publishes to: one audit row each, the report as JSON in the message."""
    rows = []
    for t in routes_of(name):
        start = _now()
        path = os.path.join(mart_dir, t.table)
        if not exists(spark, path):
            continue
        df = read_mart(spark, path).filter(F.col(RUN_COL) == run_id)
        cols = [c for c in df.columns if c not in DW_COLS]
        r = quality_report(df, t.table, keys=list(t.keys), cols=cols).first()
        report = {"duplicate_count": r.duplicate_count,
                  "columns_with_empty": list(r.columns_with_empty),
                  "null_percentage": dict(r.null_percentage),
                  "total_records": r.total_records, "validation_passed": r.validation_passed}
        # the step writes no records, so it adds none to the load summary
        rows.append({"run_id": run_id, "step": "quality", "source": name.upper(),
                     "endpoint": f"quality/{t.table}", "output_file": path,
                     "records_count": 0, "status": "SUCCESS",
                     "error_message": json.dumps(report, sort_keys=True),
                     "load_start_time": start, "load_end_time": _now()})
    return rows


def lookup_durations(spark: SparkSession, catalogue: DataFrame, raw_dir: str,
                     mart_dir: str, run_id: str, n_titles: int | None = None,
                     max_distance: int = 2, similar: tuple[int, int] | None = None) -> dict:
    """Durations for this run's published game names (S8, S9, J3, J4):
    matched records become this run's raw duration folder; the audit row
    counts them and reports how many titles found no match, and how many an
    explicit ``n_titles`` left out."""
    start = _now()
    games = _of_run(spark, os.path.join(mart_dir, "twitch_games"),
                    StructType([StructField("game_name", StringType(), True)]), run_id)
    recs, _ = hours_for_titles(games, catalogue, start.strftime("%Y-%m-%dT%H:%M:%S"),
                               n_titles, max_distance, similar=similar)
    out = os.path.join(raw_dir, "howlongtobeat")
    n = _write_run(recs, out, run_id)
    total = games.select(F.count_distinct("game_name")).first()[0]
    asked = total if n_titles is None else min(total, n_titles)
    notes = [f"{asked - n} titles without match"] if asked > n else []
    notes += [f"{total - asked} titles beyond the limit of {n_titles}"] if total > asked else []
    return {"run_id": run_id, "step": "lookup", "source": "HOWLONGTOBEAT",
            "endpoint": "hltb_search", "output_file": out, "records_count": n,
            "status": "SUCCESS", "error_message": "; ".join(notes) or None,
            "load_start_time": start, "load_end_time": _now()}


def append_audit(spark: SparkSession, rows: list[dict], logs_dir: str,
                 idempotent: bool = False) -> DataFrame:
    """Append audit rows to the log table (G3). ``idempotent`` skips rows
    whose (run_id, step, endpoint) is already logged, for replays of the
    same run (streaming micro-batches); a batch re-run logs every attempt."""
    logs = audit_frame(spark, rows)
    if idempotent:
        existing = _read(spark, logs_dir, logs.schema)
        logs = append_new_rows(logs, existing, ["run_id", "step", "endpoint"])
    logs.write.mode("append").parquet(logs_dir)
    return logs


def run_pipeline(spark: SparkSession, landings: list[Landing], base_dir: str,
                 run_id: str | None = None, fail_fast: bool = False,
                 durations: DataFrame | None = None, n_titles: int | None = None,
                 quality: bool = False, max_distance: int = 2,
                 similar: tuple[int, int] | None = None) -> DataFrame:
    """Whole batch (G1, G2, G3): for every source land, clean, publish. A source
    without a route raises before anything is read.

    Every step's audit rows are appended to ``{base_dir}/etl_logs`` when the step
    ends; they are returned when the run does. A landing or cleaning that fails leaves
    its ERROR row and ends the run with its error. Steps that an earlier run began and
    never ended, as its driver was lost, are settled as ERROR rows first (see
    :class:`StepLog`).

    With a ``durations`` catalogue, the game names published by this run (the
    first ``n_titles`` if given) are looked up in it, names within
    ``max_distance`` edits match (else, with ``similar``, those with the most similar
    words, see :func:`hours_for_titles`), and the matches go through the same
    clean/publish path as a landed duration source. With ``quality`` every
    published table gets a quality-report audit row."""
    run_id = run_id or new_run_id()
    raw_dir, clean_dir, mart_dir = (os.path.join(base_dir, d) for d in ("raw", "clean", "core"))
    for src in landings:
        routes_of(src.name)
    log = StepLog(spark, os.path.join(base_dir, "etl_logs"), run_id, _read)
    log.settle()

    def finish(name: str) -> bool:
        cleaned: list[DataFrame] = []

        def work() -> list[dict]:
            df, row = clean_phase(spark, name, raw_dir, clean_dir, run_id)
            cleaned.append(df)
            return [row]

        low = name.lower()
        log.run("clean", name, f"transform/{low}", work, os.path.join(clean_dir, low))
        pub = publish(spark, cleaned[0], name, mart_dir, run_id, log)
        if quality:
            log.run("quality", name, f"quality/{low}", lambda: quality_audit(spark, name, mart_dir, run_id))
        return fail_fast and any(r.get("status") == "ERROR" for r in pub)

    stop = False
    for src in landings:
        low = src.name.lower()
        log.run("land", src.name, f"parquet/{low}", lambda: [land(spark, src, raw_dir, run_id)],
                os.path.join(raw_dir, low))
        if finish(src.name):
            stop = True
            break
    if durations is not None and not stop:
        log.run("lookup", "HOWLONGTOBEAT", "hltb_search", lambda: [lookup_durations(
            spark, durations, raw_dir, mart_dir, run_id, n_titles, max_distance, similar)],
            os.path.join(raw_dir, "howlongtobeat"))
        finish("howlongtobeat")
    return log.frame()


def hours_for_titles(games: DataFrame, catalogue: DataFrame, batch_time: str,
                     n_titles: int | None = None, max_distance: int = 2,
                     name_col: str = "name", id_col: str = "id",
                     similar: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Duration records for the distinct game names, or the first ``n_titles``
    of them (S8, S9, J3, J4), replacing one search request per title.

    ``catalogue`` is the landed duration source (unique ``id_col``, a name
    and the hour measures). Each title takes its best match within ``max_distance``
    edits or, with ``similar`` (a least similarity as a fraction), the one with the
    most similar words if there is none (:func:`similar_titles`); the record keeps
    the *title* as ``game_name``, the match's measures and one batch time
    (S13). Returns (records in the raw duration schema, unmatched titles).
    """
    titles = distinct_values(games.select(F.col("game_name").alias("title")), "title",
                             limit=n_titles)
    matches = first_match_lookup(titles, catalogue, "title", name_col, id_col, max_distance)
    if similar:
        matches = matches.drop("distance").checkpoint(eager=True)
        matches = matches.unionByName(similar_titles(
            unmatched_titles(titles, matches), catalogue, "title", name_col, id_col, similar).drop("similarity"))
    attrs = catalogue.drop(name_col).withColumnRenamed(id_col, "match_id")
    records = matches.join(attrs, "match_id").select(
        F.lit("hl_tb_time").alias("record_type"), F.col("title").alias("game_name"),
        *[c for c in attrs.columns if c != "match_id"],
        F.lit(batch_time).alias("extraction_time"),
        F.lit("howlongtobeat").alias("source"), F.lit("hltb_search").alias("endpoint"))
    return conform_to_schema(records, HLTB), unmatched_titles(titles, matches)


def export_all(spark: SparkSession, names: list[str], in_dir: str, out_dir: str,
               single_file: bool = False) -> None:
    """Every named Parquet dataset to a CSV folder of the same name (G4, K2), or with
    ``single_file`` to one file ``{name}.csv``, which many tasks write."""
    for n in names:
        df = spark.read.parquet(os.path.join(in_dir, n))
        if single_file:
            export_csv_file(df, os.path.join(out_dir, f"{n}.csv"),
                            work=os.path.join(out_dir, "_parts", f"{n}-{uuid.uuid4().hex}"))
        else:
            export_csv(df, os.path.join(out_dir, n))
