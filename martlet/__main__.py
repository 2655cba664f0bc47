"""Command line: ``python -m martlet run|export ...``.

    python -m martlet run --base /warehouse --landing twitch=/landing/twitch \\
        [--durations /landing/hltb_catalogue.parquet --titles 100] [--run-id R] [--fail-fast]
    python -m martlet export --in /warehouse/core --out /exports twitch_games hltb_games
    python -m martlet sql --base /warehouse "SELECT * FROM get_load_summary('TWITCH')"

The session comes from spark-submit / the environment; nothing here sets a
master, so the same command runs locally and on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from martlet.session import get_spark
from martlet.sources.schemas import LANDING_SCHEMAS


def register_warehouse(spark, base: str) -> list[str]:
    """Temp views and SQL table functions over a warehouse written by
    ``run`` (``core/*`` mart tables and ``etl_logs``)."""
    import os

    from martlet.plans.pipeline import exists, read_mart
    from martlet.plans.views import register_mart_views, register_table_functions

    core = os.path.join(base, "core")
    games, streams = (read_mart(spark, os.path.join(core, t)) for t in ("twitch_games", "twitch_streams"))
    hltb_path = os.path.join(core, "hltb_games")
    hltb = read_mart(spark, hltb_path) if exists(spark, hltb_path) else None
    logs = spark.read.parquet(os.path.join(base, "etl_logs"))
    names = register_mart_views(spark, games, streams, hltb=hltb, logs=logs)
    register_table_functions(spark)
    return names


def main(argv: list[str] | None = None) -> int:
    from martlet.plans.pipeline import Landing, export_all, run_pipeline

    ap = argparse.ArgumentParser(prog="martlet")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="land, clean and publish landed sources")
    r.add_argument("--base", required=True)
    r.add_argument("--landing", action="append", required=True, metavar="NAME=PATH")
    r.add_argument("--run-id")
    r.add_argument("--multi-line", action="store_true")
    r.add_argument("--format", choices=("json", "parquet"), default="json",
                   help="format of the landed files")
    r.add_argument("--fail-fast", action="store_true")
    r.add_argument("--durations", metavar="PARQUET",
                   help="duration catalogue to look this run's game names up in")
    r.add_argument("--titles", type=int, help="look up only the first so many game names")
    r.add_argument("--max-distance", type=int, default=2, help="edits within which names match")
    r.add_argument("--quality", action="store_true",
                   help="add a quality-report audit row per published table")
    e = sub.add_parser("export", help="Parquet datasets to CSV folders")
    e.add_argument("--in", dest="in_dir", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--single-file", action="store_true")
    e.add_argument("names", nargs="+")
    q = sub.add_parser("sql", help="run SQL over the mart views and table functions")
    q.add_argument("--base", required=True)
    q.add_argument("--rows", type=int, default=50, help="rows to display")
    q.add_argument("--out", help="write the full result as Parquet here instead")
    q.add_argument("query")
    a = ap.parse_args(argv)

    spark = get_spark("martlet")
    try:
        if a.cmd == "run":
            landings = []
            for item in a.landing:
                name, _, path = item.partition("=")
                if name not in LANDING_SCHEMAS:
                    ap.error(f"unknown source {name!r}; known: {sorted(LANDING_SCHEMAS)}")
                landings.append(Landing(name, path, LANDING_SCHEMAS[name], a.multi_line,
                                        a.format))
            durations = spark.read.parquet(a.durations) if a.durations else None
            logs = run_pipeline(spark, landings, a.base, a.run_id, a.fail_fast,
                                durations=durations, n_titles=a.titles, quality=a.quality,
                                max_distance=a.max_distance)
            bad = logs.filter("status = 'ERROR'").count()
            return 1 if bad else 0
        if a.cmd == "sql":
            register_warehouse(spark, a.base)
            res = spark.sql(a.query)
            if a.out:
                res.write.mode("overwrite").parquet(a.out)
            else:
                res.show(a.rows, truncate=False)
            return 0
        export_all(spark, a.names, a.in_dir, a.out, a.single_file)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
