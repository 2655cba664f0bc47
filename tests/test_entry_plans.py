import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

from conftest import SF  # noqa: E402


def global_windows(plan: str) -> list[str]:
    """Window operators whose spec has no partition key: the first argument
    of windowspecdefinition is then a sort key or the frame itself."""
    out = []
    for ln in plan.splitlines():
        if "Window [" not in ln or "windowspecdefinition(" not in ln:
            continue
        first = ln.split("windowspecdefinition(", 1)[1].split(", ", 1)[0]
        if "ASC NULLS" in first or "DESC NULLS" in first or first.startswith("specifiedwindowframe"):
            out.append(ln)
    return out


def test_global_window_detector(spark):
    from pyspark.sql import Window, functions as F
    glob = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    part = spark.range(10).withColumn("r", F.row_number().over(
        Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert global_windows(glob._jdf.queryExecution().executedPlan().toString())
    assert not global_windows(part._jdf.queryExecution().executedPlan().toString())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["game_name", "active_streams", "avg_viewers", "total_viewers",
                          "max_viewers"]
    assert df.count() > 0


def test_every_query_has_sql_twin():
    assert set(entry.REGISTRY) == set(entry.ORACLE)
    assert set(entry.REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_query_runs_without_python_udfs(spark, name):
    df = entry.queries()[name](spark, SF)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # no window without a partition key: it would pull every row into one task
    assert not global_windows(plan)


def test_kind_filter_and_pruning_reach_scan(spark):
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF}/events.parquet")
    q = ev.filter(F.col("event_type") == "view").select("event_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_popular_entities_aggregates_before_join(spark):
    df = entry.queries()["popular_entities"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the child side is reduced per key (partial aggregate) before the join
    join_at = plan.index("Join LeftOuter")
    assert "Aggregate [game_id" in plan[join_at:]


def test_limits_only_where_they_are_the_feature(spark):
    # top-n reports and first-n listings; every other query returns whole results
    import re
    capped = {n for n, q in entry.ORACLE.items() if re.search(r"\bLIMIT\b", q)}
    assert capped == {"distinct_limit", "kpis", "longest_games", "paged_collection",
                      "sql_kpis", "top_entity_children"}
    capped -= {"sql_kpis"}  # its top game is a min_by, no limit in the plan
    for n in sorted(entry.REGISTRY):
        plan = entry.REGISTRY[n](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        has_limit = "GlobalLimit" in plan or "LocalLimit" in plan
        assert has_limit == (n in capped), n
