import json
import os

from martlet.plans.pipeline import Landing
from martlet.sources import HLTB
from martlet.streaming import start_incremental


def _write(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def _row(title, hours):
    return {"record_type": "hl_tb_time", "game_name": title, "main_story": hours,
            "extraction_time": "2025-06-10T10:00:00", "source": "howlongtobeat",
            "endpoint": "hltb_search"}


def test_incremental_landing_exactly_once(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landed")
    os.makedirs(land)
    base, ckpt = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "ckpt")
    src = Landing("howlongtobeat", land, HLTB)
    _write(land, "a.json", [_row("Zelda", 50.0), _row("Zelda", 40.0), _row("Doom", 0.0)])
    start_incremental(spark, src, base, checkpoint=ckpt).awaitTermination()
    _write(land, "b.json", [_row("Halo", 12.0)])
    start_incremental(spark, src, base, checkpoint=ckpt).awaitTermination()
    start_incremental(spark, src, base, checkpoint=ckpt).awaitTermination()  # nothing new
    mart = spark.read.parquet(os.path.join(base, "core", "hltb_games"))
    assert sorted(r.game_name for r in mart.collect()) == ["Halo", "Zelda"]
    assert mart.select("dw_id_carga").distinct().count() == 2


def test_audit_append_idempotent_for_replays(spark, tmp_dir):
    from martlet.plans.pipeline import append_audit
    logs_dir = os.path.join(tmp_dir, "logs")
    row = {"run_id": "stream-x-0000000001", "step": "publish", "endpoint": "load/core_x",
           "source": "X", "records_count": 3}
    append_audit(spark, [row], logs_dir, idempotent=True)
    append_audit(spark, [dict(row, records_count=0)], logs_dir, idempotent=True)  # replay
    got = spark.read.parquet(logs_dir).collect()
    assert [(r.run_id, r.records_count) for r in got] == [("stream-x-0000000001", 3)]


def test_a_later_application_goes_on_from_the_checkpoint(spark, tmp_dir):
    """No checkpoint given: it lies in the base folder, where the next
    application, with a scratch folder of its own, finds it. Newer rows are kept."""
    land, base = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "wh")
    os.makedirs(land)
    src = Landing("howlongtobeat", land, HLTB)
    scratch = spark.sparkContext.getCheckpointDir()
    seen = []
    for name, hours in (("a.json", 50.0), ("b.json", 60.0)):
        spark.sparkContext.setCheckpointDir(os.path.join(tmp_dir, f"ckpt-{name}"))
        _write(land, name, [_row("Zelda", hours)])
        start_incremental(spark, src, base).awaitTermination()
        mart = spark.read.parquet(os.path.join(base, "core", "hltb_games"))
        seen.append(sorted(float(r.main_story) for r in mart.collect()))
    spark.sparkContext.setCheckpointDir(scratch)
    assert seen == [[50.0], [50.0, 60.0]]
    assert mart.select("dw_id_carga").distinct().count() == 2
    assert os.path.isdir(os.path.join(base, "_checkpoints", "howlongtobeat"))
    # another checkpoint is another stream: its batches aren't taken for stored ones
    start_incremental(spark, src, base, checkpoint=os.path.join(tmp_dir, "other")).awaitTermination()
    mart = spark.read.parquet(os.path.join(base, "core", "hltb_games"))
    assert mart.select("dw_id_carga").distinct().count() == 3
