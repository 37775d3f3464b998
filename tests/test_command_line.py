import json
import os

import pytest
from pyspark.sql import functions as F

from klaxon.__main__ import main, parser


def test_all_commands_one_after_the_other(spark, tmp_path, capsys):
    folder = {name: str(tmp_path / name) for name in ("in", "run", "progress", "metrics", "overview", "csv", "corpus", "out")}
    alerts = [
        {"incident_id": f"INC{i}", "system": "AB"[i % 2], "component": "c", "alert_type": "t", "severity": "HIGH",
         "message": "m", "timestamp": f"2026-01-02T10:{i // 10:02d}:{i % 10:02d}.5"}
        for i in range(50)
    ]
    spark.createDataFrame([(json.dumps(a),) for a in alerts], "value string").write.text(folder["in"])
    main(["stream", folder["run"], folder["progress"], "--source", "text", "--input", folder["in"], "--once"])
    main(["metrics", folder["run"], folder["metrics"], "--as-of", "2026-01-02", "--single-file"])
    main(["overview", f"{folder['metrics']}/enriched", folder["overview"], "--system", "A"])
    shown = capsys.readouterr().out
    assert "peak" in shown and "kpis" in shown
    metrics = spark.read.option("header", True).csv(f"{folder['metrics']}/enriched")
    assert spark.read.parquet(f"{folder['metrics']}/stats").count() == 2
    assert spark.read.parquet(f"{folder['overview']}/summary").count() == 2
    assert metrics.columns[-2:] == ["total_high_severity", "avg_per_window"]
    # Windows of the first three minutes are closed: two systems with five alerts each.
    assert metrics.agg(F.sum("high_severity_count")).first()[0] == 30
    history = spark.createDataFrame(
        [("INC1", "A", "c", "t", "m", "fixed", 5)],
        "incident_id string, system string, component string, alert_type string, description string,"
        " resolution string, mean_time_to_fix int",
    )
    history.write.option("header", True).csv(folder["csv"])
    main(["index", folder["csv"], folder["corpus"]])
    assert "1 incidents indexed" in capsys.readouterr().out
    main(["similar", folder["in"], folder["corpus"], folder["out"], "-k", "1"])
    assert spark.read.parquet(folder["out"]).filter("similar_id = 'INC1'").count() == 50
    (tmp_path / "none").mkdir()
    main(["overview", str(tmp_path / "none"), folder["overview"]])
    assert "no metrics" in capsys.readouterr().out


def test_all_systems_are_written_not_shown_only(spark, tmp_path):
    counts = spark.range(50).selectExpr(
        "concat('s', id) AS system", "id + 3 AS high_severity_count",
        "timestamp'2026-01-02 10:00:00' AS window_start", "timestamp'2026-01-02 10:00:10' AS window_end",
    )
    counts.write.parquet(str(tmp_path / "counts"))
    main(["metrics", str(tmp_path / "counts"), str(tmp_path / "metrics"), "--as-of", "2026-01-02"])
    main(["overview", str(tmp_path / "metrics/enriched"), str(tmp_path / "overview")])
    for folder in ("metrics/stats", "metrics/spikes", "overview/summary", "overview/systems", "overview/series"):
        assert spark.read.parquet(str(tmp_path / folder)).count() == 50


def test_jobs_leave_nothing_behind(spark, tmp_path):
    from klaxon.session import shared_folder

    alert = {"incident_id": "1", "system": "A", "component": "c", "alert_type": "t", "severity": "HIGH",
             "message": "m", "timestamp": "2026-01-02T10:00:00.5"}
    spark.createDataFrame([(json.dumps(alert),)], "value string").write.text(str(tmp_path / "in"))
    corpus = spark.sql("SELECT 'x' AS incident_id, array_repeat(0f, 256) AS embedding")
    corpus.write.parquet(str(tmp_path / "corpus"))
    before = set(os.listdir(shared_folder(spark)))
    main(["similar", str(tmp_path / "in"), str(tmp_path / "corpus"), str(tmp_path / "out"), "-k", "1"])
    assert set(os.listdir(shared_folder(spark))) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_a_command_is_needed():
    with pytest.raises(SystemExit):
        parser().parse_args([])
