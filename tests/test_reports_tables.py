from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from authlane import schema
from authlane.operators import alerting as A
from authlane.operators import presentation as C
from authlane.operators import reports as R
from authlane.operators import tables as T
from authlane.schema import ALERTS, EVENTS
from authlane.session import checkpoint_root, stream_checkpoint
from authlane.sources import readers as SR

NOW = datetime(2026, 4, 9, 8, 0)


@pytest.mark.parametrize(
    "value, limit",
    [(None, 50), ("", 50), ("x", 50), (0, 50), (-3, 50), ("0.5", 50), ("7.9", 7), (1000, 200), ("inf", 50)],
)
def test_clamp_limit(value, limit):
    assert R.clamp_limit(value) == limit


def alerts_at(spark, *minutes, rule="windows_failed_logon_burst"):
    rows = [(NOW + timedelta(minutes=m), rule) for m in minutes]
    return spark.createDataFrame(rows, "ts timestamp, rule_id string")


def test_conditions(spark):
    got = {r.rule_id: (r.value, r.firing) for r in A.alert_conditions(alerts_at(spark, 0, 1), NOW + timedelta(minutes=5)).collect()}
    assert got["windows_failed_logon_burst"] == (1.0, True)
    assert got["security_failed_login_burst"] == (0.0, False) and len(got) == 5


def test_transitions(spark):
    # Look-back of five marks: 0 and 5 join, 10.5 reaches mark 11 after a one-mark gap.
    rows = A.alert_transitions(alerts_at(spark, 0, 0, 5, 10.5, 30)).orderBy("tick").collect()
    assert [((r.tick - NOW).seconds // 60, r.state) for r in rows] == [
        (0, "firing"), (10, "resolved"), (11, "firing"), (16, "resolved"), (30, "firing"), (35, "resolved"),
    ]


@pytest.mark.parametrize(
    "seconds, words",
    [(0.2, "1 seconds"), (90, "90 seconds"), (91, "2 minutes"), (3540, "59 minutes"), (3599, "1 hour"), (9000, "3 hours")],
)
def test_window_text(spark, seconds, words):
    df = spark.createDataFrame([(NOW, NOW + timedelta(seconds=seconds))], "a timestamp, b timestamp")
    assert df.select(C.window_text(F.col("a"), F.col("b"))).first()[0] == words


@pytest.mark.parametrize(
    "seconds, words",
    [(-9, "just now"), (4, "just now"), (5, "5 seconds ago"), (60, "1 minute ago"), (3540, "59 minutes ago"),
     (3600, "1 hour ago"), (86399, "2026-04-09 08:00:00")],
)
def test_relative_age(spark, seconds, words):
    df = spark.createDataFrame([(NOW,)], "t timestamp")
    assert df.select(C.relative_age(F.col("t"), NOW + timedelta(seconds=seconds))).first()[0] == words


@pytest.mark.parametrize(
    "name, title",
    [("Failed Then Success", "Failed Login Burst Detected"), ("Password Spray", "Password Spray Detected"),
     ("Distributed Attack", "Distributed Login Attack Detected"), ("Other", "Suspicious Login Activity Detected")],
)
def test_title(spark, name, title):
    assert spark.range(1).select(C.title(F.lit(name))).first()[0] == title


def event_rows(spark, *days):
    rows = [(NOW + timedelta(days=d), f"e{d}", "p", "authlane.event.v1", "lane", "m", {"k": "v"}) for d in days]
    return spark.createDataFrame(rows, EVENTS)


def test_write_scan_and_retention(spark, tmp_path):
    path = str(tmp_path / "events")
    T.write_table(event_rows(spark, 0, 1, 2, 2.2, 3), path, T.EVENT_SORT)
    assert SR.scan_events(spark, path).count() == 5
    since = NOW + timedelta(days=2, hours=1)
    pruned = SR.scan_events(spark, path, since)
    assert pruned.count() == 2
    assert "day" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
    # Seven days later at the middle of day 2: days 0 and 1 go, day 2 is cut.
    dropped = T.apply_retention(spark, path, since + timedelta(days=7), 7)
    assert dropped == ["2026-04-09", "2026-04-10"]
    left = SR.scan_events(spark, path)
    assert sorted(r.event_id for r in left.collect()) == ["e2.2", "e3"]
    assert T.apply_retention(spark, path, since + timedelta(days=7), 7) == []


def test_month_layout(spark, tmp_path):
    path = str(tmp_path / "alerts")
    T.write_table(event_rows(spark, 0, 40), path, T.EVENT_SORT, by="month")
    assert sorted(str(r.month) for r in spark.read.parquet(path).select("month").distinct().collect()) == ["202604", "202605"]


def test_contract(spark):
    good = event_rows(spark, 0)
    assert T.contract_violations(good).count() == 0
    bad = good.drop("platform").withColumn("event_id", F.lit(1)).withColumn("message", F.lit(None).cast("string"))
    got = sorted((r.column, r.violation, r.rows) for r in T.contract_violations(bad).collect())
    assert got == [("event_id", "wrong type", 0), ("message", "null anchor", 1), ("platform", "missing", 0)]


def test_defaults_and_evolution(spark):
    partial = spark.createDataFrame(
        [("r", "R", "low", 3, "gte", 1, "q", None)],
        "rule_id string, rule_name string, severity string, hits bigint, threshold_op string, "
        "threshold_value bigint, query string, reason string",
    )
    full = T.with_defaults(partial, ALERTS, as_of=NOW)
    row = full.first()
    assert full.columns == ALERTS.names and (row.ts, row.reason, row.workflow_state) == (NOW, "", "new")
    with pytest.raises(ValueError):
        T.with_defaults(partial.drop("query"), ALERTS, as_of=NOW)
    old = event_rows(spark, 0).drop("schema_version").withColumn("extra", F.lit(1))
    new = T.evolve(old, EVENTS, T.event_defaults(), NOW)
    assert new.columns == [*EVENTS.names, "extra"] and new.first().schema_version == "authlane.event.v1"
    assert T.evolve(new, EVENTS, T.event_defaults(), NOW).columns == new.columns


def test_migration_and_rule_checks(spark):
    checks = T.migration_checks(
        spark, {"events": event_rows(spark, 0), "alerts": None},
        {"events": ["schema_version", "nope"], "alerts": ["window_bucket"]},
    ).collect()
    assert [(r.relation, r.column, r.ok) for r in checks] == [
        ("events", "", True), ("events", "schema_version", True), ("events", "nope", False),
        ("alerts", "", False), ("alerts", "window_bucket", False),
    ]
    empty = spark.createDataFrame([], ALERTS)
    assert R.rule_check_columns(empty).count() == len(R.RULE_CHECK_COLUMNS)
    assert R.rule_check_columns(empty.drop("reason")).count() == len(R.RULE_CHECK_COLUMNS) - 1
    assert set(schema.ALERT_DEFAULTS) < set(ALERTS.names)


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"user":"a"}\n\n')
    (tmp_path / "skip.txt").write_text("x\n")
    assert SR.scenario_lines(spark, str(tmp_path)).count() == 1
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "e.json").write_text('{"event_id":"4625","record_id":"9"}\n')
    typed = SR.windows_export(spark, str(tmp_path / "w"))
    assert typed.first().record_id == "9" and typed.columns == SR.WINDOWS_EXPORT.names
    assert SR.windows_export_records(spark, str(tmp_path / "w")).first().record == {"event_id": "4625", "record_id": "9"}
    forwarded = SR.forwarded_records(spark, str(tmp_path / "w")).first().record
    assert forwarded["tag"] == "windows.events" and forwarded["source_type"] == "fluent"
    assert SR.ssh_lines(spark, str(tmp_path / "skip.txt"), modified_after=datetime(2000, 1, 1)).count() == 1
    assert SR.ssh_lines(spark, str(tmp_path / "skip.txt"), modified_after=datetime(2100, 1, 1)).count() == 0
    assert SR.as_rows(spark.createDataFrame([(NOW, 1)], "ts timestamp, n int")).first().value == (
        '{"ts":"2026-04-09 08:00:00","n":1}'
    )
    assert SR.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8


def test_spread_bounds_the_rows_of_a_task(spark, monkeypatch):
    """As many splits as cores may still hold too many rows each."""
    monkeypatch.setattr(SR, "TASK_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 300 * cores, numPartitions=cores)
    assert SR.spread(rows).rdd.getNumPartitions() == 3 * cores
    assert SR.spread(rows.limit(50 * cores).repartition(cores)).rdd.getNumPartitions() == cores


def test_checkpoint_root(spark):
    assert stream_checkpoint(spark, "n", "/given") == "/given"
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert checkpoint_root(spark, "/x") == "/x"
        with pytest.raises(ValueError):
            checkpoint_root(spark)
        spark.conf.set("spark.checkpoint.dir", "/shared/")
        assert stream_checkpoint(spark, "n") == "/shared/streams/n"
        spark.conf.unset("spark.checkpoint.dir")


def test_scans_of_older_tables(spark, tmp_path):
    """Columns that files lack take their default; tables without day partitions take since."""
    row = {"ts": datetime(2024, 1, 2), "rule_id": "r", "hits": 3}
    spark.createDataFrame([row], "ts timestamp, rule_id string, hits bigint").write.parquet(f"{tmp_path}/a")
    for since in (None, datetime(2024, 1, 2), datetime(2024, 1, 2, 2, tzinfo=timezone(timedelta(hours=2)))):
        found = SR.scan_alerts(spark, f"{tmp_path}/a", since).first()
        assert (found.rule_id, found.hits, found.workflow_state, found.alert_fingerprint) == ("r", 3, "new", "")
    assert SR.scan_alerts(spark, f"{tmp_path}/a", datetime(2024, 1, 3)).count() == 0
