"""Newest rows of stored tables: the same as over the whole table, from few days."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from authlane.operators import reports as R
from authlane.operators import stored_feeds as SF
from authlane.operators import tables as T
from authlane.operators.views import auth_events
from authlane.plans import bindings as B
from authlane.sources import readers as SR

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "events")
    T.write_table(B.bound_events(spark, DATA), path, T.EVENT_SORT)
    return path


@pytest.fixture(scope="module")
def alerts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "alerts")
    rows = [(datetime(2024, 1, 1 + i // 4, i % 4), f"rule{i % 5}", f"print{i}", 1) for i in range(100)]
    new = spark.createDataFrame(rows, "ts timestamp, rule_id string, alert_fingerprint string, hits bigint")
    T.write_table(new, path, ("ts", "rule_id"))
    return path


def same(found, whole):
    assert found.columns == whole.columns
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in whole.collect()]


def test_feeds_equal_those_over_the_whole_table(spark, events):
    all_events = SR.scan_events(spark, events)
    auth = auth_events(all_events).cache()
    user, ip = auth.where("user <> ''").select("user", "src_ip").first()
    same(SF.events_feed(spark, events, 7), R.events_feed(auth, 7))
    same(SF.recent_events(spark, events, 30), R.recent_events(all_events, 30))
    same(SF.windows_lane_latest(spark, events), R.windows_lane_latest(auth))
    same(SF.windows_lane_latest(spark, events, "HOST-1", 3), R.windows_lane_latest(auth, "HOST-1", 3))
    same(SF.investigate(spark, events, user, ip), R.investigate(auth, user, ip))
    same(SF.investigate(spark, events, "nobody", "nowhere"), R.investigate(auth, "nobody", "nowhere"))
    same(SF.latest_auth(spark, events, 5, status="failure"), R.latest_auth(auth, 5, status="failure"))
    same(SF.latest_auth(spark, events, 100000), R.latest_auth(auth, 100000))
    last = auth.agg(F.max("ts")).first()[0]
    for as_of in (last, last + timedelta(days=3), last - timedelta(days=3), last.replace(tzinfo=timezone.utc)):
        same(SF.health(spark, events, as_of), R.health(auth, as_of))
    auth.unpersist()


def test_alert_feeds(spark, alerts):
    whole = SR.scan_alerts(spark, alerts)
    same(SF.alerts_feed(spark, alerts, 6), R.alerts_feed(whole, 6))
    same(SF.latest_alerts(spark, alerts, 3, rule_id="rule2"), R.latest_alerts(whole, 3, rule_id="rule2"))
    same(SF.latest_alerts(spark, alerts, 3, rule_id="none"), R.latest_alerts(whole, 3, rule_id="none"))


def test_only_the_newest_days_are_read(spark, alerts):
    since = lambda n: SF.newest_since(spark, alerts, SR.scan_alerts, n, lambda df: df)
    assert [since(n).day for n in (1, 4, 5, 8, 9, 17)] == [25, 25, 24, 24, 22, 18]
    assert since(101) is None  # more than there are: the whole table
    plan = SF.latest_alerts(spark, alerts, 2)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-25", plan)


def test_rows_without_time_and_other_layouts(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a"), (datetime(2024, 1, 1), "b"), (datetime(2024, 1, 3), "c")], "ts timestamp, rule_id string")
    T.write_table(rows, f"{tmp_path}/days", ("ts",))
    found = SF.latest_alerts(spark, f"{tmp_path}/days", 3)
    assert [r.rule_id for r in found.collect()] == ["c", "b", "a"]
    rows.write.parquet(f"{tmp_path}/flat")
    assert SF.stored_days(spark, f"{tmp_path}/flat") == []
    assert [r.rule_id for r in SF.latest_alerts(spark, f"{tmp_path}/flat", 1).collect()] == ["c"]
