"""What the plans must look like for large tables."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from authlane.operators import detections as D
from authlane.operators import panes
from authlane.operators import pack as P
from authlane.operators import reports as R
from authlane.operators import tables as T
from authlane.operators.rules import RULE_PACK
from authlane.operators.views import auth_events
from authlane.plans import bindings as B
from authlane.plans import catalog
from authlane.session import configure
from authlane.sources import readers as SR

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 20, 12)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    configure(spark)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    path = str(tmp_path_factory.mktemp("tables") / "events")
    T.write_table(B.bound_events(spark, SF), path, T.EVENT_SORT)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_rule_scan_is_pruned(spark, stored):
    config = RULE_PACK[2].with_(window_minutes=600)
    since = AS_OF - timedelta(minutes=600)
    auth = auth_events(SR.scan_events(spark, stored, since))
    text = plan(D.detect(auth, config, AS_OF))
    scan = re.search(r"FileScan parquet.*", text).group(0)
    assert "GreaterThan(ts," in scan and "day" in scan.split("PartitionFilters")[1].split("]")[0]
    schema = scan.split("ReadSchema")[1]
    assert "message" in schema and "fields" in schema
    for unread in ("event_id", "platform", "schema_version"):
        assert unread not in schema


def test_stored_logins_push_the_rule_filter(spark, stored, tmp_path):
    path = str(tmp_path / "auth")
    T.write_table(auth_events(SR.scan_events(spark, stored)), path, ("ts",))
    auth = spark.read.parquet(path)
    text = plan(D.detect(auth, RULE_PACK[2].with_(window_minutes=600), AS_OF))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "EqualTo(status,failure)" in pushed and "GreaterThan(ts," in pushed


def test_pack_scans_once(spark, stored):
    auth = auth_events(SR.scan_events(spark, stored))
    configs = [c.with_(window_minutes=30 * 1440) for c in RULE_PACK]
    text = final_plan(P.run_pack(auth, configs, AS_OF, top_n=None))
    assert text.count("FileScan") == 1
    assert text.count("ReusedExchange") == len(configs) - 1


def test_replay_scans_once(spark, stored):
    auth = auth_events(SR.scan_events(spark, stored))
    configs = [c.with_(window_minutes=1440) for c in RULE_PACK]
    replayed = P.replay(auth, configs, 6 * 3600, B.START, B.AS_OF, top_n=None)
    assert final_plan(replayed).count("FileScan") == 1


def test_facts_aggregate_by_hash(spark, stored):
    auth = auth_events(SR.scan_events(spark, stored))
    text = plan(D.login_facts(auth, AS_OF, [60]))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_latest_is_top_k(spark, stored):
    auth = auth_events(SR.scan_events(spark, stored))
    assert "TakeOrderedAndProject" in plan(R.events_feed(auth))


def test_per_tick_top_n_is_limited_before_the_shuffle(spark, stored):
    auth = auth_events(SR.scan_events(spark, stored))
    config = RULE_PACK[0].with_(window_minutes=1440, threshold_value=1)
    facts = panes.replay_facts(auth, [1440], 6 * 3600, B.START, B.AS_OF)
    assert "WindowGroupLimit" in plan(D.evaluate(facts, config, 1, per_tick=True))


def test_hot_source_is_exact(spark):
    """One source with every row and many more users than a slice's share."""
    base = spark.range(200_000).select(
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id")).alias("ts"),
        F.concat(F.lit("u"), F.lpad((F.col("id") % 50_000).cast("string"), 6, "0")).alias("user"),
        F.lit("6.6.6.6").alias("src_ip"), F.lit("h").alias("host"), F.lit("failure").alias("status"),
        F.lit("linux_ssh").alias("source_kind"), F.lit("x").alias("ingest_source"), F.lit("").alias("logon_type"),
    )
    row = D.detect(base, RULE_PACK[2], datetime(2023, 11, 14, 22, 14)).collect()
    assert len(row) == 1
    assert (row[0].hits, row[0].distinct_user_count) == (200_000, 50_000)
    assert row[0].evidence_summary.endswith("Examples: u000000, u000001, u000002, u000003, u000004")


def test_maps_are_written_out_once(spark):
    """A filter on the map's size must not build the map a second time."""
    text = plan(catalog.QUERIES["stringify_map"](spark, SF))
    assert text.count("transform_values(") == 1
