"""Streaming equals batch on the same files, and running a batch again changes nothing."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from authlane.operators import envelope as E
from authlane.operators import normalize as N
from authlane.operators import pack as P
from authlane.operators import tables as TB
from authlane.operators.rules import RULE_PACK
from authlane.operators.views import auth_events
from authlane.sources import readers as SR
from authlane.streaming import detect as SD
from authlane.streaming import ingest as SI
from authlane.streaming import offsets as SO

AS_OF = datetime(2026, 4, 9, 8, 35)


def wire(n, ts="2026-04-09 08:34:10.250", user="test-user", lane="vector-windows-endpoint", status="failure"):
    return json.dumps(
        {
            "ts": ts, "platform": "windows", "schema_version": "authlane.event.v1",
            "ingest_source": lane, "message": f"demo attempt={n}",
            "fields": {
                "event_type": "login", "user": user, "src_ip": "192.168.1.50", "host": "test-host",
                "status": status, "logon_type": "3", "source_kind": "windows_auth",
            },
        }
    )


@pytest.fixture()
def bus(tmp_path):
    folder = tmp_path / "bus"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join([wire(i) for i in range(3)] + ["{broken"]) + "\n")
    (folder / "b.txt").write_text("\n".join([wire(3), wire(4, ts=""), wire(5)]) + "\n")
    return str(folder)


def run_ingest(spark, bus, tmp_path, name="ck"):
    lines = SR.text_lines(spark, bus, stream=True)
    query = SI.ingest_envelopes(
        lines, str(tmp_path / "events"), str(tmp_path / "bad"), str(tmp_path / name)
    )
    query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_equals_batch_and_quarantines(spark, bus, tmp_path):
    run_ingest(spark, bus, tmp_path)
    stored = SR.scan_events(spark, str(tmp_path / "events"))
    batch = E.accepted(E.decode_envelopes(SR.text_lines(spark, bus)))
    columns = ["ts", "platform", "message", "ingest_source"]
    assert sorted(stored.select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert stored.count() == 5
    assert stored.select("event_id").distinct().count() == 5
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted(r.reason for r in bad.collect()) == ["empty timestamp", "invalid json"]
    # Nothing new: the checkpoint remembers, and the tables stay as they are.
    run_ingest(spark, bus, tmp_path)
    assert SR.scan_events(spark, str(tmp_path / "events")).count() == 5


def test_rewritten_batch_replaces_itself(spark, bus, tmp_path):
    path = str(tmp_path / "events")
    rows = E.with_event_id(E.accepted(E.decode_envelopes(SR.text_lines(spark, bus))))
    SI.write_batch(rows, path, 7, ("ts",))
    SI.write_batch(rows, path, 7, ("ts",))
    SI.write_batch(rows, path, 8, ("ts",))
    assert spark.read.parquet(path).count() == 2 * rows.count()


def test_batch_files_are_sorted(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.range(1000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("id") * 7919, F.lit(1000))).alias("ts"),
        F.lit("p").alias("platform"),
    )
    SI.write_batch(rows.repartition(4), str(path), 3, ("ts", "platform"))
    files = list(path.rglob("*.parquet"))
    assert files and all("batch_id=3" in str(f) for f in files)
    for f in files:
        stamps = [r.ts for r in spark.read.parquet(str(f)).collect()]
        assert stamps == sorted(stamps)


def test_detection_pass_fires_once(spark, bus, tmp_path):
    run_ingest(spark, bus, tmp_path)
    events, alerts = str(tmp_path / "events"), str(tmp_path / "alerts")
    SD.detection_pass(spark, events, alerts, RULE_PACK, AS_OF, batch_id=0)
    first = spark.read.parquet(alerts).collect()
    assert [(r.rule_id, r.hits, r.distinct_user_count, r.entity_host) for r in first] == [
        ("windows_failed_logon_burst", 5, 1, "test-host")
    ]
    SD.detection_pass(spark, events, alerts, RULE_PACK, AS_OF + timedelta(seconds=30), batch_id=1)
    assert spark.read.parquet(alerts).count() == 1
    # The first batch again: its own earlier output does not silence it.
    SD.detection_pass(spark, events, alerts, RULE_PACK, AS_OF, batch_id=0)
    assert spark.read.parquet(alerts).count() == 1


def test_detect_on_arrival(spark, bus, tmp_path):
    run_ingest(spark, bus, tmp_path)
    events, alerts = str(tmp_path / "events"), str(tmp_path / "alerts")
    stored = spark.readStream.schema(spark.read.parquet(events).schema).parquet(events)
    query = SD.detect_on_arrival(
        stored, events, alerts, RULE_PACK, str(tmp_path / "ck2"), AS_OF, trigger={"availableNow": True}
    )
    query.awaitTermination(120)
    assert query.exception() is None
    assert [r.alert_type for r in spark.read.parquet(alerts).collect()] == ["windows_failed_logon_burst"]


def test_sliding_bursts_equal_replay(spark, tmp_path):
    folder = tmp_path / "bus"
    folder.mkdir()
    base = datetime(2026, 4, 9, 8, 0)
    lines = []
    for i in range(40):
        ts = (base + timedelta(seconds=17 * i)).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
        status = "success" if i in (20, 39) else "failure"
        line = json.loads(wire(i, ts=ts, lane="synthetic-auth", status=status, user=f"u{i % 2}"))
        line["fields"]["source_kind"] = "linux_ssh"
        lines.append(json.dumps(line))
    (folder / "a.txt").write_text("\n".join(lines) + "\n")
    config = RULE_PACK[0].with_(window_minutes=2, threshold_value=3)
    stream = E.accepted(E.decode_envelopes(SR.text_lines(spark, str(folder), stream=True)))
    auth = auth_events(stream.withColumn("event_id", F.lit("x")))
    found = SD.apply_rule(SD.sliding_bursts(auth, 2, 30, "1 hour"), config)
    rows = P.alert_rows(found, config, config.parameter_text)
    query = SD.alert_stream(rows, str(tmp_path / "alerts"), str(tmp_path / "ck"))
    query.awaitTermination(180)
    assert query.exception() is None
    batch = E.accepted(E.decode_envelopes(SR.text_lines(spark, str(folder))))
    replayed = P.replay(
        auth_events(batch.withColumn("event_id", F.lit("x"))), [config], 30, base,
        base + timedelta(hours=1), top_n=None,
    )
    columns = ["ts", "alert_fingerprint", "hits", "window_start", "window_end"]
    streamed = spark.read.parquet(str(tmp_path / "alerts"))
    assert sorted(streamed.select(*columns).collect()) == sorted(replayed.select(*columns).collect())
    assert replayed.count() > 2


def test_lane_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "auth.log").write_text(
        "Apr  9 08:33:37 h1 sshd[4]: Failed password for admin from 203.0.113.77 port 22 ssh2\n"
        "Apr  9 08:33:38 h1 cron[4]: nothing\n"
    )
    raw = SR.ssh_lines(spark, str(folder), stream=True)
    query = SI.ingest_lane(
        raw, lambda df: N.normalize_ssh_auth(df, AS_OF), str(tmp_path / "events"), str(tmp_path / "ck")
    )
    query.awaitTermination(120)
    assert query.exception() is None
    row = SR.scan_events(spark, str(tmp_path / "events"), since=datetime(2026, 4, 9)).collect()
    assert len(row) == 1 and row[0].fields["user"] == "admin"


def test_redelivered_messages_are_dropped(spark, bus, tmp_path):
    decoded = E.accepted(E.decode_envelopes(SR.text_lines(spark, bus, stream=True)))
    # Messages 0 to 5 without 4; the position id repeats every second message.
    position = F.regexp_extract("message", r"(\d+)$", 1).cast("int") % 2
    events = E.with_event_id(decoded, F.lit("topic"), position.cast("string"))
    once = SI.without_redelivered(events)
    query = once.writeStream.format("memory").queryName("delivered").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("delivered").count() == 2


def test_publish_json_and_cooldown_stream(spark, bus, tmp_path):
    stream = E.accepted(E.decode_envelopes(SR.text_lines(spark, bus, stream=True)))
    SI.publish_json(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.json(str(tmp_path / "out")).count() == 5
    marked = stream.select("ts", F.lit("same").alias("alert_fingerprint"))
    once = SD.within_cooldown_once(marked, 300)
    query = once.writeStream.format("memory").queryName("cooled").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("cooled").count() == 1


def test_two_writers_share_a_table(spark, tmp_path):
    """Batches of equal number from two streams, and from a new checkpoint, all stay."""
    path = str(tmp_path / "table")
    source = str(tmp_path / "in")
    spark.range(4).selectExpr("timestamp'2024-01-01 10:00:00' AS ts", "id").write.parquet(source)
    for name in ("a", "b", "c"):
        rows = spark.readStream.schema("ts timestamp, id long").parquet(source)
        SI.start(
            rows, lambda batch, n: SI.write_batch(batch, path, n, ("ts",)), name, str(tmp_path / name), None
        ).awaitTermination()
    assert spark.read.parquet(path).count() == 12


def test_a_zone_does_not_change_the_rows_scanned(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    from authlane.functions.times import utc_day

    moment = datetime(2024, 1, 1, 23, 30)
    shifted = moment.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=2)))
    assert utc_day(moment) == utc_day(shifted) == "2024-01-01"


def test_retention_of_a_streamed_table(spark, tmp_path):
    from datetime import datetime

    from authlane.operators.tables import apply_retention

    path = str(tmp_path / "table")
    for n, hour in enumerate(("2024-01-01 05:00:00", "2024-01-02 05:00:00", "2024-01-02 15:00:00")):
        SI.write_batch(spark.sql(f"SELECT timestamp'{hour}' AS ts, {n}L AS id"), path, n, ("ts",))
    assert apply_retention(spark, path, datetime(2024, 1, 9, 10), 7) == ["2024-01-01"]
    spark.catalog.refreshByPath(path)
    left = spark.read.parquet(path)
    assert [r.id for r in left.collect()] == [2]
    assert {"day", "writer", "batch_id"} <= set(left.columns)


def test_streamed_facts_take_only_rules_without_further_aggregation(spark):
    config = next(c for c in RULE_PACK if c.id == "security_source_multi_user_burst")
    with pytest.raises(ValueError, match="streamed facts"):
        SD.apply_rule(spark.range(1), config)


def _old_alert(spark, moment="2026-04-09 08:34:00"):
    """An alert as the first version stored it: fewer columns."""
    return spark.sql(
        f"SELECT timestamp'{moment}' AS ts, 'windows_failed_logon_burst' AS rule_id, 'old' AS rule_name, "
        "'windows_failed_logon_burst' AS alert_type, 'x|y' AS alert_fingerprint, 'high' AS severity, 5L AS hits"
    )


def test_recorded_alerts_of_older_tables(spark, tmp_path):
    """Tables without a writer, or without partitions, and without the later columns are read."""
    by_batch, flat = str(tmp_path / "by_batch"), str(tmp_path / "flat")
    rows = _old_alert(spark).withColumn("day", F.to_date("ts")).withColumn("batch_id", F.lit(3))
    rows.write.partitionBy("day", "batch_id").parquet(by_batch)
    _old_alert(spark).write.parquet(flat)
    for path in (by_batch, flat):
        found = SD.recorded_alerts(spark, path, except_batch=3).collect()
        assert [(r.alert_fingerprint, r.hits, r.workflow_state, r.principal) for r in found] == [("x|y", 5, "new", "")]
    assert SD.recorded_alerts(spark, str(tmp_path / "none")).count() == 0
    later = datetime(2026, 4, 10)
    assert SD.recorded_alerts(spark, by_batch, since=later).count() == 0


def test_another_layout_is_refused_and_upgraded(spark, bus, tmp_path):
    path, into = str(tmp_path / "old"), str(tmp_path / "new")
    rows = _old_alert(spark).withColumn("day", F.to_date("ts")).withColumn("batch_id", F.lit(3))
    rows.write.partitionBy("day", "batch_id").parquet(path)
    with pytest.raises(ValueError, match="batch_id=3 where writer="):
        SI.write_batch(_old_alert(spark), path, 4, ("ts",))
    assert spark.read.parquet(path).count() == 1  # still whole and readable
    SI.upgrade_layout(spark, path, into)
    SI.write_batch(_old_alert(spark), into, 4, ("ts",))
    assert sorted(r.writer for r in spark.read.parquet(into).collect()) == ["w-direct", "w-upgraded"]
    flat = str(tmp_path / "flat")
    _old_alert(spark).write.parquet(flat)
    with pytest.raises(ValueError, match="where day="):
        SI.write_batch(_old_alert(spark), flat, 4, ("ts",))


def test_a_lane_quarantines_what_it_cannot_use(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    good = "Apr  9 08:33:37 h1 sshd[4]: Failed password for admin from 203.0.113.77 port 22 ssh2"
    bad = "Apr  9 08:33:39 h1 sshd[4]: Accepted nonsense"
    (folder / "auth.log").write_text("\n".join([good, bad, "Apr  9 08:33:38 h1 cron[4]: Failed x", ""]) + "\n")
    events, quarantine = str(tmp_path / "events"), str(tmp_path / "bad")
    for _ in range(2):  # the second start finds nothing new
        query = SI.ingest_lane(
            SR.ssh_lines(spark, str(folder), stream=True), lambda df: N.normalize_ssh_auth(df, AS_OF), events,
            str(tmp_path / "ck"), name="ssh", quarantine_path=quarantine, reject_reason=N.ssh_reject_reason(),
        )
        query.awaitTermination(120)
        assert query.exception() is None
    assert [r.fields["user"] for r in SR.scan_events(spark, events).collect()] == ["admin"]
    kept = spark.read.parquet(quarantine)
    assert [(r.lane, r.raw, r.reason) for r in kept.collect()] == [("ssh", bad, "unsupported line")]
    # Laid out by day as events are, so it expires like them.
    at = kept.first().ts
    assert len(TB.apply_retention(spark, quarantine, at + timedelta(days=40), 30)) == 1


def test_lane_reject_reasons(spark):
    lines = spark.createDataFrame([('{"a": "b"}',), ("{broken",), ("  ",), ('{"timestamp": "yesterday"}',)], "value string")
    records = N.decode_records(lines)
    found = lambda reason: sorted(r.reason for r in N.rejected(records, reason).collect())
    assert found(N.windows_reject_reason()) == ["invalid json"]
    assert found(N.generic_reject_reason()) == ["invalid json", "unsupported timestamp format"]


def test_a_lane_quarantine_needs_both_parts(spark):
    with pytest.raises(ValueError, match="path and a reason"):
        SI.ingest_lane(None, None, "events", quarantine_path="bad")


def positions(spark, tmp_path, name):
    lines = SR.text_lines(spark, str(tmp_path / name), stream=True)
    part = F.regexp_extract("value", r"attempt=(\d+)", 1).cast("long")
    return lines.withColumns({"topic": F.lit("t"), "offset": part})


def test_a_redelivered_range_is_stored_once(spark, tmp_path):
    folder, other = tmp_path / "in", tmp_path / "again"
    folder.mkdir()
    other.mkdir()
    events, bad, seen = (str(tmp_path / n) for n in ("events", "bad", "seen"))

    def ingest(name, checkpoint):
        query = SI.ingest_envelopes(
            positions(spark, tmp_path, name), events, bad, str(tmp_path / checkpoint), ("topic", "offset"), seen_path=seen
        )
        query.awaitTermination(120)
        assert query.exception() is None

    def stored():
        return sorted(int(r.message.split("=")[1]) for r in SR.scan_events(spark, events).collect())

    (folder / "a.txt").write_text("\n".join(wire(i) for i in [0, 1, 2, 5, 6, 6]) + "\n")
    ingest("in", "ck")
    assert stored() == [0, 1, 2, 5, 6]
    # Later in the same stream, the source goes back.
    (folder / "b.txt").write_text("\n".join(wire(i) for i in [1, 2, 3, 6, 7]) + "\n")
    ingest("in", "ck")
    assert stored() == [0, 1, 2, 3, 5, 6, 7]
    # A new stream, with a checkpoint of its own, starts from the beginning.
    (other / "c.txt").write_text("\n".join(wire(i) for i in range(10)) + "\n")
    ingest("again", "ck2")
    assert stored() == list(range(10))
    ranges = SO.merged_ranges(spark.read.schema(SO.RANGES).parquet(seen).drop("writer", "batch_id")).collect()
    assert [(r.source, r.first, r.after) for r in ranges] == [("t", 0, 10)]


def test_a_batch_run_again_finds_its_own_messages_new(spark, tmp_path):
    path = str(tmp_path / "seen")
    rows = lambda *at: SO.with_position(spark.createDataFrame([("t", a) for a in at], "topic string, offset long"), ("topic", "offset"))
    for n, at in enumerate([(0, 1), (2, 3), (7,)]):
        for _ in range(2):  # each batch twice
            seen, own = SO.read_seen(spark, path, "me", n)
            new = SO.not_seen(rows(*at, 0), seen)
            assert sorted(r.at for r in new.collect()) == sorted({*at, *([0] if n == 0 else [])})
            SO.write_seen(own, SO.offset_ranges(new), path, "me", n)
    found = spark.read.schema(SO.RANGES).parquet(path)
    # The last state and the one before it, which a re-run needs.
    assert sorted({r.batch_id for r in found.collect()}) == [1, 2]
    last = SO.read_seen(spark, path, "me", 3)[0].collect()
    assert sorted((r["first"], r.after) for r in last) == [(0, 4), (7, 8)]


def test_offset_ranges_over_slices_and_without_position(spark):
    at = [*range(65530, 65545), 3, 3, -2, -1, None]
    rows = spark.createDataFrame([("s", a) for a in at] + [(None, 4)], "topic string, offset long")
    placed = SO.with_position(rows, ("topic", "offset"))
    found = SO.offset_ranges(placed).collect()
    assert sorted((r["first"], r.after) for r in found) == [(-2, 0), (3, 4), (65530, 65545)]
    left = SO.not_seen(placed, SO.offset_ranges(placed.where("at > 0")))
    assert sorted(r.at for r in left.where("at IS NOT NULL").collect()) == [-2, -1]
    assert left.where("at IS NULL").count() == 2
