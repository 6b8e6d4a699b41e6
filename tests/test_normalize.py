from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from authlane.functions.parse import parse_event_time, parse_rfc3339
from authlane.functions.times import bucket_start, minute_boundaries
from authlane.operators import envelope as E
from authlane.operators import normalize as N
from authlane.settings import Settings
from authlane.sources import readers as SR
from authlane.sources import windows_export as W

AS_OF = datetime(2026, 4, 9, 8, 40)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def records(spark, *objects):
    return N.decode_records(lines(spark, *[o if isinstance(o, str) else json.dumps(o) for o in objects]))


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def text(ts):
    return ts.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


# Generic lane.


@pytest.mark.parametrize(
    "record, lane",
    [
        ({}, "vector-syslog"),
        ({"source_type": "demo_logs"}, "vector-demo_logs"),
        ({"source_type": "fluent"}, "vector-fluent"),
        ({"source_type": "fluent", "tag": "windows.events"}, "vector-windows-endpoint"),
        ({"source_type": "syslog", "tag": "windows.events"}, "vector-syslog"),
    ],
)
def test_generic_lane(spark, record, lane):
    assert one(N.normalize_generic(records(spark, record), AS_OF)).ingest_source == lane


def test_generic_message_order_and_blank(spark):
    assert one(N.normalize_generic(records(spark, {"log": "l", "msg": "m"}), AS_OF)).message == "l"
    assert one(N.normalize_generic(records(spark, {"Message": "M"}), AS_OF)).message == "M"
    # A present blank counts as present.
    assert one(N.normalize_generic(records(spark, {"message": "", "log": "l"}), AS_OF)).message == ""
    assert one(N.normalize_generic(records(spark, {}), AS_OF)).message == N.NO_MESSAGE_TEXT


def test_generic_fields_twins_and_time(spark):
    row = one(
        N.normalize_generic(
            records(
                spark,
                {"Channel": "Security", "channel": "App", "Computer": "C", "EventID": 4625, "x": 1,
                 "timestamp": "2026-04-09T10:33:37.680123+02:00"},
            ),
            AS_OF,
            Settings(namespace="acme"),
        )
    )
    assert row.fields == {
        "channel": "App", "computer": "C", "event_id": "4625", "schema_version": "acme.event.v1",
    }
    assert text(row.ts) == "2026-04-09 08:33:37.680"
    assert one(N.normalize_generic(records(spark, {}), AS_OF)).ts == AS_OF
    for stamp in ("yesterday", "", None):
        bad = records(spark, {"timestamp": stamp})
        assert N.normalize_generic(bad, AS_OF).count() == 0
        assert bad.select(N.generic_reject_reason()).first()[0] == "unsupported timestamp format"


# Synthetic lane.


def test_synthetic_defaults(spark):
    row = one(N.normalize_synthetic_auth(records(spark, {"platform": "Windows", "run_id": "r"}), AS_OF))
    assert row.platform == "windows" and row.message == "synthetic auth event"
    assert row.fields["source_kind"] == "windows_auth"
    assert row.fields["collector_name"] == "authlane-sim"
    assert row.fields["event_type"] == "login" and row.fields["user"] == ""
    assert "scenario" not in row.fields and "run_id" not in row.fields
    bare = one(N.normalize_synthetic_auth(records(spark, {}), AS_OF))
    assert bare.platform == "synthetic-auth" and bare.fields["source_kind"] == "linux_ssh"


def test_synthetic_rejects(spark):
    bad = records(spark, "{cut", {"timestamp": "yesterday"}, {"timestamp": "2026-04-09T08:33:37Z"})
    reasons = [r[0] for r in bad.select(N.synthetic_reject_reason()).collect()]
    assert reasons == ["invalid json", "unsupported timestamp format", None]
    assert N.normalize_synthetic_auth(bad, AS_OF).count() == 1


def test_scenario_stamp(spark):
    stamped = SR.stamp_scenario(lines(spark, '{"user":"a"}', ""), "spray", AS_OF)
    assert json.loads(one(stamped).value) == {
        "user": "a", "timestamp": "2026-04-09T08:40:00Z", "run_id": "20260409T084000Z-spray",
    }


# SSH lane.

SSH = "Apr  9 08:33:37 authhost sshd[440]: "


@pytest.mark.parametrize(
    "line, expected",
    [
        (SSH + "Failed password for admin from 203.0.113.77 port 22 ssh2",
         ("admin", "203.0.113.77", "failure", "password")),
        (SSH + "Failed password for invalid user bob from fe80::1 port 22 ssh2",
         ("bob", "fe80::1", "failure", "password")),
        ("Apr 19 08:33:37 h sshd: Accepted publickey for deploy from 10.0.0.1",
         ("deploy", "10.0.0.1", "success", "publickey")),
        (SSH + "Failed keyboard-interactive/pam for admin from 10.0.0.1 port 22 ssh2", None),
        (SSH + "Connection closed by 10.0.0.1", None),
        ("Apr  9 08:33:37 h cron[4]: Failed password for a from 10.0.0.1", None),
    ],
)
def test_ssh_lines(spark, line, expected):
    rows = N.normalize_ssh_auth(lines(spark, line), AS_OF).collect()
    if expected is None:
        assert rows == []
    else:
        f = rows[0].fields
        assert (f["user"], f["src_ip"], f["status"], f["auth_method"]) == expected
        assert rows[0].message == f["raw_message"] == line


def test_ssh_time(spark):
    ok = SSH + "Failed password for admin from 203.0.113.77 port 22 ssh2"
    assert text(one(N.normalize_ssh_auth(lines(spark, ok), AS_OF)).ts) == "2026-04-09 08:33:37.000"
    assert one(N.normalize_ssh_auth(lines(spark, ok), AS_OF, reference_year=2025)).ts.year == 2025
    odd = ok.replace("Apr", "Foo")
    assert one(N.normalize_ssh_auth(lines(spark, odd), AS_OF)).ts == AS_OF


# Windows lane.

LOGON = {
    "timestamp": "2026-04-09T08:33:37.6800000Z", "event_id": "4625", "user": "admin", "domain": "LAB",
    "src_ip": "203.0.113.77", "host": "WIN-1", "logon_type": "3", "auth_method": "NTLM",
    "provider_name": "P", "raw_message": "", "record_id": "7",
}


def test_windows_sample(spark):
    row = one(N.normalize_windows_auth(records(spark, LOGON), AS_OF))
    assert row.message == (
        "Windows logon failure user=admin src_ip=203.0.113.77 host=WIN-1 event_id=4625"
    )
    assert text(row.ts) == "2026-04-09 08:33:37.680"
    assert row.fields["auth_method"] == "ntlm" and row.fields["computer"] == "WIN-1"


@pytest.mark.parametrize(
    "change",
    [{"event_id": "4634"}, {"logon_type": "5"}, {"user": ""}, {"user": "-"}, {"event_id": None}],
)
def test_windows_drops(spark, change):
    assert N.normalize_windows_auth(records(spark, LOGON | change), AS_OF).count() == 0


@pytest.mark.parametrize(
    "address, kept",
    [("-", ""), ("::1", ""), ("::ffff:127.0.0.1", ""), ("127.0.0.1", "127.0.0.1")],
)
def test_windows_address(spark, address, kept):
    row = one(N.normalize_windows_auth(records(spark, LOGON | {"src_ip": address}), AS_OF))
    assert row.fields["src_ip"] == kept
    assert (" src_ip=" in row.message) == (kept != "")


def test_windows_text_fallbacks(spark):
    changed = LOGON | {"host": "", "raw_message": "a\r\nb", "timestamp": "n/a", "event_id": 4624}
    row = one(
        N.normalize_windows_auth(records(spark, changed), AS_OF, Settings(collector_name="col"))
    )
    assert row.fields["host"] == "col" and row.message.endswith(" details=a  b")
    assert row.fields["status"] == "success" and row.ts == AS_OF
    both = spark.createDataFrame([("", "out"), ("msg", "out")], "message string, stdout string")
    assert [r.value for r in N.windows_payload(both).collect()] == ["out", "msg"]


def test_eventdata_xml(spark):
    xml = (
        "<Event xmlns='http://schemas.microsoft.com/win/2004/08/events/event'><EventData>"
        "<Data Name='A'>1</Data><Data Name='B'></Data><Data>x</Data><Data Name=' '>y</Data>"
        "<Data Name='A'>2</Data></EventData></Event>"
    )
    df = spark.createDataFrame([(xml,), ("<Event/>",), ("oops",)], "xml string")
    got = [r[0] for r in df.select(W.eventdata_map(F.col("xml"))).collect()]
    assert got == [{"B": "", "A": "2"}, {}, {}]


def test_cursor():
    assert W.parse_cursor("v2:17") == 17
    assert W.parse_cursor("17") == W.parse_cursor("") == W.parse_cursor(None) == 0


def test_export_cursor_moves_to_emitted_only(spark):
    def event(record, logon):
        xml = (
            "<Event><EventData><Data Name='SubjectUserName'>svc</Data>"
            f"<Data Name='LogonType'>{logon}</Data><Data Name='LogonProcessName'>Adv</Data>"
            "</EventData></Event>"
        )
        return (AS_OF, 4625, "WIN", "P", " a\r\nb ", record, xml)

    rows = spark.createDataFrame(
        [event(5, 3), event(6, 3), event(7, 5)],
        "time_created timestamp, event_id int, machine_name string, provider_name string, "
        "message string, record_id bigint, xml string",
    )
    out = W.incremental_export(rows, "v2:5", AS_OF)
    assert one(W.next_cursor(out, 5)).cursor == "v2:6"
    assert one(W.next_cursor(out.limit(0), 5)).cursor == "v2:5"
    record = json.loads(one(W.emitted(out)).value)
    assert record["user"] == "svc" and record["auth_method"] == "Adv"
    assert record["raw_message"] == "a b" and record["record_id"] == "6"
    counts = one(W.drop_counts(W.export_records(rows, 5)))
    assert (counts.scanned, counts.already_seen, counts.unsupported_logon_type, counts.emitted) == (3, 1, 1, 1)


# Wire envelope.


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05.000"),
        (" 2024-01-02 03:04:05.678 ", "2024-01-02 03:04:05.678"),
        ("2024-01-02 03:04:05.678901", "2024-01-02 03:04:05.678"),
        ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05.000"),
        ("2024-01-02T03:04:05.123456789+02:00", "2024-01-02 01:04:05.123"),
        ("2024", None), ("2024-01-02", None), ("2024-02-30 00:00:00", None), ("", None),
        ("2024-01-02T03:04:05", None),
    ],
)
def test_event_time(spark, value, expected):
    got = lines(spark, value).select(parse_event_time(F.col("value")).alias("t")).first().t
    assert (None if got is None else text(got)) == expected


def test_rfc3339_needs_offset(spark):
    got = lines(spark, "2024-01-02 03:04:05").select(parse_rfc3339(F.col("value")).alias("t")).first().t
    assert got is None


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1.0", "1"), ("1e3", "1000"), ("1e21", "1000000000000000000000"), ("1.5e-7", "0.00000015"),
        ("0.1", "0.1"), ("-2.5e10", "-25000000000"), ("123456789.125", "123456789.125"),
        ("12345678.9", "12345678.9"), ("0", "0"), ("true", "true"), ('"1.0"', "1.0"),
        ('{"z":1,"a":"<b>&"}', '{"a":"\\u003cb\\u003e\\u0026","z":1}'), ("[1,2.5,null]", "[1,2.5,null]"),
    ],
)
def test_stringify(spark, value, expected):
    line = '{"ts":"2024-01-02 03:04:05","fields":{"k":%s,"n":null,"":"x"}}' % value
    assert one(E.accepted(E.decode_envelopes(lines(spark, line)))).fields == {"k": expected}


@pytest.mark.parametrize(
    "value, expected",
    [
        ("[1e-7,-1.5e-300,1e300,1e20,12345678901234567890]", "[1e-7,-1.5e-300,1e+300,100000000000000000000,12345678901234567000]"),
        ("[0.000001,-0.25,1.0,1e400]", '[0.000001,-0.25,1,"Infinity"]'),
        ("1e-300", "0." + "0" * 299 + "1"), ("1e400", "Infinity"),
    ],
)
def test_stringify_exponents(spark, value, expected):
    test_stringify(spark, value, expected)


@pytest.mark.parametrize(
    "line, reason",
    [
        ("{cut", "invalid json"), ("[1]", "invalid json"), ('{"ts":""}', "empty timestamp"), ("{}", "empty timestamp"),
        ('{"ts":"2024"}', "unsupported timestamp format"),
        ('{"ts":"2024-01-02 03:04:05","platform":5}', "wrong type"),
        ('{"ts":"2024-01-02 03:04:05","fields":[1]}', "wrong type"),
        ('{"ts":"2024-01-02 03:04:05","fields":null,"platform":null,"extra":1}', None),
    ],
)
def test_reject_reason(spark, line, reason):
    assert one(E.decode_envelopes(lines(spark, line))).reject_reason == reason


def test_repeated_key_keeps_the_last(spark):
    line = '{"ts":"2024-01-02 03:04:05","message":"a","message":"b"}'
    assert one(E.accepted(E.decode_envelopes(lines(spark, line)))).message == "b"


def test_identical_rows_are_kept(spark):
    line = '{"ts":"2024-01-02 03:04:05","message":"m"}'
    rows = E.with_event_id(E.accepted(E.decode_envelopes(lines(spark, line, line))))
    assert rows.select("event_id").distinct().count() == 2


# Time helpers.


def test_minute_boundaries_and_buckets(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 00:00:59' a, TIMESTAMP '2024-01-01 00:01:01' b"
    ).select(
        minute_boundaries(F.col("a"), F.col("b")).alias("one"),
        minute_boundaries(F.col("b"), F.col("a")).alias("back"),
        bucket_start(F.col("b"), 15).alias("bucket"),
    )
    row = one(df)
    assert (row.one, row.back, row.bucket) == (1, -1, datetime(2024, 1, 1))
