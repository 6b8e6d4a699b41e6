from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from authlane.functions.times import as_of_col
from authlane.operators import detections as D
from authlane.operators import envelope as E
from authlane.operators import normalize as N
from authlane.operators import pack as P
from authlane.operators import reports as R
from authlane.operators import rules as RU
from authlane.operators.rules import RULE_PACK, RuleConfig, RuleConfigError
from authlane.operators.views import auth_events, endpoint_activity, recent_login_detections
from authlane.schema import ALERTS, EVENTS, RULE_RESULT

NOW = datetime(2026, 4, 9, 8, 33, 37)
BY_ID = {c.id: c for c in RULE_PACK}
BURST, SEQUENCE, SPRAY, DISTRIBUTED, WINDOWS = (c for c in BY_ID)


def attempt(user, ip, host="web-01", status="failure", **more):
    return {
        "platform": "linux", "message": f"sshd[1]: login of {user}", "user": user, "src_ip": ip,
        "host": host, "status": status, "source_kind": "linux_ssh", **more,
    }


SCENARIOS = {
    "password-spray": [attempt(u, "198.51.100.25") for u in ("admin", "backup", "deploy", "root")],
    "distributed-attack": [
        attempt("analyst", f"198.51.100.{n}", "jump-01") for n in (41, 42, 43, 44)
    ],
    "fail-then-success": [
        attempt("svc-admin", "203.0.113.77", "win-app-01", s, platform="windows", source_kind="windows_auth")
        for s in ("failure", "failure", "failure", "success")
    ],
    "benign-success": [attempt(u, "192.0.2.1", status="success") for u in ("a", "b", "c", "d")],
}


def scenario_auth(spark, *names, at=NOW):
    values = [(json.dumps(r),) for n in names for r in SCENARIOS[n]]
    lines = spark.createDataFrame(values, "value string")
    return auth_events(E.with_event_id(N.normalize_synthetic_auth(N.decode_records(lines), at)))


def auth_rows(spark, rows):
    """(seconds after NOW, user, ip, host, status, lane, kind) as login events."""
    data = [
        (NOW + timedelta(seconds=s), "e", "p", "v", lane, "m", "login", u, ip, h, st, kind, "", "3", "", "", "")
        for s, u, ip, h, st, lane, kind in rows
    ]
    from authlane.schema import AUTH_EVENTS

    return spark.createDataFrame(data, AUTH_EVENTS)


def fail(s, user="u", ip="1.1.1.1", host="h", status="failure", lane="vector-linux-ssh", kind="linux_ssh"):
    return (s, user, ip, host, status, lane, kind)


@pytest.mark.parametrize(
    "scenario, expected",
    [
        ("password-spray", [(SPRAY, 4, 4, 1)]),
        ("distributed-attack", [(DISTRIBUTED, 4, 1, 4)]),
        ("fail-then-success", [(SEQUENCE, 3, 1, 1)]),
        ("benign-success", []),
    ],
)
def test_scenarios(spark, scenario, expected):
    auth = scenario_auth(spark, scenario)
    alerts = P.run_pack(auth, RULE_PACK, NOW + timedelta(seconds=30)).collect()
    assert [(a.rule_id, a.hits, a.distinct_user_count, a.distinct_ip_count) for a in alerts] == expected
    if scenario == "password-spray":
        assert alerts[0].evidence_summary == (
            "4 usernames targeted across 4 failed attempts. Examples: admin, backup, deploy, root"
        )
        assert json.loads(alerts[0].details)["targeted_users"] == 4


def test_second_pass_is_quiet(spark):
    auth = scenario_auth(spark, *SCENARIOS)
    first = P.run_pack(auth, RULE_PACK, NOW + timedelta(seconds=30), P.empty_alerts(spark))
    assert first.count() == 3 and first.columns == ALERTS.names
    assert P.run_pack(auth, RULE_PACK, NOW + timedelta(seconds=60), first).count() == 0
    assert R.duplicate_fingerprints(first, lookback_minutes=None).count() == 0
    assert R.duplicate_entity_buckets(first, lookback_minutes=None).count() == 0


def test_windows_burst_and_lane_exclusion(spark):
    rows = [fail(i, lane="vector-windows-endpoint", kind="windows_auth", host="") for i in range(5)]
    alerts = P.run_pack(auth_rows(spark, rows), RULE_PACK, NOW + timedelta(seconds=10), top_n=None).collect()
    assert [(a.rule_id, a.endpoint_id, a.source_kind) for a in alerts] == [
        (WINDOWS, "unknown", "windows_auth")
    ]


def test_burst_threshold_and_kind(spark):
    config = BY_ID[BURST]
    at = NOW + timedelta(seconds=60)
    assert D.detect(auth_rows(spark, [fail(i) for i in range(4)]), config, at).count() == 0
    row = D.detect(auth_rows(spark, [fail(i) for i in range(5)]), config, at).first()
    assert row.hits == 5 and row.reason == "Repeated failed logins for account u from 1.1.1.1 on h"
    assert row.details == (
        '{"principal":"u","source_ip":"1.1.1.1","endpoint_id":"h","failed_attempts":5,"window_minutes":5}'
    )
    assert row.window_bucket == datetime(2026, 4, 9, 8, 30)
    other = [fail(i, kind="") for i in range(5)]
    assert D.detect(auth_rows(spark, other), config, at).count() == 0
    blank = [fail(i, ip="") for i in range(5)]
    assert D.detect(auth_rows(spark, blank), config, at).count() == 0


def test_window_edges(spark):
    config = BY_ID[BURST]
    rows = auth_rows(spark, [fail(0)] * 5)
    assert D.detect(rows, config, NOW + timedelta(minutes=5)).count() == 0
    assert D.detect(rows, config, NOW + timedelta(minutes=5) - timedelta(milliseconds=1)).count() == 1
    # No upper bound: future events count.
    assert D.detect(rows, config, NOW - timedelta(days=1)).count() == 1


@pytest.mark.parametrize(
    "statuses, fires",
    [
        ("fffs", True), ("ffs", False), ("sfffs", False), ("fffsf", False), ("fff", False), ("fffss", True),
    ],
)
def test_failed_then_success(spark, statuses, fires):
    rows = [fail(i, status={"f": "failure", "s": "success"}[x]) for i, x in enumerate(statuses)]
    found = D.detect(auth_rows(spark, rows), BY_ID[SEQUENCE], NOW + timedelta(minutes=1)).collect()
    assert bool(found) == fires
    if fires:
        details = json.loads(found[0].details)
        assert details["first_failure"] == "2026-04-09 08:33:37.000"
        assert details["first_success"] == "2026-04-09 08:33:40.000"


def test_same_second_sequence_fires(spark):
    rows = [fail(0), fail(0), fail(0), fail(0, status="success")]
    assert D.detect(auth_rows(spark, rows), BY_ID[SEQUENCE], NOW + timedelta(minutes=1)).count() == 1


def test_sample_is_five_smallest(spark):
    rows = [fail(i, user=f"u{i:03d}") for i in reversed(range(600))]
    row = D.detect(auth_rows(spark, rows), BY_ID[SPRAY], NOW + timedelta(minutes=10, seconds=-1)).first()
    assert row.distinct_user_count == 600
    assert json.loads(row.details)["sampled_users"] == "u000, u001, u002, u003, u004"


def test_top_group_and_ties(spark):
    rows = [fail(i, user=u) for u in ("b", "a", "c") for i in range(5)] + [fail(9, user="c")]
    auth, at, config = auth_rows(spark, rows), NOW + timedelta(minutes=1), BY_ID[BURST]
    assert [r.principal for r in D.detect(auth, config, at, top_n=1).collect()] == ["c"]
    assert [r.principal for r in D.detect(auth, config, at, top_n=2).collect()] == ["c", "a"]
    assert D.detect(auth, config, at).count() == 3


def test_quotes_stay_valid_json(spark):
    rows = [fail(i, user='a"b') for i in range(5)]
    row = D.detect(auth_rows(spark, rows), BY_ID[BURST], NOW + timedelta(minutes=1)).first()
    assert json.loads(row.details)["principal"] == 'a"b'


def test_suppression(spark):
    rows = [fail(i, user="Svc", host="H1") for i in range(5)] + [fail(i, user="x") for i in range(5)]
    at = NOW + timedelta(minutes=1)

    def principals(**more):
        found = D.detect(auth_rows(spark, rows), BY_ID[BURST].with_(**more), at)
        return sorted(r.principal for r in found.collect())

    assert principals() == ["Svc", "x"]
    assert principals(suppression_users=("svc",)) == ["x"]
    assert principals(suppression_computers=("h1",)) == ["x"]
    assert principals(suppression_users=("svc",), suppress_by_user=False) == ["Svc", "x"]
    assert principals(suppression_computers=("10.0.0.9",), suppression_computer_by="source_ip") == ["Svc", "x"]
    kind = dict(suppression_computers=("linux_ssh",), suppression_computer_by="source_kind")
    assert principals(**kind) == []
    assert RU.suppression_list(" A, b ,,a") == ["a", "b"]


def test_suppression_expressions():
    def read(**more):
        return RuleConfig.from_mapping({"id": "r", "name": "R", **more})

    config = read(suppression_computer_expr="lowerUTF8( source_kind )", suppression_user_expr="''")
    assert (config.suppression_computer_by, config.suppress_by_user) == ("source_kind", False)
    assert read().suppression_computer_by == "endpoint_id" and read().suppression_user_by == "principal"
    configs, skipped = RU.load_rules([{"id": "r", "name": "R", "suppression_user_expr": "lowerUTF8(fields['x'])"}])
    assert configs == [] and skipped == [("r", "suppression_user_expr is not a result column in lower case")]


@pytest.mark.parametrize(
    "op, fires", [("gt", False), ("gte", True), ("eq", True), ("lt", False), ("lte", True), ("x", False)]
)
def test_threshold_ops(spark, op, fires):
    config = BY_ID[BURST].with_(threshold_op=op)
    found = D.detect(auth_rows(spark, [fail(i) for i in range(5)]), config, NOW + timedelta(minutes=1))
    assert bool(found.count()) == fires


def test_config_defaults_and_skips():
    config = RuleConfig.from_mapping({"id": "r", "name": "R", "threshold_value": "7"})
    assert (config.severity, config.threshold_op, config.window_minutes, config.cooldown_seconds) == (
        "medium", "gte", 5, 0,
    )
    assert config.alert_type == "r" and config.threshold_failures == config.threshold_attempts == 7
    with pytest.raises(RuleConfigError):
        RuleConfig.from_mapping({"id": "r", "name": "R", "window_minutes": "-5"})
    configs, skipped = RU.load_rules(
        [{"id": "a", "name": "A"}, {"id": "a", "name": "B"}, {"id": "b"}, {"name": "C"},
         {"id": "d", "name": "D", "threshold_value": "x"}]
    )
    assert [(c.id, c.name) for c in configs] == [("a", "A")]
    assert [s[0] for s in skipped] == ["b", "", "d"]


def test_rules_that_cannot_run(spark):
    with pytest.raises(RuleConfigError):
        RuleConfig(id="r", name="R", window_minutes=0)
    auth = auth_rows(spark, [fail(i) for i in range(5)])
    at = NOW + timedelta(minutes=1)
    stray = RuleConfig(id="no_such_rule", name="Stray")
    nothing = P.run_pack(auth, [stray], at)
    assert nothing.count() == 0 and nothing.columns == ALERTS.names
    assert [a.rule_id for a in P.run_pack(auth, [stray, BY_ID[BURST]], at).collect()] == [BURST]


def test_registry(spark):
    rules = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    metadata = spark.createDataFrame([("a", " FALSE "), ("b", "yes"), ("z", "0")], "id string, enabled string")
    assert sorted(r.id for r in RU.enabled_rules(rules, metadata).collect()) == ["b", "c"]
    assert RU.enabled_rules(rules, None).count() == 3
    resolved, missing = RU.resolve_rules(rules, spark.createDataFrame([("b", 1)], "id string, w int"))
    assert [r.id for r in resolved.collect()] == ["b"]
    assert sorted(r.id for r in missing.collect()) == ["a", "c"]
    assert [c.id for c in RU.enabled_configs(RULE_PACK, {BURST: "No"})] == [SEQUENCE, SPRAY, DISTRIBUTED, WINDOWS]


def test_cooldown(spark):
    auth = scenario_auth(spark, "password-spray")
    first = P.run_pack(auth, RULE_PACK, NOW + timedelta(seconds=30))

    def again(after, **more):
        configs = [c.with_(**more) for c in RULE_PACK]
        return P.run_pack(auth, configs, NOW + timedelta(seconds=after), first, dedup="cooldown").count()

    assert again(60) == 0
    assert again(60, cooldown_seconds=0) == 1
    # 300 s after the alert at 30 s the cooldown is over.
    assert again(330) == 1 and again(329) == 0


def test_top_group_masks_until_all_groups_are_asked(spark):
    rows = [fail(i, user="big") for i in range(9)] + [fail(i, user="small") for i in range(5)]
    auth, at = auth_rows(spark, rows), NOW + timedelta(minutes=1)
    first = P.run_pack(auth, [BY_ID[BURST]], at, P.empty_alerts(spark))
    assert [a.entity_user for a in first.collect()] == ["big"]
    assert P.run_pack(auth, [BY_ID[BURST]], at, first).count() == 0
    assert [a.entity_user for a in P.run_pack(auth, [BY_ID[BURST]], at, first, top_n=None).collect()] == ["small"]


def test_multi_window_facts_equal_single(spark):
    rows = [fail(60 * i, user=f"u{i % 4}", ip=f"1.1.1.{i % 3}", status="success" if i % 7 == 6 else "failure")
            for i in range(40)]
    auth, at = auth_rows(spark, rows), NOW + timedelta(minutes=40)
    configs = [c.with_(threshold_value=1, threshold_attempts=1, threshold_distinct_users=1,
                       threshold_distinct_ips=1, threshold_failures=1) for c in RULE_PACK]
    shared = D.login_facts(auth, at, [c.window_minutes for c in configs])
    for c in configs:
        alone = D.detect(auth, c, at).collect()
        together = D.evaluate(shared, c).select(*RULE_RESULT.names).collect()
        assert sorted(alone) == sorted(together), c.id


def test_replay_keeps_first_snapshot(spark):
    rows = [fail(30 * i) for i in range(12)]
    auth = auth_rows(spark, rows)
    config = BY_ID[BURST]
    alerts = P.replay(auth, [config], 30, NOW, NOW + timedelta(minutes=20)).orderBy("ts").collect()
    # One alert per bucket of the window end; the count is that of the first tick that qualified.
    assert [a.window_bucket.minute for a in alerts] == [35]
    brute = []
    tick = datetime(2026, 4, 9, 8, 34)
    seen = set()
    while tick <= NOW + timedelta(minutes=20):
        past = auth.filter(F.col("ts") <= F.lit(tick))
        for r in D.detect(past, config, tick, top_n=1).collect():
            if r.window_bucket not in seen:
                seen.add(r.window_bucket)
                brute.append((tick, r.hits))
        tick += timedelta(seconds=30)
    assert [(a.ts, a.hits) for a in alerts] == brute


def test_sql_rule(spark):
    auth = auth_rows(spark, [fail(i, host="h1") for i in range(3)] + [fail(i, host="h2") for i in range(4)])
    sql = """SELECT count(*) hits, '' principal, '' source_ip, host endpoint_id, min(ts) window_start,
      max(ts) window_end, 0 distinct_user_count, 0 distinct_ip_count, 'linux_ssh' source_kind,
      'it''s {x}' reason, '' evidence_summary, '' details, max(ts) window_bucket
      FROM {auth_events} WHERE ts > :as_of - make_dt_interval(0, 0, :window_minutes)
      GROUP BY host HAVING count(*) >= :threshold_attempts;""".replace("{x}", "fine")
    config = RuleConfig(id="own", name="Own's", threshold_value=3, suppression_computers=("h2",))
    at = NOW + timedelta(minutes=1)
    alerts = P.run_pack(auth, [], at, sql_rules=[P.SqlRule(config, sql)]).collect()
    assert [(a.endpoint_id, a.hits, a.rule_name, a.reason) for a in alerts] == [("h1", 3, "Own's", "it's fine")]
    assert alerts[0].details == "Triggered by authlane detection service"
    for same in (at.replace(tzinfo=timezone.utc), at.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=2))), as_of_col(at)):
        rows = P.run_pack(auth, [], same, sql_rules=[P.SqlRule(config, sql)]).collect()
        assert [(a.endpoint_id, a.hits, a.ts) for a in rows] == [(a.endpoint_id, a.hits, a.ts) for a in alerts]
    with pytest.raises(ValueError, match="does not return"):
        P.run_pack(auth, [], at, sql_rules=[P.SqlRule(config, "SELECT 1 AS hits FROM {auth_events}")])


# Views.


def events(spark, rows):
    return spark.createDataFrame([(NOW, "e", "p", "v", lane, m, f) for lane, m, f in rows], EVENTS)


@pytest.mark.parametrize(
    "lane, message, fields, expected",
    [
        ("vector-syslog", "sshd[1]: Failed password for invalid user bob from 10.0.0.1 port 2", {"hostname": "h"},
         ("login", "bob", "10.0.0.1", "h", "failure", "linux_ssh", "password")),
        ("vector-syslog", "ACCEPTED PUBLICKEY for amy from fe80::1", {},
         ("login", "amy", "fe80::1", "", "success", "", "publickey")),
        ("vector-windows-endpoint", "x", {"event_type": "auth.login", "status": "SUCCESSFUL", "computer": "c"},
         ("auth.login", "", "", "c", "success", "windows_auth", "")),
        ("x", "Failed password from database", {"status": "Locked", "host": "h", "computer": "c"},
         ("login", "", "da", "h", "Locked", "", "password")),
    ],
)
def test_auth_view(spark, lane, message, fields, expected):
    row = auth_events(events(spark, [(lane, message, fields)])).first()
    assert (row.event_type, row.user, row.src_ip, row.host, row.status, row.source_kind, row.auth_method) == expected


def test_auth_view_filters(spark):
    rows = [("x", "heartbeat", {}), ("x", "Failed password", {"event_type": "logout"})]
    assert auth_events(events(spark, rows)).count() == 0


def test_endpoint_activity(spark):
    rows = [("l", "m", {"host": "a", "computer": "c"}), ("l", "m", {"host": "a", "hostname": "n"}), ("l", "m", {})]
    df = events(spark, rows)
    assert sorted(r.endpoint_id for r in endpoint_activity(df, NOW).collect()) == ["c", "n"]
    for minutes, status in ((-3, "active"), (15, "active"), (16, "idle"), (60, "idle"), (61, "stale")):
        assert endpoint_activity(df, NOW + timedelta(minutes=minutes)).first().status == status


def test_recent_detections_blanks(spark):
    blank = spark.createDataFrame([()], "struct<>").select(
        *[F.lit("" if f.dataType.simpleString() == "string" else None).cast(f.dataType).alias(f.name) for f in ALERTS]
    ).withColumn("rule_id", F.lit("r"))
    row = recent_login_detections(blank).first()
    assert (row.alert_type, row.alert_fingerprint, row.entity_user, row.source_kind, row.workflow_state) == (
        "r", "n/a", "n/a", "n/a", "new",
    )


def test_replay_leaves_out_stray_configs(spark):
    stray = RuleConfig(id="own", name="Own")
    auth = auth_rows(spark, [fail(i) for i in range(3)])
    assert P.replay(auth, [stray], 60, NOW, NOW + timedelta(minutes=2)).count() == 0
