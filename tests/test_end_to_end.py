"""Scenario files through bus, tables, detection, alert conditions and outbox."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from authlane.operators import alerting as A
from authlane.operators import normalize as N
from authlane.operators import presentation as C
from authlane.operators import reports as R
from authlane.operators.rules import RULE_PACK
from authlane.operators.views import auth_events, endpoint_activity, recent_login_detections
from authlane.sources import readers as SR
from authlane.streaming import detect as SD
from authlane.streaming import ingest as SI

NOW = datetime(2026, 4, 9, 8, 33, 37)


def test_scenarios_end_to_end(spark, tmp_path):
    names = {"raw": "raw", "bus": "bus", "events": "events", "bad": "bad", "alerts": "alerts"}
    at = {k: str(tmp_path / v) for k, v in names.items()}
    (tmp_path / "raw").mkdir()
    spray = [
        {"platform": "linux", "user": u, "src_ip": "198.51.100.25", "host": "web-01", "status": "FAILURE",
         "message": f"sshd[12]: Failed password for invalid user {u} from 198.51.100.25 port 5 ssh2",
         "scenario": "password-spray"}
        for u in ("admin", "backup", "deploy", "root")
    ]
    (tmp_path / "raw" / "spray.jsonl").write_text("\n".join(json.dumps(r) for r in spray) + "\n\n")

    # Replay the scenario at NOW, normalize it as a stream and publish it to a file bus.
    stamped = SR.stamp_scenario(SR.scenario_lines(spark, at["raw"], stream=True), "password-spray", NOW)
    envelopes = N.normalize_synthetic_auth(N.decode_records(stamped), NOW)
    assert SI.publish_json(
        N.lane_fan_in(envelopes), at["bus"], str(tmp_path / "c1")
    ).awaitTermination(120)

    # The writer: bus to events table.
    query = SI.ingest_envelopes(
        SR.text_lines(spark, at["bus"], stream=True), at["events"], at["bad"], str(tmp_path / "c2")
    )
    assert query.awaitTermination(120)
    events = SR.scan_events(spark, at["events"])
    assert R.event_growth(events.limit(0), events).first().grew
    assert [tuple(r) for r in R.scenario_summary(events, NOW, 60).collect()] == [
        ("password-spray", "failure", 4)
    ]

    # Two polls: one alert, and no duplicate.
    for batch_id, seconds in enumerate((30, 60)):
        SD.detection_pass(
            spark, at["events"], at["alerts"], RULE_PACK, NOW + timedelta(seconds=seconds), batch_id
        )
    alerts = SD.recorded_alerts(spark, at["alerts"])
    later = NOW + timedelta(minutes=2)
    totals = R.alert_totals(alerts, later, 60).collect()
    assert [(t.alert_type, t.alerts, t.unique_fingerprints) for t in totals] == [("password_spray", 1, 1)]

    # What the operator sees.
    fired = [c.rule_id for c in A.alert_conditions(alerts, later).collect() if c.firing]
    assert fired == ["security_source_multi_user_burst"]
    assert [r.state for r in A.alert_transitions(alerts).orderBy("tick").collect()] == ["firing", "resolved"]
    assert A.notification_groups(alerts).first().alerts == 1
    card = C.alert_cards(alerts).first()
    assert card.title == "Password Spray Detected" and card.src_ip == "198.51.100.25"
    assert card.sentence.startswith("n/a saw 4 failed attempts from 198.51.100.25 in 1 seconds.")
    recent = R.recent_detections(recent_login_detections(alerts), later, 60).first()
    assert recent.entity_user == "n/a" and recent.attempt_count == 4
    auth = auth_events(events)
    assert R.health(auth, later).first().last_event_ts == "2026-04-09 08:33:37"
    assert R.spray_sources(auth).first().targeted_users == 4
    assert R.endpoint_report(endpoint_activity(events, later)).first().status == "active"
