"""Sliding detection from changes, and continuous detection from the pane store, equal the replay of all ticks."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import wire

from authlane.operators import detections as D
from authlane.operators import envelope as E
from authlane.operators import pack as P
from authlane.operators import panes as N
from authlane.operators import sliding as S
from authlane.operators.intervals import points_in_intervals
from authlane.operators.rules import RULE_PACK
from authlane.operators.views import auth_events
from authlane.sources import readers as SR
from authlane.streaming import panes as SP

BASE = datetime(2026, 4, 9, 8, 0)
LOW = {"threshold_value": 2, "threshold_attempts": 3, "threshold_distinct_users": 2, "threshold_distinct_ips": 2, "threshold_failures": 2}
CONFIGS = [c.with_(window_minutes=w, **LOW) for c, w in zip(RULE_PACK, (3, 4, 5, 3, 6))]


def login(n, at, user, src, host, status="failure", windows=False):
    line = json.loads(
        wire(n, ts=at.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3], user=user, status=status,
             lane="vector-windows-endpoint" if windows else "synthetic-auth")
    )
    line["fields"] |= {"src_ip": src, "host": host, "source_kind": "windows_auth" if windows else "linux_ssh", "logon_type": str(n % 3)}
    return json.dumps(line)


def some_logins(n, seed):
    draw = random.Random(seed)
    lines = []
    for i in range(n):
        at = BASE + timedelta(milliseconds=draw.randrange(0, 30 * 60_000))
        if i % 9 == 0:  # on the edge of a pane
            at = at.replace(second=draw.choice([0, 10, 30]), microsecond=0)
        user, src = draw.choice(["a", "b", "c", "d", ""]), draw.choice(["1.1.1.1", "2.2.2.2", "3.3.3.3", ""])
        lines.append(login(i, at, user, src, draw.choice(["h1", "h2", ""]), draw.choice(["failure"] * 3 + ["success"]), draw.random() < 0.3))
    # A success after failures, which chance does not bring.
    for i, status in enumerate(["failure", "failure", "failure", "success"]):
        lines.append(login(n + i, BASE + timedelta(minutes=12, seconds=20 * i), "seq", "4.4.4.4", "h3", status))
    return lines


def auth_of(spark, folder, stream=False, **options):
    lines = spark.readStream.options(**options).text(folder) if stream else SR.text_lines(spark, folder)
    return auth_events(E.accepted(E.decode_envelopes(lines)).withColumn("event_id", F.lit("x")))


def rows(alerts, *drop):
    names = [c for c in alerts.columns if c not in drop and c in P.ALERTS.names]
    return sorted(tuple(str(r[c]) for c in names) for r in alerts.select(*names).collect())


@pytest.fixture(scope="module")
def logins(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("logins")
    (folder / "a.txt").write_text("\n".join(some_logins(400, 7)) + "\n")
    return auth_of(spark, str(folder)).persist()


@pytest.mark.parametrize("slide", [10, 420])
@pytest.mark.parametrize("top_n", [None, 1])
@pytest.mark.parametrize("config", CONFIGS, ids=lambda c: c.id)
def test_changes_equal_all_ticks(logins, config, slide, top_n):
    """Also slides longer than the window, and ticks that begin and end inside the events."""
    ticks = N.Ticks.between([config.window_minutes], slide, BASE + timedelta(minutes=4), BASE + timedelta(minutes=27))
    panes = N.login_panes(logins, ticks.unit)
    facts = N.tick_facts(panes, [config.window_minutes], ticks)
    all_ticks = P.candidates(facts, [config], top_n, per_tick=True)
    changes = P.alert_rows(S.slide(panes, config, ticks, top_n), config, config.parameter_text)
    expected = rows(P.first_per_fingerprint(all_ticks))
    assert rows(P.first_per_fingerprint(changes)) == expected
    assert expected or slide == 420


def test_member_rows_are_not_copied_to_ticks(spark, logins):
    """The only rows made are two changes a pane, bins of the sample join, and reported ticks."""
    spray = CONFIGS[2]
    ticks = N.Ticks.between([spray.window_minutes], 10, BASE, BASE + timedelta(minutes=30))
    found = S.slide(N.login_panes(logins, ticks.unit), spray, ticks)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text and "CartesianProduct" not in text
    assert not [line for line in text.split("\n") if "Generate explode(sequence(enters" in line]


def test_points_meet_the_intervals_that_hold_them(spark):
    draw = random.Random(3)
    points = [(draw.choice("ab"), draw.randrange(-50, 400), i) for i in range(200)] + [(None, 5, 900), ("a", None, 901)]
    spans = [(draw.choice("ab"), s := draw.randrange(-60, 380), s + draw.choice([0, 1, 7, 30, 200]), i) for i in range(150)]
    p = spark.createDataFrame(points, "k string, at long, p long")
    i = spark.createDataFrame(spans + [("a", None, 4, 902)], "k string, s long, e long, i long")
    for width in (1, 13, 1000):
        found = points_in_intervals(p, i, ["k"], "at", "s", "e", width)
        expected = sorted((pid, iid) for k, at, pid in points for j, s, e, iid in spans if k == j and at is not None and s <= at < e)
        assert sorted((r.p, r.i) for r in found.collect()) == expected


def test_streamed_rules_equal_replay_over_a_restart(spark, tmp_path):
    folder = tmp_path / "bus"
    folder.mkdir()
    lines = sorted(some_logins(150, 11), key=lambda s: json.loads(s)["ts"])
    # Four files in order of time, but events of up to a minute later come one file early.
    files = [lines[i * 40 : i * 40 + 40] for i in range(4)]
    for a, b in zip(files, files[1:]):
        a[-3:], b[:3] = b[:3], a[-3:]
    delay = 15 * 60
    store = SP.PaneStore(spark, str(tmp_path / "store"), 10)
    alerts, checkpoint = str(tmp_path / "alerts"), str(tmp_path / "ck")

    def run():
        auth = auth_of(spark, str(folder), True, maxFilesPerTrigger=1)
        query = SP.detect_sliding(auth, store, alerts, CONFIGS, 30, checkpoint, delay)
        query.awaitTermination(300)
        assert query.exception() is None

    for i, part in enumerate(files):
        (folder / f"{i}.txt").write_text("\n".join(part) + "\n")
        if i in (1, 3):  # two files, a stop, and the other two
            run()
    # An event that moves the time on, so that all ticks are evaluated.
    end = BASE + timedelta(minutes=30)
    (folder / "end.txt").write_text(login(999, end + timedelta(seconds=delay), "z", "9.9.9.9", "h9") + "\n")
    run()
    first = min(json.loads(s)["ts"] for s in lines)
    replayed = P.replay(auth_of(spark, str(folder)), CONFIGS, 30, datetime.fromisoformat(first), end, top_n=None)
    streamed = SR.scan_alerts(spark, alerts)
    assert rows(streamed) == rows(replayed)
    assert {r.rule_id for r in streamed.collect()} == {c.id for c in CONFIGS}


def test_a_late_event_corrects_its_pane(spark, tmp_path):
    folder = tmp_path / "bus"
    folder.mkdir()
    burst = RULE_PACK[0].with_(window_minutes=5, threshold_value=3)
    store = SP.PaneStore(spark, str(tmp_path / "store"), 10)
    alerts, checkpoint = str(tmp_path / "alerts"), str(tmp_path / "ck")
    two = [login(i, BASE + timedelta(seconds=20 * i), "a", "1.1.1.1", "h1") for i in range(2)]
    later = [login(9, BASE + timedelta(minutes=40), "b", "1.1.1.1", "h1")]
    late = [login(5, BASE + timedelta(seconds=30), "a", "1.1.1.1", "h1")]
    for i, (part, expected) in enumerate([(two, 0), (later, 0), (late, 1)]):
        (folder / f"{i}.txt").write_text("\n".join(part) + "\n")
        query = SP.detect_sliding(auth_of(spark, str(folder), True), store, alerts, [burst], 30, checkpoint)
        query.awaitTermination(200)
        assert query.exception() is None
        assert SR.scan_alerts(spark, alerts).count() == expected if expected else True
    found = SR.scan_alerts(spark, alerts).collect()
    assert [(r.hits, r.ts, r.window_start) for r in found] == [(3, BASE + timedelta(seconds=30), BASE)]


def test_a_pass_over_panes_reads_panes_only_and_equals_one_over_events(spark, tmp_path, logins):
    as_of = BASE + timedelta(minutes=20)
    store = SP.PaneStore(spark, str(tmp_path / "store"), 10)
    share = F.pmod(F.xxhash64("ts", "user"), F.lit(2))
    for i in range(2):
        store.add(logins.filter(share == i), i)
        store.add(logins.filter(share == i), i)  # again: replaced
    facts = N.pane_facts(SP.store_panes_at(store, CONFIGS, as_of), [c.window_minutes for c in CONFIGS], as_of, store.unit)
    assert facts.inputFiles() and all("/panes-10s/" in f for f in facts.inputFiles())
    alerts = str(tmp_path / "alerts")
    SP.pass_over_panes(store, alerts, CONFIGS, as_of, 0, top_n=None)
    expected = P.run_pack(logins, CONFIGS, as_of, top_n=None)
    assert rows(SR.scan_alerts(spark, alerts)) == rows(expected) and expected.count() > 5
    with pytest.raises(ValueError, match="multiple"):
        SP.pass_over_panes(store, alerts, CONFIGS, as_of + timedelta(seconds=3), 1)
