"""Registered queries: views, detections and the rule pack."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane.functions.times import to_micros
from authlane.operators import detections as D
from authlane.operators import pack as P
from authlane.operators import rules as R
from authlane.operators import views as V
from authlane.operators.panes import login_panes, merged_panes, pane_facts
from authlane.plans import bindings as B
from authlane.plans import oracle as O
from authlane.plans.registry import query

CONFIGS = {c.id: c for c in B.month_pack()}
BURST, SEQUENCE, SPRAY, DISTRIBUTED, WINDOWS = (
    "security_failed_login_burst", "security_failed_then_success",
    "security_source_multi_user_burst", "security_user_multi_source_burst",
    "windows_failed_logon_burst",
)


@query("auth_events", O.AUTH_SQL + "SELECT * FROM auth")
def q_auth_events(spark: SparkSession, sf: str) -> DataFrame:
    return B.bound_auth(spark, sf)


@query("endpoint_activity", O.with_(O.SRC, O.ENV, O.ACTIVITY) + "SELECT * FROM activity")
def q_endpoint_activity(spark: SparkSession, sf: str) -> DataFrame:
    return V.endpoint_activity(B.bound_events(spark, sf), B.AS_OF)


@query("recent_login_detections", O.DETECTIONS_SQL + "SELECT * FROM detections")
def q_recent_login_detections(spark: SparkSession, sf: str) -> DataFrame:
    return V.recent_login_detections(B.bound_alerts(spark, sf))


def _month_rule(rule_id: str, more: str = "") -> str:
    return (
        O.with_(O.SRC, O.ENV, O.AUTH, O.MONTH_RANGE)
        + f"SELECT {O.RESULT} FROM ({O.rule_sql(CONFIGS[rule_id], more)})"
    )


def _register_rule(name: str, rule_id: str) -> None:
    @query(name, _month_rule(rule_id))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return D.detect(B.bound_auth(spark, sf, B.MONTH), CONFIGS[rule_id], B.AS_OF)

    @query(
        f"{name}_top1",
        _month_rule(rule_id) + f" ORDER BY {O.rank_sql(rule_id)} LIMIT 1",
    )
    def run_top(spark: SparkSession, sf: str) -> DataFrame:
        return D.detect(B.bound_auth(spark, sf, B.MONTH), CONFIGS[rule_id], B.AS_OF, top_n=1)


for _name, _rule_id in (
    ("rule_failed_login_burst", BURST),
    ("rule_failed_then_success", SEQUENCE),
    ("rule_password_spray", SPRAY),
    ("rule_distributed_attack", DISTRIBUTED),
    ("rule_windows_failed_logon_burst", WINDOWS),
):
    _register_rule(_name, _rule_id)


def _pack_sql(configs: list[R.RuleConfig], top_n: int | None) -> str:
    return O.with_(O.SRC, O.ENV, O.AUTH, O.MONTH_RANGE, O.alerts_block(configs, top_n))


@query("rule_pack_top1", _pack_sql(B.month_pack(), 1) + "SELECT * FROM alerts")
def q_pack_top1(spark: SparkSession, sf: str) -> DataFrame:
    return P.run_pack(B.bound_auth(spark, sf, B.MONTH), B.month_pack(), B.AS_OF, top_n=1)


@query("rule_pack_all_groups", _pack_sql(B.month_pack(), None) + "SELECT * FROM alerts")
def q_pack_all(spark: SparkSession, sf: str) -> DataFrame:
    return P.run_pack(B.bound_auth(spark, sf, B.MONTH), B.month_pack(), B.AS_OF, top_n=None)


@query("rule_pack_from_panes", _pack_sql(B.month_pack(), None) + "SELECT * FROM alerts")
def q_pack_panes(spark: SparkSession, sf: str) -> DataFrame:
    """The pack at an instant from panes of ten minutes that three writers combined apart."""
    auth = B.bound_auth(spark, sf, B.MONTH)
    share = F.pmod(F.xxhash64("event_id"), F.lit(3))
    unit = 600 * 1_000_000
    parts = [login_panes(auth.filter(share == i), unit) for i in range(3)]
    panes = merged_panes(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    low = (to_micros(B.AS_OF) - B.MONTH * 60_000_000) // unit
    facts = pane_facts(panes.filter(F.col("pane") > low), [c.window_minutes for c in B.month_pack()], B.AS_OF, unit)
    return P.first_per_fingerprint(P.candidates(facts, B.month_pack(), None))


# Two rules off, one by "No " and one by "0"; a rule without metadata stays on.
_METADATA = {SPRAY: "No ", BURST: "0", WINDOWS: "true"}
_ENABLED = [c for c in B.month_pack() if c.id not in (SPRAY, BURST)]


@query(
    "rule_pack_enabled_only",
    _pack_sql(_ENABLED, None)
    + "SELECT rule_id, CAST(count(*) AS BIGINT) AS alerts FROM alerts GROUP BY rule_id",
)
def q_enabled(spark: SparkSession, sf: str) -> DataFrame:
    configs = R.enabled_configs(B.month_pack(), _METADATA)
    alerts = P.run_pack(B.bound_auth(spark, sf), configs, B.AS_OF, top_n=None)
    return alerts.groupBy("rule_id").agg(F.count("*").alias("alerts"))


@query(
    "rule_registry_hits",
    _pack_sql(B.month_pack(), None)
    + f"""SELECT rule_id, CAST(count(*) AS BIGINT) AS alerts, max(hits) AS top_hits
FROM alerts WHERE rule_id NOT IN ('{SPRAY}', '{BURST}') GROUP BY rule_id""",
)
def q_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of the rules a registry table leaves enabled."""
    alerts = P.run_pack(B.bound_auth(spark, sf, B.MONTH), B.month_pack(), B.AS_OF, top_n=None)
    rules = spark.createDataFrame([(c,) for c in CONFIGS], "id string")
    metadata = spark.createDataFrame(list(_METADATA.items()), "id string, enabled string")
    enabled = R.enabled_rules(rules, metadata).select(F.col("id").alias("rule_id"))
    # One row per configured rule, made on the driver above: small whatever the tables hold.
    return (
        alerts.join(F.broadcast(enabled), "rule_id", "left_semi")
        .groupBy("rule_id")
        .agg(F.count("*").alias("alerts"), F.max("hits").alias("top_hits"))
    )


_SUPPRESSED = R.RuleConfig.from_mapping(
    {
        "id": DISTRIBUTED, "name": "Distributed Attack", "alert_type": "distributed_attack",
        "severity": "high", "threshold_value": "4", "threshold_attempts": "4",
        "threshold_distinct_ips": "3", "window_minutes": str(B.MONTH),
        "suppression_computers_csv": " HOST-1, ,host-3,host-1", "suppression_users_csv": "User-2,user-7",
        "suppression_user_expr": "lowerUTF8(principal)",
    }
)


@query(
    "suppression",
    _month_rule(
        DISTRIBUTED,
        "lower(host) NOT IN ('host-1', 'host-3') AND lower(\"user\") NOT IN ('user-2', 'user-7')",
    ),
)
def q_suppression(spark: SparkSession, sf: str) -> DataFrame:
    return D.detect(B.bound_auth(spark, sf), _SUPPRESSED, B.AS_OF)


_OTHER_COLUMNS = R.RuleConfig.from_mapping(
    {
        "id": DISTRIBUTED, "name": "Distributed Attack", "alert_type": "distributed_attack",
        "severity": "high", "threshold_value": "4", "threshold_attempts": "4",
        "threshold_distinct_ips": "3", "window_minutes": str(B.MONTH),
        "suppression_computers_csv": "10.0.0.3", "suppression_computer_expr": "lowerUTF8(source_ip)",
        "suppression_users_csv": "host-1", "suppression_user_expr": "lowerUTF8(endpoint_id)",
    }
)


@query(
    "suppression_by_column",
    _month_rule(DISTRIBUTED, "lower(src_ip) <> '10.0.0.3' AND lower(host) <> 'host-1'"),
)
def q_suppression_column(spark: SparkSession, sf: str) -> DataFrame:
    """A rule whose lists are compared with other columns than host and user."""
    return D.detect(B.bound_auth(spark, sf), _OTHER_COLUMNS, B.AS_OF)


_LISTED = """listed AS (
  SELECT DISTINCT lower("user") AS entry FROM auth WHERE auth_method = 'publickey')"""


@query(
    "suppression_by_table",
    O.with_(O.SRC, O.ENV, O.AUTH, _LISTED)
    + """SELECT "user", status, CAST(count(*) AS BIGINT) AS logins FROM auth
WHERE lower("user") NOT IN (SELECT entry FROM listed) GROUP BY ALL""",
)
def q_suppression_table(spark: SparkSession, sf: str) -> DataFrame:
    """Logins of accounts that never logged in with a key: the list is as large as the table."""
    auth = B.bound_auth(spark, sf)
    entries = auth.filter(F.col("auth_method") == "publickey").select(F.upper("user")).distinct()
    kept = R.suppress_listed(auth, "user", entries)
    return kept.groupBy("user", "status").agg(F.count("*").alias("logins"))


_GROUPS = 'SELECT "user", CAST(count(*) AS BIGINT) AS hits FROM auth GROUP BY "user"'


@query(
    "threshold_ops",
    O.AUTH_SQL
    + f"""SELECT op, "user", hits FROM ({_GROUPS}) CROSS JOIN
  (SELECT unnest(['gt', 'gte', 'eq', 'lt', 'lte', 'between']) AS op)
WHERE CASE op WHEN 'gt' THEN hits > 40 WHEN 'gte' THEN hits >= 40 WHEN 'eq' THEN hits = 40
              WHEN 'lt' THEN hits < 40 WHEN 'lte' THEN hits <= 40 ELSE false END""",
)
def q_threshold_ops(spark: SparkSession, sf: str) -> DataFrame:
    groups = B.bound_auth(spark, sf).groupBy("user").agg(F.count("*").alias("hits"))
    fired = F.array_compact(
        F.array(
            *[
                F.when(R.meets_threshold(F.col("hits"), op, 40), F.lit(op))
                for op in (*R.THRESHOLD_OPS, "between")
            ]
        )
    )
    return groups.select(F.explode(fired).alias("op"), "user", "hits")


@query(
    "alert_fingerprints",
    O.ALERTS_SQL + "SELECT alert_type, alert_fingerprint, window_bucket FROM alerts",
)
def q_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return B.bound_alerts(spark, sf).select("alert_type", "alert_fingerprint", "window_bucket")


@query("alert_history", O.ALERTS_SQL + "SELECT * FROM alerts")
def q_history(spark: SparkSession, sf: str) -> DataFrame:
    return B.bound_alerts(spark, sf)


def _replay_until(spark: SparkSession, sf: str, end: datetime) -> DataFrame:
    return P.replay(
        B.bound_auth(spark, sf), B.history_pack(), B.HISTORY_SLIDE_SECONDS, B.START, end, top_n=None
    )


_ALL_TICKS = O.ALERTS_SQL.replace(
    "QUALIFY row_number() OVER (PARTITION BY alert_fingerprint ORDER BY ts, rule_id) = 1", ""
)


@query(
    "alert_dedup_ever",
    _ALL_TICKS.rstrip()
    + f""",
recorded AS (SELECT DISTINCT alert_fingerprint FROM alerts WHERE ts <= TIMESTAMP '2024-01-29')
SELECT rule_id, alert_fingerprint, hits, ts FROM alerts a WHERE ts = {O.AS_OF}
AND NOT EXISTS (SELECT 1 FROM recorded r WHERE r.alert_fingerprint = a.alert_fingerprint)""",
)
def q_dedup_ever(spark: SparkSession, sf: str) -> DataFrame:
    """A pass at AS_OF against everything recorded up to two days before."""
    recorded = _replay_until(spark, sf, B.AS_OF - timedelta(days=2))
    return P.run_pack(
        B.bound_auth(spark, sf), B.history_pack(), B.AS_OF, recorded, top_n=None
    ).select("rule_id", "alert_fingerprint", "hits", "ts")


@query(
    "alert_dedup_cooldown",
    _ALL_TICKS.rstrip()
    + f""",
recorded AS (
  SELECT alert_fingerprint, min(ts) AS ts FROM alerts WHERE ts <= TIMESTAMP '2024-01-29' GROUP BY 1)
SELECT rule_id, alert_fingerprint, hits, ts FROM alerts a WHERE ts = {O.AS_OF}
AND NOT EXISTS (SELECT 1 FROM recorded r WHERE r.alert_fingerprint = a.alert_fingerprint
  AND a.rule_id <> '{SPRAY}' AND r.ts > {O.AS_OF} - INTERVAL 4 DAY)""",
)
def q_dedup_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    """The same pass under a four-day cooldown, which the spray rule does not have."""
    recorded = _replay_until(spark, sf, B.AS_OF - timedelta(days=2))
    configs = [
        c.with_(cooldown_seconds=0 if c.id == SPRAY else 4 * 86400) for c in B.history_pack()
    ]
    return P.run_pack(
        B.bound_auth(spark, sf), configs, B.AS_OF, recorded, top_n=None, dedup="cooldown"
    ).select("rule_id", "alert_fingerprint", "hits", "ts")


_REPLAY = [c.with_(window_minutes=B.DAY) for c in B.history_pack()]


@query(
    "replay_sliding_top1",
    O.with_(O.SRC, O.ENV, O.AUTH, O.tick_range(B.DAY, 6 * 3600), O.alerts_block(_REPLAY, 1))
    + "SELECT * FROM alerts",
)
def q_replay_top1(spark: SparkSession, sf: str) -> DataFrame:
    """One-day windows every six hours, only the top group of a rule per tick."""
    return P.replay(B.bound_auth(spark, sf), _REPLAY, 6 * 3600, B.START, B.AS_OF, top_n=1)


_FINE_END = B.START + timedelta(days=6)


def _fine_range() -> str:
    """Ticks of half an hour over six days: a day's window is 48 of them."""
    return O.tick_range(B.DAY, 1800).replace(O.AS_OF, f"TIMESTAMP '{_FINE_END}'")


@query(
    "replay_fine_slide",
    O.with_(O.SRC, O.ENV, O.AUTH, _fine_range(), O.alerts_block(_REPLAY, None)) + "SELECT * FROM alerts",
)
def q_replay_fine(spark: SparkSession, sf: str) -> DataFrame:
    """One-day windows every half hour over six days, every group."""
    return P.replay(B.bound_auth(spark, sf), _REPLAY, 1800, B.START, _FINE_END, top_n=None)


@query(
    "replay_fine_slide_top1",
    O.with_(O.SRC, O.ENV, O.AUTH, _fine_range(), O.alerts_block(_REPLAY, 1)) + "SELECT * FROM alerts",
)
def q_replay_fine_top1(spark: SparkSession, sf: str) -> DataFrame:
    return P.replay(B.bound_auth(spark, sf), _REPLAY, 1800, B.START, _FINE_END, top_n=1)


_MIXED = [c.with_(window_minutes=w) for c, w in zip(B.history_pack(), (7 * 1440, 7 * 1440, 1440, 2880, 720))]


def _mixed_sql() -> str:
    """Each rule over its own window length, by brute force over the ticks."""
    blocks, names = [O.SRC, O.ENV, O.AUTH], []
    text = ""
    for i, c in enumerate(_MIXED):
        ranged = O.tick_range(c.window_minutes, 8 * 3600)
        ranged = ranged.replace("ticks AS", f"ticks{i} AS").replace("FROM ticks t", f"FROM ticks{i} t")
        blocks.append(ranged.replace("ranged AS", f"ranged{i} AS"))
        blocks.append(
            O.alerts_block([c], None, f"alerts{i}").replace("FROM ranged", f"FROM ranged{i}")
        )
        names.append(f"SELECT * FROM alerts{i}")
    text = " UNION ALL ".join(names)
    return O.with_(*blocks) + (
        "SELECT rule_id, CAST(count(*) AS BIGINT) AS alerts, min(ts) AS first_ts, max(ts) AS last_ts, "
        f"CAST(sum(hits) AS BIGINT) AS hits FROM ({text}) GROUP BY rule_id"
    )


@query("replay_mixed_windows", _mixed_sql())
def q_replay_mixed(spark: SparkSession, sf: str) -> DataFrame:
    alerts = P.replay(B.bound_auth(spark, sf), _MIXED, 8 * 3600, B.START, B.AS_OF, top_n=None)
    return alerts.groupBy("rule_id").agg(
        F.count("*").alias("alerts"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum("hits").alias("hits"),
    )


USER_RULE = P.SqlRule(
    R.RuleConfig(
        id="host_success_volume", name="Host Success Volume", alert_type="success_volume",
        severity="low", threshold_value=10, window_minutes=B.MONTH,
        suppression_computers=("host-4",),
    ),
    """
    SELECT count(*) AS hits, '' AS principal, '' AS source_ip, host AS endpoint_id,
           min(ts) AS window_start, max(ts) AS window_end,
           count(DISTINCT user) AS distinct_user_count, count(DISTINCT src_ip) AS distinct_ip_count,
           source_kind, '' AS reason, 'many logins' AS evidence_summary, '' AS details,
           CAST(NULL AS TIMESTAMP) AS window_bucket
    FROM {auth_events}
    WHERE ts > :as_of - make_dt_interval(0, 0, :window_minutes) AND status = 'success'
    GROUP BY host, source_kind
    """,
)


@query(
    "sql_rule",
    O.AUTH_SQL
    + f"""SELECT {O.AS_OF} AS ts, 'host_success_volume' AS rule_id,
  concat_ws('|', 'success_volume', '', '', host, source_kind, {O.sec('max(ts)')}) AS alert_fingerprint,
  CAST(count(*) AS BIGINT) AS hits, host AS endpoint_id, source_kind, max(ts) AS window_bucket,
  CAST(count(DISTINCT "user") AS BIGINT) AS distinct_user_count,
  CAST(count(DISTINCT src_ip) AS BIGINT) AS distinct_ip_count,
  'Triggered by authlane detection service' AS reason, 'many logins' AS evidence_summary,
  'Triggered by authlane detection service' AS details
FROM auth WHERE status = 'success' AND ts > {O.AS_OF} - INTERVAL 30 DAY AND host <> 'host-4'
GROUP BY host, source_kind HAVING count(*) >= 10""",
)
def q_sql_rule(spark: SparkSession, sf: str) -> DataFrame:
    """A user-written rule: blanks take the stock texts, a NULL bucket the window end."""
    return P.run_pack(
        B.bound_auth(spark, sf), [], B.AS_OF, sql_rules=[USER_RULE], top_n=None
    ).select(
        "ts", "rule_id", "alert_fingerprint", "hits", "endpoint_id", "source_kind", "window_bucket",
        "distinct_user_count", "distinct_ip_count", "reason", "evidence_summary", "details",
    )
