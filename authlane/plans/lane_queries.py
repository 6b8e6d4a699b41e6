"""Registered queries: raw lanes, normalizers and the wire envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane.functions.plan import computed_once
from authlane.functions.text import fields_text
from authlane.functions.times import ms_text
from authlane.operators import envelope as E
from authlane.operators import normalize as N
from authlane.operators import reports as R
from authlane.plans import bindings as B
from authlane.plans import oracle as O
from authlane.plans.registry import query
from authlane.sources import readers as SR
from authlane.sources import windows_export as W
from authlane.streaming.offsets import not_seen, offset_ranges, with_position

SRC = O.with_(O.SRC)


def _shown(envelopes: DataFrame) -> DataFrame:
    """Envelope rows with the map as text, which both engines compare alike."""
    return envelopes.withColumn("fields", fields_text())


def _fields(**entries: str) -> str:
    """SQL for the map text: NULL entries are left out."""
    parts = ", ".join(f"'{k}=' || {v}" for k, v in entries.items())
    return f"array_to_string(list_sort([{parts}]), chr(10))"


_HEART = "'heartbeat ' || et || ' ' || id"
_VERSION = f"'{O.VERSION}'"

GENERIC_SQL = f"""
SELECT CASE WHEN k % 10 <> 0 THEN ts ELSE {O.AS_OF} END AS ts, 'local-mvp' AS platform,
  {_VERSION} AS schema_version,
  CASE WHEN k % 8 = 0 THEN 'vector-windows-endpoint' WHEN k % 4 = 0 THEN 'vector-fluent'
       WHEN k % 4 = 2 THEN 'vector-demo_logs' ELSE 'vector-syslog' END AS ingest_source,
  CASE WHEN et <> 'error' THEN {_HEART} WHEN uid % 2 = 0 THEN ''
       ELSE 'normalized event (no source message field)' END AS message,
  {_fields(
      tag="CASE WHEN k % 8 = 0 THEN 'windows.events' WHEN k % 8 = 4 THEN 'app.logs' END",
      hostname="CASE WHEN k % 4 <> 0 THEN hst END", appname="CASE WHEN k % 4 <> 0 THEN 'sshd' END",
      severity="CASE WHEN et = 'error' THEN 'err' END", procid="id",
      channel="CASE WHEN k % 16 = 0 THEN 'Application' WHEN k % 4 = 0 THEN 'Security' END",
      computer="CASE WHEN k % 4 = 0 THEN hst END", event_id="CASE WHEN k % 4 = 0 THEN '4625' END",
      collector="CASE WHEN k % 4 = 0 THEN 'fluent-bit-windows' END",
      host_collection="CASE WHEN k % 4 = 0 THEN 'windows-eventlog' END", schema_version=_VERSION,
  )} AS fields
FROM src"""


def _generic(spark: SparkSession, sf: str) -> DataFrame:
    return N.normalize_generic(N.decode_records(B.raw_records(spark, sf)), B.AS_OF)


@query(
    "generic_rejects",
    SRC
    + """SELECT CASE WHEN id % 7 = 3 THEN 'unsupported timestamp format' ELSE 'kept' END AS reason,
  CAST(count(*) AS BIGINT) AS rows FROM src GROUP BY 1""",
)
def q_generic_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Records of which every seventh has a time stamp that cannot be read."""
    record = F.col("record")
    damaged = F.map_concat(
        F.map_filter(record, lambda k, _: k != "timestamp"),
        F.create_map(F.lit("timestamp"), F.concat(F.lit("day "), record["procid"])),
    )
    hit = record["procid"].cast("bigint") % 7 == 3
    records = N.decode_records(B.raw_records(spark, sf)).withColumn("record", F.when(hit, damaged).otherwise(record))
    rejects = records.select(N.generic_reject_reason().alias("reason")).filter("reason IS NOT NULL")
    kept = N.normalize_generic(records, B.AS_OF).select(F.lit("kept").alias("reason"))
    return rejects.unionAll(kept).groupBy("reason").agg(F.count("*").alias("rows"))


@query("normalize_generic", SRC + GENERIC_SQL)
def q_generic(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_generic(spark, sf))


@query(
    "generic_lanes",
    SRC + f"SELECT ingest_source, CAST(count(*) AS BIGINT) AS events FROM ({GENERIC_SQL}) GROUP BY 1",
)
def q_generic_lanes(spark: SparkSession, sf: str) -> DataFrame:
    return _generic(spark, sf).groupBy("ingest_source").agg(F.count("*").alias("events"))


SYNTHETIC_SQL = f"""
SELECT CASE WHEN k % 20 = 0 THEN {O.AS_OF} WHEN k % 2 = 1 THEN ts - INTERVAL 2 HOUR ELSE ts END AS ts,
  platform, {_VERSION} AS schema_version, 'synthetic-auth' AS ingest_source,
  CASE WHEN et <> 'click' THEN {_HEART} ELSE 'synthetic auth event' END AS message,
  {_fields(
      event_type="'login'", user="usr", src_ip="CASE WHEN k % 7 <> 0 THEN ip ELSE '' END", host="hst",
      status="CASE et WHEN 'error' THEN 'failure' ELSE 'success' END",
      source_kind="CASE WHEN uid % 3 = 0 AND platform = 'windows' THEN 'windows_auth' ELSE 'linux_ssh' END",
      raw_event_id="'4625'", logon_type="CASE WHEN k % 2 = 0 THEN '3' ELSE '' END", domain="''",
      auth_method="''", collector_name="CASE WHEN k % 4 = 0 THEN 'sim-a' ELSE 'authlane-sim' END",
      scenario="CASE WHEN et <> 'view' THEN 'replay-' || et END", schema_version=_VERSION,
  )} AS fields
FROM (SELECT *, CASE WHEN k % 10 = 9 THEN 'synthetic-auth' WHEN uid % 2 = 0 THEN 'linux'
                     ELSE 'windows' END AS platform FROM src)
WHERE k NOT IN (98, 99)"""


@query("normalize_synthetic_auth", SRC + SYNTHETIC_SQL)
def q_synthetic(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(N.normalize_synthetic_auth(N.decode_records(B.raw_scenarios(spark, sf)), B.AS_OF))


@query(
    "synthetic_rejects",
    SRC
    + """SELECT CASE k WHEN 99 THEN 'invalid json' ELSE 'unsupported timestamp format' END AS reason,
  CAST(count(*) AS BIGINT) AS lines FROM src WHERE k IN (98, 99) GROUP BY 1""",
)
def q_synthetic_rejects(spark: SparkSession, sf: str) -> DataFrame:
    records = N.decode_records(B.raw_scenarios(spark, sf))
    reasons = records.select(N.synthetic_reject_reason().alias("reason"))
    return reasons.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("lines"))


_SSH_LINE = """CASE k WHEN 13 THEN 'Foo' ELSE strftime(ts, '%b') END || ' '
    || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || ' ' || strftime(ts, '%H:%M:%S') || ' ' || hst || ' '
    || CASE WHEN et = 'view' THEN 'CRON[7]' WHEN k % 7 = 0 THEN 'sshd' ELSE 'sshd[' || id || ']' END || ': '
    || CASE et WHEN 'click' THEN 'Connection closed by ' || addr
         WHEN 'error' THEN 'Failed ' || method || ' for '
           || CASE WHEN k % 10 = 0 THEN 'invalid user ' ELSE '' END || usr || ' from ' || addr || ' port 22 ssh2'
         ELSE 'Accepted ' || method || ' for ' || usr || ' from ' || addr || ' port 22 ssh2' END"""

_SSH_SRC = f"""ssh AS (
  SELECT *, {_SSH_LINE} AS line FROM (
    SELECT *, CASE WHEN k % 25 = 0 THEN 'keyboard-interactive' WHEN et = 'signup' THEN 'publickey'
                   ELSE 'password' END AS method,
           CASE WHEN k % 9 = 0 THEN 'fe80::1' ELSE ip END AS addr FROM src))"""


@query(
    "normalize_ssh_auth",
    O.with_(O.SRC, _SSH_SRC)
    + f"""SELECT CASE k WHEN 13 THEN {O.AS_OF} ELSE date_trunc('second', ts) END AS ts,
  'linux-host' AS platform, {_VERSION} AS schema_version, 'vector-linux-ssh' AS ingest_source,
  line AS message,
  {_fields(
      event_type="'login'", user="usr", src_ip="addr", host="hst",
      status="CASE et WHEN 'error' THEN 'failure' ELSE 'success' END", auth_method="method",
      source_kind="'linux_ssh'", collector_name="'collector'", raw_message="line",
      schema_version=_VERSION,
  )} AS fields
FROM ssh WHERE et IN ('error', 'signup', 'purchase') AND k % 25 <> 0""",
)
def q_ssh(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(N.normalize_ssh_auth(B.raw_ssh_lines(spark, sf), B.AS_OF))


@query(
    "ssh_recent_lines",
    O.with_(O.SRC, _SSH_SRC)
    + """SELECT line AS value, id AS line_no FROM ssh
WHERE regexp_matches(line, 'sshd.*(Failed password|Accepted (password|publickey))')
ORDER BY id DESC LIMIT 25""",
)
def q_ssh_lines(spark: SparkSession, sf: str) -> DataFrame:
    return R.ssh_auth_lines(B.raw_ssh_lines(spark, sf), "line_no", 25)


_WIN_SRC = """win AS (
  SELECT *, CASE WHEN et IN ('signup', 'purchase') THEN '4624' WHEN et = 'click' THEN '4634'
                 ELSE '4625' END AS eid,
         ['', '2', '3', '10', '5', '3'][k % 6 + 1] AS logon
  FROM src)"""

_WIN_KEPT = "eid <> '4634' AND logon <> '5' AND k % 50 NOT IN (1, 2)"


@query(
    "normalize_windows_auth",
    O.with_(O.SRC, _WIN_SRC)
    + f"""SELECT ts, 'windows' AS platform, {_VERSION} AS schema_version,
  'vector-windows-endpoint' AS ingest_source,
  'Windows logon ' || status || ' user=' || usr || CASE addr WHEN '' THEN '' ELSE ' src_ip=' || addr END
    || ' host=' || machine || ' event_id=' || eid
    || CASE k % 2 WHEN 1 THEN ' details=logon  attempt' ELSE '' END AS message,
  {_fields(
      event_type="'login'", user="usr", src_ip="addr", host="machine", status="status",
      raw_event_id="eid", event_id="eid", logon_type="logon", domain="'LAB'", auth_method="'ntlm'",
      collector_name="'collector'", source_kind="'windows_auth'",
      collector_flavor="'authlane-collector-windows'", environment_tag="'lab'", channel="'Security'",
      provider_name="'Security-Auditing'", computer="machine", record_id="id", schema_version=_VERSION,
  )} AS fields
FROM (SELECT id, uid, k, usr, eid, logon, CASE WHEN k % 33 = 0 THEN {O.AS_OF} ELSE ts END AS ts,
        CASE eid WHEN '4624' THEN 'success' ELSE 'failure' END AS status,
        CASE WHEN k % 8 < 3 THEN '' WHEN k % 8 = 3 THEN '127.0.0.1' ELSE ip END AS addr,
        CASE WHEN uid % 3 = 0 THEN 'collector' ELSE hst END AS machine
      FROM win WHERE {_WIN_KEPT})""",
)
def q_windows(spark: SparkSession, sf: str) -> DataFrame:
    lines = N.windows_payload(B.raw_windows_records(spark, sf))
    return _shown(N.normalize_windows_auth(N.decode_records(lines), B.AS_OF))


_XML = """xml AS (
  SELECT *,
    CASE WHEN k % 4 = 1 THEN '' WHEN k % 50 = 2 THEN '-' ELSE usr END AS target_user,
    CASE WHEN k % 20 = 1 THEN '' ELSE 'svc-' || hst END AS subject_user,
    CASE WHEN k % 5 = 0 THEN '' ELSE 'LAB' END AS target_domain,
    CASE WHEN k % 3 = 0 THEN '' ELSE 'NTLM' END AS package
  FROM win)"""

_EXPORT = """export AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS "timestamp", eid AS event_id,
    coalesce(nullif(target_user, ''), subject_user) AS "user",
    coalesce(nullif(target_domain, ''), 'CORP') AS domain, ip AS src_ip, hst AS host,
    logon AS logon_type, coalesce(nullif(package, ''), 'NtLmSsp') AS auth_method,
    'Security-Auditing' AS provider_name, 'logon event ' || id AS raw_message, id AS record_id, ts
  FROM xml WHERE eid <> '4634')"""

# Without a cursor the exporter starts from zero, and record 0 is not above it.
_OUTCOME = """CASE WHEN record_id <= 0 THEN 'already_seen' WHEN logon_type = '5' THEN 'unsupported_logon_type'
  WHEN "user" IN ('', '-') THEN 'missing_or_invalid_username' ELSE 'emitted' END"""


@query(
    "windows_eventdata",
    O.with_(O.SRC, _WIN_SRC, _XML)
    + """SELECT id AS record_id, name, value FROM (
  SELECT id, unnest(['TargetUserName', 'SubjectUserName', 'TargetDomainName', 'SubjectDomainName',
                     'AuthenticationPackageName', 'LogonProcessName', 'LogonType', 'IpAddress']) AS name,
         unnest([target_user, subject_user, target_domain, 'CORP', package, 'NtLmSsp', logon, ip]) AS value
  FROM xml)""",
)
def q_eventdata(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.raw_windows_xml(spark, sf)
    return rows.select("record_id", F.explode(W.eventdata_map(F.col("xml"))).alias("name", "value"))


def _logons(spark: SparkSession, sf: str) -> DataFrame:
    return W.logon_events(B.raw_windows_xml(spark, sf), B.AS_OF, lookback_minutes=B.MONTH)


@query(
    "windows_export_records",
    O.with_(O.SRC, _WIN_SRC, _XML, _EXPORT)
    + f"SELECT * EXCLUDE (ts), {_OUTCOME} AS outcome FROM export",
)
def q_export(spark: SparkSession, sf: str) -> DataFrame:
    return W.export_records(_logons(spark, sf))


@query(
    "windows_export_counts",
    O.with_(O.SRC, _WIN_SRC, _XML, _EXPORT)
    + f"""SELECT CAST(count(*) AS BIGINT) AS scanned,
  CAST(count(*) FILTER (o = 'already_seen') AS BIGINT) AS already_seen,
  CAST(count(*) FILTER (o = 'unsupported_logon_type') AS BIGINT) AS unsupported_logon_type,
  CAST(count(*) FILTER (o = 'missing_or_invalid_username') AS BIGINT) AS missing_or_invalid_username,
  CAST(count(*) FILTER (o = 'emitted') AS BIGINT) AS emitted
FROM (SELECT CASE WHEN record_id <= 100 THEN 'already_seen' ELSE {_OUTCOME} END AS o FROM export)""",
)
def q_export_counts(spark: SparkSession, sf: str) -> DataFrame:
    return W.drop_counts(W.export_records(_logons(spark, sf), cursor=100))


@query(
    "windows_cursor",
    O.with_(O.SRC, _WIN_SRC, _XML, _EXPORT)
    + f"""SELECT 'v2:' || greatest(coalesce(max(record_id), 0), 100) AS cursor
FROM export WHERE record_id > 100 AND {_OUTCOME} = 'emitted'""",
)
def q_cursor(spark: SparkSession, sf: str) -> DataFrame:
    rows = W.after_cursor(_logons(spark, sf), W.parse_cursor("v2:100"))
    return W.next_cursor(W.export_records(rows, 100), 100)


@query(
    "windows_newest_events",
    O.with_(O.SRC, _WIN_SRC, _XML, _EXPORT)
    + f"""SELECT "timestamp", event_id, "user", record_id FROM export
WHERE ts >= {O.AS_OF} - INTERVAL 30 DAY ORDER BY record_id DESC LIMIT 200""",
)
def q_newest(spark: SparkSession, sf: str) -> DataFrame:
    rows = W.logon_events(B.raw_windows_xml(spark, sf), B.AS_OF, B.MONTH, newest=200)
    records = W.export_records(rows).select("timestamp", "event_id", "user", "record_id")
    return records.orderBy("record_id")


@query(
    "windows_export_to_envelope",
    O.with_(O.SRC, _WIN_SRC, _XML, _EXPORT)
    + f"""SELECT ts, CASE event_id WHEN '4624' THEN 'success' ELSE 'failure' END AS status, "user", host,
  lower(auth_method) AS auth_method, CAST(record_id AS VARCHAR) AS record_id
FROM export WHERE {_OUTCOME} = 'emitted'""",
)
def q_export_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Event log XML to export record to envelope, end to end."""
    lines = W.emitted(W.export_records(_logons(spark, sf)))
    envelopes = N.normalize_windows_auth(N.decode_records(lines), B.AS_OF)
    keys = ["status", "user", "host", "auth_method", "record_id"]
    return envelopes.select("ts", *[F.col("fields")[k].alias(k) for k in keys])


_WIRE = f"""wire AS (
  SELECT id, k, et, usr, value,
    CASE WHEN k % 4 IN (0, 2) THEN ts WHEN k % 4 = 1 THEN date_trunc('second', ts)
         ELSE date_trunc('second', ts) - INTERVAL 330 MINUTE END AS ts,
    regexp_replace(CAST(CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) AS VARCHAR), '\\.0$', '') AS ratio
  FROM src)"""

_WIRE_FIELDS = """'attempt=' || k, 'big=1000', 'flag=' || CASE k % 2 WHEN 0 THEN 'true' ELSE 'false' END,
  'list=[1,-1000,1.5e-7,2.5e+300,12345678901234567000,"a -1e3"]', 'nested={"a":"\\u003cb\\u003e","z":1}', 'ratio=' || ratio, 'user=' || usr, 'whole=1'"""


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    return E.decode_envelopes(B.raw_envelopes(spark, sf))


@query(
    "envelope_decode",
    O.with_(O.SRC, _WIRE)
    + f"""SELECT ts, 'linux' AS platform, '' AS schema_version, 'vector-syslog' AS ingest_source,
  'heartbeat ' || et AS message,
  CASE WHEN k % 10 = 3 THEN '' ELSE array_to_string([{_WIRE_FIELDS}], chr(10)) END AS fields
FROM wire WHERE k NOT BETWEEN 94 AND 97""",
)
def q_decode(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(E.accepted(_decoded(spark, sf)))


@query(
    "envelope_quarantine",
    SRC
    + """SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT CASE k WHEN 97 THEN 'invalid json' WHEN 96 THEN 'empty timestamp' WHEN 94 THEN 'wrong type'
                ELSE 'unsupported timestamp format' END AS reason
  FROM src WHERE k BETWEEN 94 AND 97) GROUP BY reason""",
)
def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = E.quarantined(_decoded(spark, sf))
    return bad.groupBy("reason").agg(F.count("*").alias("rows"))


@query(
    "stringify_map",
    O.with_(O.SRC, _WIRE)
    + f"""SELECT split_part(entry, '=', 1) AS key, entry[position('=' IN entry) + 1:] AS value,
  CAST(count(*) AS BIGINT) AS rows
FROM (SELECT unnest([{_WIRE_FIELDS}]) AS entry FROM wire WHERE k NOT BETWEEN 94 AND 97 AND k % 10 <> 3)
GROUP BY 1, 2""",
)
def q_stringify(spark: SparkSession, sf: str) -> DataFrame:
    # Exploding a projected map would write it out once more, in a filter on its size.
    decoded = computed_once(E.accepted(_decoded(spark, sf)), texts=F.col("fields"))
    rows = decoded.select(F.explode("texts").alias("key", "value"))
    return rows.groupBy("key", "value").agg(F.count("*").alias("rows"))


_JSON_FIELDS = """CASE
  WHEN lane = 0 AND f_event_type <> '' THEN '"event_type":"login","user":"' || f_user || '","src_ip":"'
    || f_src_ip || '","status":"' || f_status || '","computer":"' || f_computer
    || '","logon_type":"3","event_id":"' || f_event_id || '"'
  WHEN lane = 0 THEN '"computer":"' || f_computer || '"'
  WHEN lane = 2 AND f_event_type <> '' THEN '"event_type":"login","user":"' || f_user || '","src_ip":"'
    || f_src_ip || '","status":"' || f_status || '","host":"' || f_host || '","scenario":"' || f_scenario || '"'
  WHEN lane = 2 THEN '"host":"' || f_host || '"'
  ELSE '"hostname":"' || f_hostname || '"' END"""


@query(
    "envelope_publish",
    O.EVENTS_SQL
    + f"""SELECT '{{"ts":"' || {O.ms('ts')} || '","platform":"' || platform || '","schema_version":"'
  || schema_version || '","ingest_source":"' || ingest_source || '","message":"' || message
  || '","fields":{{' || {_JSON_FIELDS} || '}}}}' AS value FROM env""",
)
def q_publish(spark: SparkSession, sf: str) -> DataFrame:
    return E.publish(B.bound_events(spark, sf))


@query(
    "envelope_roundtrip",
    O.EVENTS_SQL
    + """SELECT ts, platform, schema_version, ingest_source, message FROM env""",
)
def q_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Publish every event and decode it again."""
    decoded = E.decode_envelopes(E.publish(B.bound_events(spark, sf)))
    return E.accepted(decoded).drop("fields")


@query(
    "event_ids_from_position",
    SRC
    + """SELECT CAST(count(*) AS BIGINT) AS events, CAST(count(*) AS BIGINT) AS ids,
  CAST(64 AS INTEGER) AS length FROM src""",
)
def q_event_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids derived from the source position: one per position, the same on redelivery."""
    rows = B.raw_envelopes(spark, sf)
    first = rows.select(E.position_id(F.lit("events"), F.lit("0"), F.col("id")).alias("event_id"))
    redelivered = first.unionAll(first)
    return redelivered.agg(
        (F.count("*") / 2).cast("bigint").alias("events"),
        F.count_distinct("event_id").alias("ids"),
        F.max(F.length("event_id")).alias("length"),
    )


@query(
    "lane_fan_in",
    SRC
    + f"""SELECT ingest_source, platform, CAST(count(*) AS BIGINT) AS events, max(ts) AS last_ts
FROM (SELECT ts, platform, ingest_source FROM ({GENERIC_SQL})
      UNION ALL SELECT ts, platform, ingest_source FROM ({SYNTHETIC_SQL}))
GROUP BY ALL""",
)
def q_fan_in(spark: SparkSession, sf: str) -> DataFrame:
    synthetic = N.normalize_synthetic_auth(N.decode_records(B.raw_scenarios(spark, sf)), B.AS_OF)
    return (
        N.lane_fan_in(_generic(spark, sf), synthetic)
        .groupBy("ingest_source", "platform")
        .agg(F.count("*").alias("events"), F.max("ts").alias("last_ts"))
    )


@query(
    "scenario_stamp",
    SRC
    + """SELECT usr AS "user", '2024-01-31T00:00:00Z' AS "timestamp", '20240131T000000Z-demo' AS run_id,
  CAST(count(*) AS BIGINT) AS lines FROM src WHERE k <> 99 GROUP BY usr""",
)
def q_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = SR.stamp_scenario(B.raw_scenarios(spark, sf, stamped=False), "demo", B.AS_OF)
    records = N.decode_records(stamped).filter("record IS NOT NULL")
    keys = [F.col("record")[k].alias(k) for k in ("user", "timestamp", "run_id")]
    return records.groupBy(*keys).agg(F.count("*").alias("lines"))


@query(
    "forwarded_records",
    SRC
    + f"""SELECT 'vector-windows-endpoint' AS ingest_source,
  'tag=windows.events' AS tag, 'collector=fluent-bit-windows' AS collector,
  CAST(count(*) AS BIGINT) AS events,
  CAST(count(*) FILTER (k % 10 = 0) AS BIGINT) AS undated FROM src""",
)
def q_forwarded(spark: SparkSession, sf: str) -> DataFrame:
    """Every record through the forwarder: its tag and constants replace the record's own."""
    records = N.decode_records(B.raw_records(spark, sf))
    stamped = records.withColumn("record", SR.forwarder_stamp(F.col("record")))
    rows = N.normalize_generic(stamped, B.AS_OF)
    return rows.groupBy(
        "ingest_source",
        F.concat(F.lit("tag="), F.col("fields")["tag"]).alias("tag"),
        F.concat(F.lit("collector="), F.col("fields")["collector"]).alias("collector"),
    ).agg(
        F.count("*").alias("events"),
        F.count_if(ms_text(F.col("ts")) == "2024-01-31 00:00:00.000").alias("undated"),
    )


_MESSAGES = """m AS (SELECT 'topic|' || et AS source, CAST(id AS BIGINT) AS "at", ts FROM src)"""


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """The events as messages of a topic partition per event type."""
    rows = B.source_rows(spark, sf, parsed=False).select(F.lit("topic").alias("topic"), "et", "id", "ts")
    return with_position(rows, ("topic", "et", "id")).select("source", "at", "ts")


@query(
    "offset_ranges",
    O.with_(O.SRC, _MESSAGES)
    + """SELECT source, CAST(min("at") AS BIGINT) AS first, CAST(max("at") + 1 AS BIGINT) AS after
FROM (SELECT source, "at", "at" - row_number() OVER (PARTITION BY source ORDER BY "at") AS run FROM m)
GROUP BY source, run""",
)
def q_offset_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """What a table of stored offsets holds after all events."""
    return offset_ranges(_messages(spark, sf))


@query(
    "redelivered_once",
    O.with_(O.SRC, _MESSAGES)
    + """SELECT source, "at" FROM m WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
EXCEPT SELECT source, "at" FROM m WHERE ts < TIMESTAMP '2024-01-20 00:00:00'""",
)
def q_redelivered_once(spark: SparkSession, sf: str) -> DataFrame:
    """What a delivery from the 10th on adds where all before the 20th is stored."""
    rows = _messages(spark, sf)
    stored = offset_ranges(rows.where("ts < TIMESTAMP '2024-01-20 00:00:00'"))
    again = rows.where("ts >= TIMESTAMP '2024-01-10 00:00:00'").select("source", "at")
    return not_seen(again, stored)
