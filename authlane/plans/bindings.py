"""Bind the ``events`` table to the data model.

The table holds generic application events. Every row is rendered as a login or
heartbeat event of one of four lanes, or as a raw record of one lane, so that the
operators run over the whole table and their work grows with it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane import settings as S
from authlane.functions.times import before, millis, ms_text
from authlane.operators.pack import replay
from authlane.operators.rules import RULE_PACK, RuleConfig
from authlane.operators.views import auth_events
from authlane.session import configure
from authlane.settings import DEFAULT_SETTINGS
from authlane.sources.readers import spread

AS_OF = datetime(2024, 1, 31)
START = datetime(2024, 1, 1)
DAY = 24 * 60
MONTH = 30 * DAY


def source_rows(
    spark: SparkSession, sf_dir: str, since_minutes: int | None = None, parsed: bool = True
) -> DataFrame:
    """The rows of ``events`` with the derived login facts. ``since_minutes`` restricts
    the scan to the minutes before AS_OF, on the stored column, where Parquet can skip.
    ``parsed`` says that texts are to be parsed, which is worth spreading a small scan."""
    configure(spark)
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    if since_minutes is not None:
        df = df.filter(F.col("ts") >= before(AS_OF, minutes=since_minutes).cast("timestamp_ntz"))
    return (spread(df) if parsed else df).selectExpr(
        "event_id AS id",
        "date_trunc('MILLISECOND', CAST(ts AS TIMESTAMP)) AS ts",
        "user_id AS uid",
        "event_type AS et",
        "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    ).selectExpr(
        "*",
        "concat('user-', uid) AS user",
        "concat('10.0.0.', k % 8) AS ip",
        "concat('host-', uid % 5) AS host",
    )


_LOGIN = "et IN ('error', 'signup', 'purchase')"

# The anchor columns that do not need the row's login facts.
ANCHORS = {
    "ts": "ts",
    "event_id": "concat('evt-', id)",
    "platform": f"""CASE uid % 4 WHEN 0 THEN 'windows' WHEN 1 THEN 'linux-host'
        WHEN 2 THEN 'linux' ELSE '{DEFAULT_SETTINGS.platform}' END""",
    "schema_version": f"'{DEFAULT_SETTINGS.schema_version}'",
    "ingest_source": f"""CASE uid % 4 WHEN 0 THEN '{S.LANE_WINDOWS}' WHEN 1 THEN '{S.LANE_LINUX_SSH}'
        WHEN 2 THEN '{S.LANE_SYNTHETIC}' ELSE '{S.LANE_SYSLOG}' END""",
}

_MESSAGE = f"""CASE
    WHEN NOT {_LOGIN} THEN concat('heartbeat ', et)
    WHEN uid % 4 = 0 THEN concat('Windows logon ', CASE et WHEN 'error' THEN 'failure' ELSE 'success' END,
        ' user=', user, ' host=', host)
    ELSE concat('sshd[', id, ']: ',
        CASE et WHEN 'error' THEN 'Failed password' WHEN 'signup' THEN 'Accepted publickey'
                ELSE 'Accepted password' END,
        ' for ', CASE WHEN et = 'error' AND k % 10 = 0 THEN 'invalid user ' ELSE '' END, user,
        ' from ', ip, ' port 22 ssh2') END"""

_TOLD = """'event_type', 'login', 'user', user, 'src_ip', ip, 'status',
    CASE WHEN et <> 'error' THEN 'Successful' WHEN k % 2 = 1 THEN 'FAILED' ELSE 'failure' END"""

_FIELDS = f"""CASE
    WHEN uid % 4 = 0 AND {_LOGIN} THEN map({_TOLD}, 'computer', host, 'logon_type', '3',
        'event_id', CASE et WHEN 'error' THEN '4625' ELSE '4624' END)
    WHEN uid % 4 = 0 THEN map('computer', host)
    WHEN uid % 4 = 2 AND {_LOGIN} THEN map({_TOLD}, 'host', host, 'scenario', concat('replay-', et))
    WHEN uid % 4 = 2 THEN map('host', host)
    ELSE map('hostname', host) END"""


def bound_anchors(
    spark: SparkSession, sf_dir: str, since_minutes: int | None = None
) -> DataFrame:
    """Stored events without message and fields, for queries that read only anchors."""
    return source_rows(spark, sf_dir, since_minutes, parsed=False).selectExpr(
        *[f"{expr} AS {name}" for name, expr in ANCHORS.items()]
    )


def bound_events(
    spark: SparkSession, sf_dir: str, since_minutes: int | None = None
) -> DataFrame:
    """The table as stored envelope events.

    ``inline`` makes message and fields columns in their own right, as they are in a stored
    table: a filter above reads them instead of rebuilding them inside its predicate.
    """
    return source_rows(spark, sf_dir, since_minutes).selectExpr(
        *[f"{expr} AS {name}" for name, expr in ANCHORS.items()],
        f"inline(array(named_struct('message', {_MESSAGE}, 'fields', {_FIELDS})))",
    )


def bound_auth(spark: SparkSession, sf_dir: str, since_minutes: int | None = None) -> DataFrame:
    return auth_events(bound_events(spark, sf_dir, since_minutes))


def month_pack() -> list[RuleConfig]:
    """The shipped pack over a 30-day window: the table is too sparse for minutes."""
    return [c.with_(window_minutes=MONTH) for c in RULE_PACK]


def history_pack() -> list[RuleConfig]:
    """Rules for the alert history: 7-day windows, and burst sizes a sparse table reaches."""
    low = {
        "security_failed_login_burst": {"threshold_value": 2},
        "security_failed_then_success": {"threshold_value": 2, "threshold_failures": 2},
        "windows_failed_logon_burst": {"threshold_value": 5},
    }
    return [c.with_(window_minutes=7 * DAY, **low.get(c.id, {})) for c in RULE_PACK]


HISTORY_SLIDE_SECONDS = 12 * 3600


def bound_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert table: what polling twice a day over the whole month would have recorded."""
    return replay(
        bound_auth(spark, sf_dir), history_pack(), HISTORY_SLIDE_SECONDS, START, AS_OF, top_n=None
    )


# Raw records, one per row of the table.


def _json_line(entries: dict[str, Column]) -> Column:
    """JSON object text; NULL entries are left out."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in entries.items()]))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded syslog and forwarded records as JSON lines."""
    c, k, et = F.col, F.col("k"), F.col("et")
    fluent = k % 4 == 0
    entries = {
        "timestamp": F.when(k % 10 != 0, ms_text(c("ts"))),
        "source_type": F.when(fluent, "fluent").when(k % 4 == 1, "syslog").when(k % 4 == 2, "demo_logs"),
        "tag": F.when(k % 8 == 0, "windows.events").when(k % 8 == 4, "app.logs"),
        "message": F.when(et == "click", _heart()).when((et == "error") & (c("uid") % 2 == 0), ""),
        "log": F.when(et == "view", _heart()),
        "msg": F.when(et == "purchase", _heart()),
        "Message": F.when(et == "signup", _heart()),
        "hostname": F.when(~fluent, c("host")),
        "appname": F.when(~fluent, "sshd"),
        "severity": F.when(et == "error", "err"),
        "procid": c("id"),
        "Channel": F.when(fluent, "Security"),
        "channel": F.when(k % 16 == 0, "Application"),
        "Computer": F.when(fluent, c("host")),
        "EventID": F.when(fluent, F.lit(4625)),
        "collector": F.when(fluent, "fluent-bit-windows"),
        "host_collection": F.when(fluent, "windows-eventlog"),
        "ignored": c("value"),
    }
    # Two keys differ only in case, which a struct cannot hold: add the second by hand.
    lower = {key: v for key, v in entries.items() if key not in ("Channel", "Message")}
    upper = {key: entries[key] for key in ("Channel", "Message")}
    first, second = _json_line(lower), _json_line(upper)
    joined = F.when(second == "{}", first).otherwise(
        F.concat(F.regexp_replace(first, r"\}$", ","), F.substring(second, F.lit(2), F.length(second)))
    )
    return source_rows(spark, sf_dir).select(joined.alias("value"))


def _heart() -> Column:
    return F.concat(F.lit("heartbeat "), F.col("et"), F.lit(" "), F.col("id"))


def raw_scenarios(spark: SparkSession, sf_dir: str, stamped: bool = True) -> DataFrame:
    """Scenario lines, with some that are broken or carry a bad timestamp. Unstamped lines
    have neither a timestamp nor a run id."""
    c, k, et = F.col, F.col("k"), F.col("et")
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    entries = {
        "platform": F.when(k % 10 == 9, F.lit(None)).when(c("uid") % 2 == 0, "Linux").otherwise("WINDOWS"),
        "message": F.when(et != "click", _heart()),
        "user": c("user"),
        "src_ip": F.when(k % 7 != 0, c("ip")),
        "host": c("host"),
        "status": F.upper(F.when(et == "error", "failure").otherwise("success")),
        "source_kind": F.when(c("uid") % 3 != 0, "linux_ssh"),
        "raw_event_id": F.lit(4625),
        "logon_type": F.when(k % 2 == 0, "3"),
        "collector_name": F.when(k % 4 == 0, "sim-a"),
        "scenario": F.when(et != "view", F.concat(F.lit("replay-"), et)),
        "timestamp": F.when(k % 20 == 0, F.lit(None))
        .when(k == 98, "yesterday")
        .when(k % 2 == 1, F.concat(utc, F.lit("+02:00")))
        .otherwise(F.concat(utc, F.lit("Z"))),
        "run_id": F.lit("run-1"),
    }
    if not stamped:
        entries = {key: v for key, v in entries.items() if key not in ("timestamp", "run_id")}
    line = F.when(k == 99, "{broken").otherwise(_json_line(entries))
    return source_rows(spark, sf_dir).select(line.alias("value"))


def raw_ssh_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SSH daemon log lines, and other daemons' lines between them."""
    c, k, et = F.col, F.col("k"), F.col("et")
    month = F.when(k == 13, "Foo").otherwise(F.date_format("ts", "MMM"))
    stamp = F.concat(
        month, F.lit(" "), F.lpad(F.dayofmonth("ts").cast("string"), 2, " "), F.lit(" "),
        F.date_format("ts", "HH:mm:ss"),
    )
    daemon = F.when(et == "view", "CRON[7]").when(k % 7 == 0, "sshd").otherwise(
        F.concat(F.lit("sshd["), c("id"), F.lit("]"))
    )
    method = F.when(k % 25 == 0, "keyboard-interactive").when(et == "signup", "publickey").otherwise("password")
    address = F.when(k % 9 == 0, "fe80::1").otherwise(c("ip"))
    body = (
        F.when(et == "click", F.concat(F.lit("Connection closed by "), address))
        .when(
            et == "error",
            F.concat(
                F.lit("Failed "), method, F.lit(" for "),
                F.when(k % 10 == 0, "invalid user ").otherwise(""), c("user"),
                F.lit(" from "), address, F.lit(" port 22 ssh2"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("Accepted "), method, F.lit(" for "), c("user"), F.lit(" from "), address,
                F.lit(" port 22 ssh2"),
            )
        )
    )
    return source_rows(spark, sf_dir).select(
        F.concat(stamp, F.lit(" "), c("host"), F.lit(" "), daemon, F.lit(": "), body).alias("value"),
        c("id").alias("line_no"),
    )


def _windows_event_id() -> Column:
    et = F.col("et")
    return F.when(et == "error", "4625").when(et.isin("signup", "purchase"), "4624").when(
        et == "view", "4625"
    ).otherwise("4634")


def _logon_type() -> Column:
    slot = F.col("k") % 6
    return (
        F.when(slot == 1, "2").when(slot == 2, "3").when(slot == 3, "10")
        .when(slot == 4, "5").when(slot == 5, "3").otherwise("")
    )


def _windows_address() -> Column:
    slot = F.col("k") % 8
    return (
        F.when(slot == 0, "-").when(slot == 1, "::1").when(slot == 2, "::ffff:127.0.0.1")
        .when(slot == 3, "127.0.0.1").otherwise(F.col("ip"))
    )


def raw_windows_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported Windows logon records as JSON lines, some on ``stdout``."""
    c, k = F.col, F.col("k")
    entries = {
        "timestamp": F.when(k % 33 == 0, "n/a").otherwise(
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("0000Z"))
        ),
        "event_id": _windows_event_id(),
        "user": F.when(k % 50 == 1, "").when(k % 50 == 2, "-").otherwise(c("user")),
        "domain": F.lit("LAB"),
        "src_ip": _windows_address(),
        "host": F.when(c("uid") % 3 != 0, c("host")),
        "logon_type": _logon_type(),
        "auth_method": F.lit("NTLM"),
        "provider_name": F.lit("Security-Auditing"),
        "raw_message": F.when(k % 2 == 1, "logon\r\nattempt").otherwise(""),
        "record_id": c("id").cast("string"),
    }
    line = _json_line(entries)
    return source_rows(spark, sf_dir).select(
        F.when(k % 3 != 0, line).otherwise("").alias("message"), line.alias("stdout")
    )


def raw_windows_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log rows as the exporter sees them: system columns and the EventData XML."""
    c, k = F.col, F.col("k")

    def data(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'<Data Name="{name}">'), value, F.lit("</Data>"))

    blank = F.lit("")
    xml = F.concat(
        F.lit("<Event><System><Channel>Security</Channel></System><EventData>"),
        data("TargetUserName", F.when(k % 4 == 1, blank).when(k % 50 == 2, "-").otherwise(c("user"))),
        data("SubjectUserName", F.when(k % 20 == 1, blank).otherwise(F.concat(F.lit("svc-"), c("host")))),
        data("TargetDomainName", F.when(k % 5 == 0, blank).otherwise("LAB")),
        data("SubjectDomainName", F.lit("CORP")),
        data("AuthenticationPackageName", F.when(k % 3 == 0, blank).otherwise("NTLM")),
        data("LogonProcessName", F.lit("NtLmSsp")),
        data("LogonType", _logon_type()),
        data("IpAddress", c("ip")),
        F.lit("<Data>unnamed</Data></EventData></Event>"),
    )
    return source_rows(spark, sf_dir).select(
        c("ts").alias("time_created"),
        _windows_event_id().alias("event_id"),
        c("host").alias("machine_name"),
        F.lit("Security-Auditing").alias("provider_name"),
        F.concat(F.lit(" logon\r\nevent "), c("id")).alias("message"),
        c("id").alias("record_id"),
        xml.alias("xml"),
    )


def raw_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire envelopes with every kind of field value, and some that must be rejected."""
    c, k = F.col, F.col("k")
    ts = (
        F.when(k == 96, "")
        .when(k == 95, "2024")
        .when(k % 4 == 0, ms_text(c("ts")))
        .when(k % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(k % 4 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
    )
    fields = F.concat(
        F.lit('{"user":"'), c("user"), F.lit('","attempt":'), k, F.lit(',"ratio":'),
        c("value").cast("decimal(18,2)"), F.lit(',"flag":'), (k % 2 == 0).cast("string"),
        F.lit(',"none":null,"":"blank","whole":1.0,"big":1e3,'
              '"list":[1,-1e3,1.5e-7,2.5e300,12345678901234567890,"a -1e3"],'
              '"nested":{"z":1,"a":"<b>"}}'),
    )
    good = F.concat(
        F.lit('{"ts":"'), ts, F.lit('","platform":'), F.when(k == 94, "5").otherwise('"linux"'),
        F.lit(',"ingest_source":"vector-syslog","message":"heartbeat '), c("et"),
        F.lit('","extra":[1,2]'),
        F.when(k % 10 == 3, "").otherwise(F.concat(F.lit(',"fields":'), fields)), F.lit("}"),
    )
    return source_rows(spark, sf_dir).select(
        c("id"), F.when(k == 97, F.concat(F.lit("{cut "), c("id"))).otherwise(good).alias("value")
    )
