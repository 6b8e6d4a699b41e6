"""The windowed login detections.

All rules read the same *login facts*: one row per (window, tick, user, source, host,
kind, lane) with failure counts and first/last times. Facts are mergeable, come from one
scan and one shuffle, and a hot entity is combined on the map side before that shuffle.
A rule then filters facts (burst, failed-then-success) or aggregates them once more
(spray, distributed, Windows). Outside the Windows lane facts are distinct per user and
source of a group, so counting rows gives exact distinct counts without another shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authlane import settings as S
from authlane.functions.times import (
    AsOf,
    as_of_col,
    sql_bucket_start,
    sql_ms_text,
    within,
)
from authlane.operators.rules import RuleConfig, meets_threshold, suppress
from authlane.schema import RULE_RESULT

# The logon type is part of the key, and set only in the Windows lane, where it is a small
# vocabulary: as a measure, a text minimum would turn the hash aggregation into a sort.
ENTITY = ["user", "src_ip", "host", "source_kind", "windows_lane", "logon_type"]
FACT_KEYS = ["window_minutes", "evaluated_at", *ENTITY]
SCOPE = ["window_minutes", "evaluated_at"]
SAMPLE_SIZE = 5
# A group's members are ranked in this many slices, so that no task sees a whole hot group.
SAMPLE_SLICES = 256


def login_rows(auth: DataFrame) -> DataFrame:
    return auth.filter(F.col("status").isin(S.STATUS_SUCCESS, S.STATUS_FAILURE)).selectExpr(
        "ts",
        "user",
        "src_ip",
        "host",
        "source_kind",
        f"ingest_source = '{S.LANE_WINDOWS}' AS windows_lane",
        f"status = '{S.STATUS_FAILURE}' AS failed",
        f"if(ingest_source = '{S.LANE_WINDOWS}', logon_type, '') AS logon_type",
    )


MEASURES = {
    "failures": "count_if(failed)",
    "first_failure": "min(ts) FILTER (WHERE failed)",
    "last_failure": "max(ts) FILTER (WHERE failed)",
    "first_success": "min(ts) FILTER (WHERE NOT failed)",
}
MERGES = {
    "failures": "sum(failures)",
    "first_failure": "min(first_failure)",
    "last_failure": "max(last_failure)",
    "first_success": "min(first_success)",
}


def aggregates(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"{sql} AS {name}") for name, sql in expressions.items()]


def fact_measures() -> list[Column]:
    return aggregates(MEASURES)


def shared_plan(facts: DataFrame) -> DataFrame:
    """Facts as one fixed plan for every rule that reads them.

    Each rule needs other columns and rows. Left alone, the optimizer would push those
    needs through the aggregation, so that no two rules scan and shuffle alike. ``inline``
    of a one-element array stops it: the rules of a pack then reuse a single exchange,
    and predicates on user and source do not run the message patterns a second time.
    """
    row = ", ".join(f"'{c}', {c}" for c in facts.columns)
    return facts.selectExpr(f"inline(array(named_struct({row})))")


def login_facts(
    auth: DataFrame, as_of: AsOf, windows: Iterable[int], where: str = "true"
) -> DataFrame:
    """Facts at one instant for each window length. Only the widest window is scanned, and
    of it only the rows ``where`` keeps."""
    lengths = sorted(set(windows))
    rows = login_rows(auth.filter(within(F.col("ts"), as_of, lengths[-1])).filter(where))
    if len(lengths) == 1:
        rows = rows.withColumn("window_minutes", F.lit(lengths[0]))
    else:
        covering = F.array(
            *[F.when(within(F.col("ts"), as_of, w), F.lit(w)) for w in lengths]
        )
        rows = rows.withColumn("window_minutes", F.explode(F.array_compact(covering)))
    facts = rows.groupBy("window_minutes", *ENTITY).agg(*fact_measures())
    return shared_plan(
        facts.withColumn("evaluated_at", as_of_col(as_of)).select(*FACT_KEYS, *MEASURES)
    )


def _failed_outside_windows(facts: DataFrame) -> DataFrame:
    return facts.filter("failures > 0 AND NOT windows_lane AND user <> '' AND src_ip <> ''")


def _result(df: DataFrame, config: RuleConfig, keep: Sequence[str] = (), **columns: str) -> DataFrame:
    """The 13 result columns, plus when the rule was evaluated, and columns to ``keep``."""
    columns["window_bucket"] = sql_bucket_start(columns["window_end"], config.window_minutes)
    return df.selectExpr(
        *[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in RULE_RESULT],
        "evaluated_at",
        *keep,
    )


def _json(**values: str) -> str:
    pairs = ", ".join(f"'{key}', {sql}" for key, sql in values.items())
    return f"to_json(named_struct({pairs}))"


def failed_login_burst(facts: DataFrame, config: RuleConfig) -> DataFrame:
    """Failures of one account from one source on one Linux host."""
    rows = _failed_outside_windows(facts).filter(F.col("source_kind") == S.KIND_LINUX)
    minutes = config.window_minutes
    return _result(
        suppress(rows, config, "host", "user"),
        config,
        hits="failures",
        principal="user",
        source_ip="src_ip",
        endpoint_id="host",
        window_start="first_failure",
        window_end="last_failure",
        distinct_user_count="1",
        distinct_ip_count="1",
        source_kind="source_kind",
        reason="concat('Repeated failed logins for account ', user, ' from ', src_ip, ' on ', host)",
        evidence_summary=f"concat(failures, ' failed attempts within {minutes} minutes')",
        details=_json(
            principal="user",
            source_ip="src_ip",
            endpoint_id="host",
            failed_attempts="failures",
            window_minutes=str(minutes),
        ),
    )


def failed_then_success(facts: DataFrame, config: RuleConfig) -> DataFrame:
    """Enough failures, and no success before the last of them: a success ahead of any
    failure in the window, or a failure after the first success, rules the group out."""
    # A threshold of zero admits groups without failures, whose times read as the epoch.
    rows = facts.filter(
        f"NOT windows_lane AND user <> '' AND src_ip <> '' AND failures >= {config.threshold_failures} "
        "AND first_success >= ifnull(last_failure, timestamp_seconds(0))"
    ).withColumn("first_failure", F.expr("ifnull(first_failure, timestamp_seconds(0))"))
    return _result(
        suppress(rows, config, "host", "user"),
        config,
        hits="failures",
        principal="user",
        source_ip="src_ip",
        endpoint_id="host",
        window_start="first_failure",
        window_end="first_success",
        distinct_user_count="1",
        distinct_ip_count="1",
        source_kind="source_kind",
        reason="concat('Successful login followed repeated failures for ', user, ' from ', src_ip,"
        " ' on ', host)",
        evidence_summary="concat(failures, ' failed attempts before success within "
        f"{config.window_minutes} minutes')",
        details=_json(
            principal="user",
            source_ip="src_ip",
            endpoint_id="host",
            failed_attempts="failures",
            first_failure=sql_ms_text("first_failure"),
            first_success=sql_ms_text("first_success"),
        ),
    )


def _members(facts: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Per group: exact number of distinct members, attempts, span, and the first few
    members in order. Facts are distinct per member of a group, so rows are counted.

    Members are ranked within hash slices of a group and only a slice's first few are
    collected, so a group's array holds at most SAMPLE_SLICES * SAMPLE_SIZE entries
    however many members it has, and one of its slices is the most a task sorts.
    """
    keys = [*SCOPE, *group]
    return (
        _ranked(facts, keys, member)
        .groupBy(*keys)
        .agg(
            F.expr("count(*) AS members"),
            F.expr("sum(failures) AS failures"),
            F.expr("min(first_failure) AS first_failure"),
            F.expr("max(last_failure) AS last_failure"),
            F.expr(f"collect_set({member}) FILTER (WHERE rank <= {SAMPLE_SIZE}) AS candidates"),
        )
        .withColumn("sample", F.expr(_sample_text("candidates")))
    )


def _ranked(rows: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    sliced = rows.withColumn("slice", F.expr(f"pmod(xxhash64({member}), {SAMPLE_SLICES})"))
    rank = F.row_number().over(Window.partitionBy(*keys, "slice").orderBy(member))
    return sliced.withColumn("rank", rank)


def _sample_text(members: str) -> str:
    return f"array_join(slice(array_sort({members}), 1, {SAMPLE_SIZE}), ', ')"


def first_members(rows: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Per group of ``keys``: its first few members in order, as one text ``sample``. Rows
    are distinct per member of a group; all but a slice's first few go before they are sent."""
    first = _ranked(rows, keys, member).filter(F.col("rank") <= SAMPLE_SIZE)
    return first.groupBy(*keys).agg(F.expr(f"{_sample_text(f'collect_set({member})')} AS sample"))


SPRAY_GROUP, SPRAY_MEMBER = ["src_ip", "host", "source_kind"], "user"
DISTRIBUTED_GROUP, DISTRIBUTED_MEMBER = ["user", "host", "source_kind"], "src_ip"


def spray_having(config: RuleConfig) -> str:
    return f"members >= {config.threshold_distinct_users} AND failures >= {config.threshold_attempts}"


def distributed_having(config: RuleConfig) -> str:
    return f"members >= {config.threshold_distinct_ips} AND failures >= {config.threshold_attempts}"


def password_spray(facts: DataFrame, config: RuleConfig) -> DataFrame:
    """One source failing against several accounts of a host."""
    rows = suppress(_failed_outside_windows(facts), config, "host", "user")
    return spray_result(_members(rows, SPRAY_GROUP, SPRAY_MEMBER).filter(spray_having(config)), config)


def spray_result(groups: DataFrame, config: RuleConfig, keep: Sequence[str] = ()) -> DataFrame:
    return _result(
        groups,
        config,
        keep,
        hits="failures",
        principal="''",
        source_ip="src_ip",
        endpoint_id="host",
        window_start="first_failure",
        window_end="last_failure",
        distinct_user_count="members",
        distinct_ip_count="1",
        source_kind="source_kind",
        reason="concat('Source ', src_ip, ' targeted multiple usernames on ', host)",
        evidence_summary="concat(members, ' usernames targeted across ', failures,"
        " ' failed attempts. Examples: ', sample)",
        details=_json(
            source_ip="src_ip",
            endpoint_id="host",
            targeted_users="members",
            failed_attempts="failures",
            sampled_users="sample",
        ),
    )


def distributed_attack(facts: DataFrame, config: RuleConfig) -> DataFrame:
    """One account failing from several sources on a host."""
    rows = suppress(_failed_outside_windows(facts), config, "host", "user")
    groups = _members(rows, DISTRIBUTED_GROUP, DISTRIBUTED_MEMBER).filter(distributed_having(config))
    return distributed_result(groups, config)


def distributed_result(groups: DataFrame, config: RuleConfig, keep: Sequence[str] = ()) -> DataFrame:
    return _result(
        groups,
        config,
        keep,
        hits="failures",
        principal="user",
        source_ip="''",
        endpoint_id="host",
        window_start="first_failure",
        window_end="last_failure",
        distinct_user_count="1",
        distinct_ip_count="members",
        source_kind="source_kind",
        reason="concat('Account ', user, ' saw failed logins from multiple source IPs on ', host)",
        evidence_summary="concat(members, ' source IPs across ', failures,"
        " ' failed attempts. Examples: ', sample)",
        details=_json(
            principal="user",
            endpoint_id="host",
            source_count="members",
            failed_attempts="failures",
            sampled_sources="sample",
        ),
    )


def windows_failed_logon_burst(facts: DataFrame, config: RuleConfig) -> DataFrame:
    """Failed logons of one Windows endpoint. Samples are the smallest non-blank value,
    so that a rerun gives the same alert."""
    groups = (
        windows_rows(facts, config)
        .withColumns({"user": F.expr("nullif(user, '')"), "src_ip": F.expr("nullif(src_ip, '')")})
        .groupBy(*SCOPE, "endpoint")
        .agg(
            F.expr("sum(failures) AS failures"),
            F.expr("ifnull(min(user), '') AS sample_user"),
            F.expr("ifnull(min(src_ip), '') AS sample_source_ip"),
            F.expr("ifnull(min(nullif(logon_type, '')), '') AS sample_logon_type"),
            F.expr("count(DISTINCT user) AS users"),
            F.expr("count(DISTINCT src_ip) AS sources"),
            F.expr("min(first_failure) AS first_failure"),
            F.expr("max(last_failure) AS last_failure"),
        )
    )
    return windows_result(groups, config)


def windows_rows(facts: DataFrame, config: RuleConfig) -> DataFrame:
    rows = facts.filter("windows_lane AND failures > 0").withColumn(
        "endpoint", F.expr("ifnull(nullif(host, ''), 'unknown')")
    )
    return suppress(rows, config, "endpoint", "user")


def windows_result(groups: DataFrame, config: RuleConfig, keep: Sequence[str] = ()) -> DataFrame:
    minutes = config.window_minutes
    return _result(
        groups,
        config,
        keep,
        hits="failures",
        principal="sample_user",
        source_ip="sample_source_ip",
        endpoint_id="endpoint",
        window_start="first_failure",
        window_end="last_failure",
        distinct_user_count="users",
        distinct_ip_count="sources",
        source_kind=f"'{S.KIND_WINDOWS}'",
        reason="concat('Repeated Windows failed logons detected on ', endpoint)",
        evidence_summary=f"concat(failures, ' failed logons within {minutes} minutes')",
        details=_json(
            endpoint_id="endpoint",
            sample_user="sample_user",
            sample_source_ip="sample_source_ip",
            sample_logon_type="sample_logon_type",
            failed_attempts="failures",
            window_minutes=str(minutes),
        ),
    )


Rule = Callable[[DataFrame, RuleConfig], DataFrame]

BUILTIN_RULES: dict[str, Rule] = {
    "security_failed_login_burst": failed_login_burst,
    "security_failed_then_success": failed_then_success,
    "security_source_multi_user_burst": password_spray,
    "security_user_multi_source_burst": distributed_attack,
    "windows_failed_logon_burst": windows_failed_logon_burst,
}

# What ranks first when only the top groups of a rule are reported.
RANK = {
    "security_source_multi_user_burst": ["distinct_user_count", "hits", "window_end"],
    "security_user_multi_source_burst": ["distinct_ip_count", "hits", "window_end"],
}
DEFAULT_RANK = ["hits", "window_end"]
TIEBREAK = ["principal", "source_ip", "endpoint_id", "source_kind"]


def rank_order(rule_id: str) -> list[Column]:
    """A total order: the rule's ranking, then the group's own key."""
    return [F.col(c).desc() for c in RANK.get(rule_id, DEFAULT_RANK)] + [
        F.col(c).asc() for c in TIEBREAK
    ]


def top_groups(result: DataFrame, rule_id: str, n: int | None, per_tick: bool = False) -> DataFrame:
    """The first ``n`` groups (None keeps all), over the result or per evaluation tick."""
    if n is None:
        return result
    if not per_tick:
        return result.orderBy(*rank_order(rule_id)).limit(n)
    rank = F.row_number().over(Window.partitionBy("evaluated_at").orderBy(*rank_order(rule_id)))
    return result.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def evaluate(
    facts: DataFrame, config: RuleConfig, top_n: int | None = None, per_tick: bool = False
) -> DataFrame:
    """One rule over shared facts: qualifying groups, top-n, then the hits threshold."""
    mine = facts.filter(F.col("window_minutes") == config.window_minutes)
    groups = BUILTIN_RULES[config.id](mine, config)
    return top_groups(groups, config.id, top_n, per_tick).filter(
        meets_threshold(F.col("hits"), config.threshold_op, config.threshold_value)
    )


_FAILURES = f"status = '{S.STATUS_FAILURE}'"
_NOT_WINDOWS = f"ingest_source <> '{S.LANE_WINDOWS}'"

# The login events a rule can use, for running it alone: tested before anything is grouped.
RULE_INPUT = {
    "security_failed_login_burst": (
        f"{_FAILURES} AND {_NOT_WINDOWS} AND source_kind = '{S.KIND_LINUX}'"
    ),
    "security_failed_then_success": _NOT_WINDOWS,
    "security_source_multi_user_burst": f"{_FAILURES} AND {_NOT_WINDOWS}",
    "security_user_multi_source_burst": f"{_FAILURES} AND {_NOT_WINDOWS}",
    "windows_failed_logon_burst": f"{_FAILURES} AND ingest_source = '{S.LANE_WINDOWS}'",
}


def detect(
    auth: DataFrame, config: RuleConfig, as_of: AsOf = None, top_n: int | None = None
) -> DataFrame:
    """One rule over login events at one instant: the 13 result columns."""
    facts = login_facts(auth, as_of, [config.window_minutes], RULE_INPUT[config.id])
    return evaluate(facts, config, top_n).select(*RULE_RESULT.names)
