"""Rule configuration, suppression and thresholds."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Threshold operators.
THRESHOLD_OPS = {
    "gt": lambda hits, value: hits > value,
    "gte": lambda hits, value: hits >= value,
    "eq": lambda hits, value: hits == value,
    "lt": lambda hits, value: hits < value,
    "lte": lambda hits, value: hits <= value,
}


# Result columns that suppression lists can name.
SUPPRESSION_COLUMNS = ("principal", "source_ip", "endpoint_id", "source_kind")


class RuleConfigError(ValueError):
    """A rule that cannot run; the pack reports and skips it."""


def suppression_list(csv: str) -> list[str]:
    """Comma list to lower-cased, trimmed, distinct, non-blank entries."""
    entries = (part.strip().lower() for part in csv.split(","))
    return list(dict.fromkeys(e for e in entries if e))


def suppression_column(key: str, expression: str) -> str:
    """The result column a list is compared with, from its expression: a lower-cased result
    column, or an empty text, which matches nothing. Anything else cannot run."""
    text = expression.strip("\"").strip()
    if text in ("", "''"):
        return ""
    found = re.fullmatch(r"lower(?:UTF8)?\(\s*(\w+)\s*\)", text)
    if not found or found[1] not in SUPPRESSION_COLUMNS:
        raise RuleConfigError(f"{key} is not a result column in lower case")
    return found[1]


@dataclass(frozen=True)
class RuleConfig:
    id: str
    name: str
    alert_type: str = ""
    severity: str = "medium"
    threshold_op: str = "gte"
    threshold_value: int = 1
    window_minutes: int = 5
    cooldown_seconds: int = 0
    threshold_attempts: int | None = None
    threshold_distinct_users: int | None = None
    threshold_distinct_ips: int | None = None
    threshold_failures: int | None = None
    suppression_computers: tuple[str, ...] = ()
    suppression_users: tuple[str, ...] = ()
    # The result column each list is compared with; '' compares with nothing.
    suppression_computer_by: str = "endpoint_id"
    suppression_user_by: str = "principal"
    # False where the rule has no single principal to compare: the user list then never matches.
    suppress_by_user: bool = True

    def __post_init__(self) -> None:
        if not self.id:
            raise RuleConfigError("missing id")
        if not self.name:
            raise RuleConfigError("missing name")
        if not self.alert_type:
            object.__setattr__(self, "alert_type", self.id)
        for key in (
            "threshold_attempts", "threshold_distinct_users", "threshold_distinct_ips",
            "threshold_failures",
        ):
            if getattr(self, key) is None:
                object.__setattr__(self, key, self.threshold_value)
        for key in (
            "threshold_value", "window_minutes", "cooldown_seconds", "threshold_attempts",
            "threshold_distinct_users", "threshold_distinct_ips", "threshold_failures",
        ):
            value = getattr(self, key)
            if not isinstance(value, int) or isinstance(value, bool) or value < 0:
                raise RuleConfigError(f"{key} must be a non-negative integer")
        if self.window_minutes == 0:
            raise RuleConfigError("window_minutes must not be zero")

    @classmethod
    def from_mapping(cls, raw: Mapping[str, object]) -> RuleConfig:
        """Build from flat key/value settings as they stand in a rule file. A blank
        value means the default."""
        given = {k: str(v).strip() for k, v in raw.items() if v is not None and str(v).strip()}
        out: dict[str, object] = {"id": given.get("id", ""), "name": given.get("name", "")}
        for key in ("alert_type", "severity", "threshold_op"):
            if key in given:
                out[key] = given[key]
        for key in (
            "threshold_value", "window_minutes", "cooldown_seconds", "threshold_attempts",
            "threshold_distinct_users", "threshold_distinct_ips", "threshold_failures",
        ):
            if key in given:
                if not re.fullmatch(r"[0-9]+", given[key]):
                    raise RuleConfigError(f"{key} must be a non-negative integer")
                out[key] = int(given[key])
        out["suppression_computers"] = tuple(
            suppression_list(given.get("suppression_computers_csv", ""))
        )
        out["suppression_users"] = tuple(suppression_list(given.get("suppression_users_csv", "")))
        for key, column in (("suppression_computer_expr", "suppression_computer_by"), ("suppression_user_expr", "suppression_user_by")):
            if key in given:
                out[column] = suppression_column(key, given[key])
        out["suppress_by_user"] = out.get("suppression_user_by") != ""
        return cls(**out)  # type: ignore[arg-type]

    def with_(self, **changes: object) -> RuleConfig:
        return replace(self, **changes)  # type: ignore[arg-type]

    @property
    def parameter_text(self) -> str:
        """What ran, for the alert's ``query`` column of a built-in rule."""
        return (
            f"{self.id}(window_minutes={self.window_minutes}, "
            f"attempts={self.threshold_attempts}, users={self.threshold_distinct_users}, "
            f"ips={self.threshold_distinct_ips}, failures={self.threshold_failures})"
        )


# The shipped rule pack.
RULE_PACK = (
    RuleConfig(
        id="security_failed_login_burst",
        name="Security Failed Login Burst",
        alert_type="failed_login_burst",
        severity="medium",
        threshold_value=5,
        window_minutes=5,
        cooldown_seconds=300,
    ),
    RuleConfig(
        id="security_failed_then_success",
        name="Failed Then Success",
        alert_type="fail_then_success",
        severity="high",
        threshold_value=3,
        threshold_failures=3,
        window_minutes=15,
        cooldown_seconds=300,
    ),
    RuleConfig(
        id="security_source_multi_user_burst",
        name="Password Spray",
        alert_type="password_spray",
        severity="high",
        threshold_value=4,
        threshold_attempts=4,
        threshold_distinct_users=3,
        window_minutes=10,
        cooldown_seconds=300,
        suppress_by_user=False,
    ),
    RuleConfig(
        id="security_user_multi_source_burst",
        name="Distributed Attack",
        alert_type="distributed_attack",
        severity="high",
        threshold_value=4,
        threshold_attempts=4,
        threshold_distinct_ips=3,
        window_minutes=10,
        cooldown_seconds=300,
    ),
    RuleConfig(
        id="windows_failed_logon_burst",
        name="Windows Failed Logon Burst",
        alert_type="windows_failed_logon_burst",
        severity="medium",
        threshold_value=5,
        window_minutes=5,
        cooldown_seconds=300,
        suppress_by_user=False,
    ),
)


def load_rules(
    settings: Iterable[Mapping[str, object]],
) -> tuple[list[RuleConfig], list[tuple[str, str]]]:
    """Valid configs, and (id, reason) of the skipped ones. The first config of an id wins."""
    configs: dict[str, RuleConfig] = {}
    skipped: list[tuple[str, str]] = []
    for raw in settings:
        try:
            config = RuleConfig.from_mapping(raw)
            configs.setdefault(config.id, config)
        except RuleConfigError as e:
            skipped.append((str(raw.get("id") or ""), str(e)))
    return list(configs.values()), skipped


def suppress(df: DataFrame, config: RuleConfig, computer: str, user: str | None) -> DataFrame:
    """Drop rows of suppressed computers and users before anything is counted.

    ``computer`` and ``user`` are the columns of ``df`` that become endpoint and principal.
    """
    column = {
        "endpoint_id": computer, "principal": user, "source_ip": "src_ip", "source_kind": "source_kind",
    }
    for entries, by in (
        (config.suppression_computers, config.suppression_computer_by),
        (config.suppression_users, config.suppression_user_by if config.suppress_by_user else ""),
    ):
        if entries and column.get(by):
            df = df.filter(~F.lower(F.col(column[by])).isin(*entries))
    return df


def suppress_listed(df: DataFrame, column: str, entries: DataFrame) -> DataFrame:
    """Suppression by a table with one column of entries, for lists too long for a config."""
    listed = entries.select(F.lower(F.trim(entries[entries.columns[0]])).alias("_entry"))
    listed = listed.filter(F.col("_entry") != "")
    return df.join(listed, F.lower(df[column]) == listed["_entry"], "left_anti")


def meets_threshold(hits: Column, op: str, value: int) -> Column:
    """An unknown operator never fires."""
    compare = THRESHOLD_OPS.get(op)
    return compare(hits, F.lit(value)) if compare else F.lit(False)


def is_disabled(enabled: Column) -> Column:
    return F.lower(F.regexp_replace(enabled, r"\s", "")).isin("false", "0", "no")


def enabled_rules(rules: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """Rules (``id``) without those whose metadata (``id``, ``enabled``) disables them.
    No metadata row, or no metadata at all, leaves a rule enabled."""
    if metadata is None:
        return rules
    disabled = metadata.filter(is_disabled(F.col("enabled"))).select("id")
    return rules.join(disabled, "id", "left_anti")


def resolve_rules(rules: DataFrame, configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules joined with their config on ``id``, and the rules that have none."""
    return rules.join(configs, "id"), rules.join(configs, "id", "left_anti")


def enabled_configs(
    configs: Iterable[RuleConfig], metadata: Mapping[str, object] | None
) -> list[RuleConfig]:
    """The same choice on a config list: ``metadata`` maps rule id to its enabled value."""
    off = {
        rule_id
        for rule_id, value in (metadata or {}).items()
        if re.sub(r"\s", "", str(value)).lower() in ("false", "0", "no")
    }
    return [c for c in configs if c.id not in off]
