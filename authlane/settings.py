"""Deployment settings and the fixed vocabularies of the data model."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Values that differ per deployment.

    ``namespace`` prefixes the contract version string, the simulator name and
    the Windows collector flavor, so an existing event table keeps its own
    strings by passing its own namespace.
    """

    namespace: str = "authlane"
    platform: str = "local-mvp"
    collector_name: str = "collector"
    environment_tag: str = "lab"

    @property
    def schema_version(self) -> str:
        return f"{self.namespace}.event.v1"

    @property
    def simulator_name(self) -> str:
        return f"{self.namespace}-sim"

    @property
    def windows_flavor(self) -> str:
        return f"{self.namespace}-collector-windows"

    @property
    def trigger_text(self) -> str:
        return f"Triggered by {self.namespace} detection service"


DEFAULT_SETTINGS = Settings()

# Ingest lanes.
LANE_PREFIX = "vector-"
LANE_SYSLOG = "vector-syslog"
LANE_FLUENT = "vector-fluent"
LANE_WINDOWS = "vector-windows-endpoint"
LANE_LINUX_SSH = "vector-linux-ssh"
LANE_SYNTHETIC = "synthetic-auth"

# Login vocabularies.
KIND_WINDOWS = "windows_auth"
KIND_LINUX = "linux_ssh"
STATUS_SUCCESS = "success"
STATUS_FAILURE = "failure"
LOGIN_EVENT_TYPES = ("login", "auth.login")
WINDOWS_EVENT_IDS = ("4624", "4625")
WINDOWS_LOGON_TYPES = ("2", "3", "10")

# Retention in days.
EVENT_RETENTION_DAYS = 7
ALERT_RETENTION_DAYS = 30
