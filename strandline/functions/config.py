"""Job and service settings with their checks; YAML in, dataclasses out."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from .times import ENCODINGS

RESERVED = {"dt", "__dt"}


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Job:
    name: str
    table: str
    prefix: str
    cursor: str = "id"
    time_column: str = "created_at"
    encoding: str = "datetime"
    tz: str = "UTC"
    export_rows: int = 500_000
    delete_rows: int = 5_000
    delete_sleep_ms: int = 200
    safety_lag_seconds: int = 5
    guard: bool = True
    retain_seconds: int = 86_400
    verify: bool = True
    interval_seconds: int = 300
    compact_at: str = "03:00"
    purge_interval_seconds: int | None = None

    def __post_init__(self) -> None:
        for name in (self.cursor, self.time_column):
            if not re.fullmatch(r"[A-Za-z_]\w*", name) or name in RESERVED:
                raise ConfigError(f"{self.name}: bad column name {name!r}")
        if not re.fullmatch(r"[\w-]+", self.name):
            raise ConfigError(f"bad job name {self.name!r}")
        if self.encoding not in ENCODINGS:
            raise ConfigError(f"{self.name}: unknown time encoding {self.encoding!r}")
        if not re.fullmatch(r"([01]\d|2[0-3]):[0-5]\d", self.compact_at):
            raise ConfigError(f"{self.name}: compact_at is not HH:MM")
        if not self.prefix.strip("/") or any(p in (".", "..") or re.search(r"[*?\[\]{}]", p) for p in self.prefix.split("/")):
            raise ConfigError(f"{self.name}: bad prefix")
        try:
            ZoneInfo(self.tz)
        except Exception as e:
            raise ConfigError(f"{self.name}: unknown zone {self.tz!r}") from e
        for n in ("export_rows", "delete_rows", "interval_seconds"):
            if getattr(self, n) < 1:
                raise ConfigError(f"{self.name}: {n} must be positive")


@dataclass(frozen=True)
class QueryApi:
    enabled: bool = False
    listen: str = "127.0.0.1:8080"
    keys: tuple[str, ...] = ()
    max_rows: int = 100_000
    timeout_seconds: float = 60.0

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[^:]*:\d{1,5}", self.listen):
            raise ConfigError("listen is not host:port")
        if self.enabled and not self.keys:
            raise ConfigError("an enabled query service needs keys")


@dataclass(frozen=True)
class Config:
    jobs: tuple[Job, ...]
    query_api: QueryApi = field(default_factory=QueryApi)

    def __post_init__(self) -> None:
        names = [j.name for j in self.jobs]
        places = [j.prefix.rstrip("/").lower() for j in self.jobs]
        if len(set(names)) < len(names):
            raise ConfigError("job names repeat")
        if len(set(places)) < len(places):
            raise ConfigError("two jobs share a prefix: their high-water marks would mix")

    def job(self, name: str) -> Job:
        for j in self.jobs:
            if j.name == name:
                return j
        raise ConfigError(f"no job {name!r}")


def from_dict(raw: dict) -> Config:
    known = {"jobs", "query_api"}
    if set(raw) - known:
        raise ConfigError(f"unknown keys: {sorted(set(raw) - known)}")
    try:
        api = dict(raw.get("query_api") or {})
        api["keys"] = tuple(api.get("keys", ()))
        return Config(tuple(Job(**j) for j in raw.get("jobs", [])), QueryApi(**api))
    except TypeError as e:
        raise ConfigError(str(e)) from None


def load(path: str | None = None) -> Config:
    """From ``path``, else the file that ARCHIVE_CONFIG names; the file's text is never echoed."""
    import yaml

    path = path or os.environ.get("ARCHIVE_CONFIG")
    if not path:
        raise ConfigError("no configuration file given")
    try:
        with open(path) as f:
            raw = yaml.safe_load(f)
    except yaml.YAMLError:
        raise ConfigError("the configuration is not valid YAML") from None
    return from_dict(raw or {})
