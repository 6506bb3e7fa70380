"""The YAML configuration of sync jobs."""

from __future__ import annotations

import typing
from dataclasses import MISSING, dataclass, field, fields
from typing import Any

import yaml

SOURCE_TYPES = ("postgres", "jdbc", "spark")
WRITE_MODES = ("append", "overwrite", "upsert", "merge_into")
MODES, WATERMARK_TYPES, CURSOR_TYPES, GRANULARITIES = ("incremental", "full"), ("timestamptz", "timestamp"), ("int", "text"), ("run", "batch")


class ConfigError(ValueError):
    """A configuration that can't be used."""


@dataclass(frozen=True)
class Retry:
    max_attempts: int = 3
    initial_delay_ms: int = 500
    backoff_multiplier: float = 2.0


@dataclass(frozen=True)
class Source:
    type: str
    dsn: str = ""


@dataclass(frozen=True)
class Destination:
    """warehouse is the folder of tables; the other fields are those of an object-store catalog and fill it in when it is missing."""

    warehouse: str | None = None
    catalog_uri: str | None = None
    s3_endpoint: str | None = None
    region: str = "us-east-1"
    access_key_id: str | None = None
    secret_access_key: str | None = None
    session_token: str | None = None
    catalog_name: str = "default"


@dataclass(frozen=True)
class Partition:
    column: str
    transform: str = "day"


@dataclass(frozen=True)
class Merge:
    key_columns: list[str]
    hard_delete: bool = False
    order_by: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class SchemaEvolution:
    allow_add_columns: bool = False


@dataclass(frozen=True)
class ParallelRead:
    """Ranges of a number column that a database is read by, over several connections; rows outside go to the first and last."""

    column: str
    lowest: int
    highest: int
    connections: int


@dataclass(frozen=True)
class Job:
    name: str
    source: str
    destination: str
    namespace: str
    table: str
    sql: str
    group: str | None = None
    watermark_column: str | None = None
    watermark_type: str = "timestamptz"
    cursor_column: str | None = None
    cursor_type: str = "int"
    depends_on: str | None = None
    batch_size: int = 500
    mode: str = "incremental"
    schema_evolution: SchemaEvolution = field(default_factory=SchemaEvolution)
    retry: Retry | None = None
    write_mode: str = "append"
    partition_column: str | None = None
    iceberg_partition: Partition | None = None
    merge: Merge | None = None
    commit_granularity: str = "run"
    parallel_read: ParallelRead | None = None

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.table}"


@dataclass(frozen=True)
class Queue:
    queue: str
    job: str
    dead_letter_exchange: str | None = None


@dataclass(frozen=True)
class Queues:
    uri: str
    queues: list[Queue]


@dataclass(frozen=True)
class Config:
    sources: dict[str, Source]
    destinations: dict[str, Destination]
    sync_jobs: list[Job]
    retry: Retry = field(default_factory=Retry)
    rabbitmq: Queues | None = None

    def job(self, name: str) -> Job:
        for job in self.sync_jobs:
            if job.name == name:
                return job
        raise ConfigError(f"Job '{name}' not found")

    def retry_for(self, job: Job) -> Retry:
        return job.retry or self.retry


def _read(kind: Any, value: Any, where: str) -> Any:
    """A YAML value as a value of an annotated type; what does not fit is an error that names the place."""
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if type(None) in args:
        return None if value is None else _read(next(a for a in args if a is not type(None)), value, where)
    if origin is list:
        if not isinstance(value, list):
            raise ConfigError(f"{where}: must be a list")
        return [_read(args[0], v, f"{where}[{i}]") for i, v in enumerate(value)]
    if origin is dict:
        if not isinstance(value, dict):
            raise ConfigError(f"{where}: must be a mapping")
        return {str(k): _read(args[1], v, f"{where}.{k}") for k, v in value.items()}
    if hasattr(kind, "__dataclass_fields__"):
        if not isinstance(value, dict):
            raise ConfigError(f"{where}: must be a mapping")
        hints, out = typing.get_type_hints(kind), {}
        for f in fields(kind):
            if f.name in value and (value[f.name] is not None or type(None) in typing.get_args(hints[f.name])):
                out[f.name] = _read(hints[f.name], value[f.name], f"{where}.{f.name}")
            elif f.default is MISSING and f.default_factory is MISSING:
                raise ConfigError(f"{where}: missing field '{f.name}'")
        return kind(**out)
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
        raise ConfigError(f"{where}: must be of type {kind.__name__}")
    return value


def parse(text: str) -> Config:
    """A validated configuration from YAML text. Unknown fields are ignored."""
    from .validation import validate

    try:
        found = yaml.safe_load(text)
    except yaml.YAMLError as error:
        raise ConfigError(f"Invalid YAML: {error}") from error
    config = _read(Config, found, "config")
    validate(config)
    return config


def load(path: str) -> Config:
    try:
        with open(path, encoding="utf-8") as file:
            text = file.read()
    except OSError as error:
        raise ConfigError(f"Cannot read config '{path}': {error}") from error
    return parse(text)
