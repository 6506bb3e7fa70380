"""Checks of a configuration before anything runs."""

from __future__ import annotations

from ..functions.idents import parse_table
from ..functions.transforms import TRANSFORMS
from .config import CURSOR_TYPES, GRANULARITIES, MODES, SOURCE_TYPES, WATERMARK_TYPES, WRITE_MODES, Config, ConfigError, Job, Retry


def _one_of(where: str, name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ConfigError(f"{where}: {name} '{value}' is not one of {', '.join(allowed)}")


def _retry(where: str, retry: Retry) -> None:
    if retry.max_attempts < 1 or retry.initial_delay_ms < 0 or retry.backoff_multiplier < 0:
        raise ConfigError(f"{where}: retry needs max_attempts of 1 or more and no negative delay")


def _job(config: Config, job: Job) -> None:
    where = f"Job '{job.name}'"
    for kind, name, known in (("source", job.source, config.sources), ("destination", job.destination, config.destinations)):
        if name not in known:
            raise ConfigError(f"{where}: unknown {kind} '{name}'")
    if job.depends_on is not None and job.depends_on not in {j.name for j in config.sync_jobs}:
        raise ConfigError(f"{where}: depends_on unknown job '{job.depends_on}'")
    _one_of(where, "mode", job.mode, MODES)
    _one_of(where, "write_mode", job.write_mode, WRITE_MODES)
    _one_of(where, "watermark_type", job.watermark_type, WATERMARK_TYPES)
    _one_of(where, "cursor_type", job.cursor_type, CURSOR_TYPES)
    _one_of(where, "commit_granularity", job.commit_granularity, GRANULARITIES)
    if job.commit_granularity == "batch" and job.write_mode != "append":
        raise ConfigError(f"{where}: commits by batch are for append only")
    if job.commit_granularity == "batch" and not job.cursor_column:
        raise ConfigError(f"{where}: commits by batch need a cursor_column")
    if job.mode == "full" and job.cursor_column:
        raise ConfigError(f"{where}: cursor_column can't be used with mode 'full'")
    if job.write_mode == "overwrite" and not (job.partition_column or job.iceberg_partition):
        raise ConfigError(f"{where}: write_mode 'overwrite' needs partition_column or iceberg_partition")
    if job.write_mode in ("upsert", "merge_into") and not (job.merge and job.merge.key_columns):
        raise ConfigError(f"{where}: write_mode '{job.write_mode}' needs merge.key_columns")
    if job.parallel_read and (job.parallel_read.connections < 1 or job.parallel_read.lowest >= job.parallel_read.highest):
        raise ConfigError(f"{where}: parallel_read needs a connection or more and lowest below highest")
    if job.iceberg_partition:
        _one_of(where, "partition transform", job.iceberg_partition.transform, TRANSFORMS)
    if job.batch_size < 1:
        raise ConfigError(f"{where}: batch_size must be 1 or more")
    if job.retry:
        _retry(where, job.retry)
    try:
        parse_table(job.full_name)
    except ValueError as error:
        raise ConfigError(f"{where}: {error}") from error


def _cycles(config: Config) -> None:
    parent = {j.name: j.depends_on for j in config.sync_jobs}
    for name in parent:
        seen, at = {name}, parent[name]
        while at is not None:
            if at in seen:
                raise ConfigError(f"Cyclic depends_on at job '{at}'")
            seen.add(at)
            at = parent[at]


def validate(config: Config) -> None:
    names = [j.name for j in config.sync_jobs]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ConfigError(f"Job name(s) used twice: {', '.join(twice)}")
    for name, source in config.sources.items():
        _one_of(f"Source '{name}'", "type", source.type, SOURCE_TYPES)
    for name, destination in config.destinations.items():
        if not (destination.warehouse or destination.catalog_uri):
            raise ConfigError(f"Destination '{name}': needs warehouse or catalog_uri")
    _retry("Config", config.retry)
    for job in config.sync_jobs:
        _job(config, job)
    _cycles(config)
    for binding in config.rabbitmq.queues if config.rabbitmq else ():
        if binding.job not in names:
            raise ConfigError(f"Queue '{binding.queue}': unknown job '{binding.job}'")
