"""Runs of sync jobs: a slice of the source by high-water mark, planned by write mode, committed with its properties.

A run makes one commit, which holds rows and high-water mark together; so a run that fails leaves nothing behind and
can be repeated, and an overwrite replaces what was there before the run, never its own earlier pages. Jobs with
commit_granularity `batch` (append only) commit page by page along the cursor instead: the high-water mark is held
back to the last page, and a repeated run goes on behind the cursor of the last committed page.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import write_modes as modes
from ..operators.paging import CURSOR, keyset_page, page_count, strip
from ..session import store_settings
from ..sources.catalog import Catalog
from ..sources.queries import Source, open_source
from ..sources.snapshot import CommitConflict, Metadata, SnapshotTable
from .config import Config, Job
from .scheduler import with_retry

log = logging.getLogger(__name__)
LAST_RUN_AT, LAST_RUN_ROWS, OPEN_CURSOR, OPEN_WATERMARK = "sync.last_run_at", "sync.last_run_rows", "sync.open_cursor", "sync.open_watermark"
EPOCH = datetime(1970, 1, 1)


def watermark_key(column: str) -> str:
    return f"sync.watermark.{column}"


@dataclass
class Summary:
    job: str
    rows_written: int
    rows_deleted: int
    pages: int
    watermark: datetime | None


class SyncEngine:
    def __init__(self, spark: SparkSession, config: Config, *, catalogs: dict[str, Catalog] | None = None, sources: dict[str, Source] | None = None, dry_run: bool = False):
        """catalogs and sources, by name, go before those that the configuration describes."""
        self.spark, self.config, self.dry_run = spark, config, dry_run
        self._catalogs, self._sources = dict(catalogs or {}), dict(sources or {})

    def catalog(self, name: str) -> Catalog:
        if name not in self._catalogs:
            found = self.config.destinations[name]
            store = store_settings(found.s3_endpoint, found.region, found.access_key_id, found.secret_access_key, found.session_token)
            for key, value in store.items():
                self.spark._jsc.hadoopConfiguration().set(key, value)
            self._catalogs[name] = Catalog(self.spark, found.warehouse or found.catalog_uri)
        return self._catalogs[name]

    def source(self, name: str) -> Source:
        if name not in self._sources:
            found = self.config.sources[name]
            self._sources[name] = open_source(self.spark, found.type, found.dsn)
        return self._sources[name]

    def run(self, job: Job, parameters: dict[str, Any] | None = None, properties: dict[str, str] | None = None) -> Summary:
        """A run with the job's retries; properties are committed to the target together with its rows."""
        return with_retry(self.config.retry_for(job), lambda: self.run_once(job, parameters, properties))

    # ---- one run ----

    def watermark(self, job: Job) -> datetime | None:
        """The high-water mark of the target; None if it has none, does not exist, or the job does without."""
        if job.mode == "full" or not job.watermark_column or not self.catalog(job.destination).exists(job.full_name):
            return None
        found = self.catalog(job.destination).load(job.full_name).metadata().properties.get(watermark_key(job.watermark_column))
        return datetime.fromisoformat(found).astimezone(UTC).replace(tzinfo=None) if found else None

    def _slice(self, job: Job, parameters: dict[str, Any] | None) -> DataFrame:
        bound = dict(parameters or {})
        mark, read = self.watermark(job) or EPOCH, job.parallel_read
        bound["watermark"] = mark.replace(tzinfo=UTC) if job.watermark_type == "timestamptz" else mark
        more = {"partition": (read.column, read.lowest, read.highest, read.connections)} if read else {}
        df = self.source(job.source).query(job.sql, bound, **more)
        if job.cursor_column:
            if job.cursor_column not in df.columns:
                raise ValueError(f"Job '{job.name}': cursor_column '{job.cursor_column}' is not in the select list")
            kind = df.schema[job.cursor_column].dataType
            if isinstance(kind, T.StringType) != (job.cursor_type == "text"):
                raise ValueError(f"Job '{job.name}': cursor_type is '{job.cursor_type}' but '{job.cursor_column}' is {kind.simpleString()}")
        if job.watermark_column and job.mode != "full" and job.watermark_column not in df.columns:
            raise ValueError(f"Job '{job.name}': watermark_column '{job.watermark_column}' is not in the select list")
        return strip(df, CURSOR)

    def _observed(self, job: Job, df: DataFrame) -> tuple[DataFrame, Observation]:
        """df, and the row count, highest mark and delete operations of what will have been read of it."""
        seen = Observation(f"sync {job.name}")
        mark = F.max(F.col(f"`{job.watermark_column}`").cast("timestamp_ntz").cast("string")) if job.watermark_column in df.columns else F.max(F.lit(None).cast("string"))
        deletes = F.count_if(modes.operation(F.col(modes.OP).cast("string")) == "D") if modes.OP in df.columns and job.write_mode == "merge_into" else F.count_if(F.lit(False))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), mark.alias("mark"), deletes.alias("deletes")), seen

    def _target(self, job: Job, df: DataFrame) -> SnapshotTable:
        """The target table, made from the batch's schema if it is not there, with new columns if the job allows them."""
        catalog = self.catalog(job.destination)
        schema = T.StructType([f for f in df.schema.fields if not (job.write_mode == "merge_into" and f.name == modes.OP)])
        if not catalog.exists(job.full_name):
            catalog.create_namespace(job.namespace)
            spec = job.iceberg_partition
            return catalog.create_table(job.full_name, schema, {"column": spec.column, "transform": spec.transform} if spec else None)[0]
        table = catalog.load(job.full_name)
        known = set(table.metadata().schema.fieldNames())
        for f in schema.fields:
            if f.name not in known and job.schema_evolution.allow_add_columns:
                table.add_column(f.name, f.dataType)
            elif f.name not in known:
                log.warning("Job '%s': column '%s' is not in '%s' and is left out", job.name, f.name, job.full_name)
        return table

    def run_once(self, job: Job, parameters: dict[str, Any] | None = None, properties: dict[str, str] | None = None) -> Summary:
        df = self._slice(job, parameters)
        if self.dry_run:
            rows = df.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
            return Summary(job.name, rows, 0, page_count(rows, job.batch_size), None)
        if job.commit_granularity == "batch":
            return self._run_by_batch(job, df, properties or {})
        if job.merge and job.merge.order_by:
            df = modes.latest(df, job.merge.key_columns, job.merge.order_by)
        exists = self.catalog(job.destination).exists(job.full_name)
        if not exists and df.isEmpty():
            return Summary(job.name, 0, 0, 1, None)
        table = self._target(job, df)
        planned_on = table.metadata()
        before = planned_on.snapshot.summary["total-records"] if planned_on.snapshot else 0
        observed, seen = self._observed(job, df)
        replaced, added = self._plan(job, table, planned_on, observed)
        rows, mark, deletes = seen.get["rows"], seen.get["mark"], seen.get["deletes"]
        if not rows:
            if properties:
                table.set_properties(properties)
            return Summary(job.name, 0, 0, 1, self.watermark(job))
        properties = {**(properties or {}), LAST_RUN_AT: datetime.now(UTC).isoformat(), LAST_RUN_ROWS: str(rows)}
        mark = datetime.fromisoformat(mark) if mark else None
        if job.watermark_column and mark:
            properties[watermark_key(job.watermark_column)] = mark.replace(tzinfo=UTC).isoformat()
        if replaced is None:
            table.commit_append(added, properties)
            deleted = 0
        else:
            after = sum(f.records for f in replaced)
            deleted = before + sum(f.records for f in added) - after if job.write_mode == "overwrite" and planned_on.partition else before + rows - deletes - after
            try:
                table.commit_replace(planned_on, replaced, added, deleted, properties)
            except CommitConflict:
                for f in added:  # they belong to no snapshot
                    table.files.delete(f.path)
                raise
        return Summary(job.name, rows, deleted, page_count(rows, job.batch_size), mark)

    def _plan(self, job: Job, table: SnapshotTable, meta: Metadata, batch: DataFrame):
        """Write the files of a run: (all files of the new snapshot, or None to append; the new files). The batch is read once."""
        current = table.read() if meta.snapshot else None
        if job.write_mode == "append" or current is None and job.write_mode != "merge_into":
            return None, table.write_files(batch, meta)
        if current is None:
            return None, table.write_files(modes.split_changes(batch)[0], meta)
        if job.write_mode == "overwrite" and meta.partition and (job.iceberg_partition or job.partition_column == meta.partition["column"]):
            added = table.write_files(batch, meta)
            touched = {f.partition for f in added}
            return [f for f in table._listed(meta.snapshot) if f.partition not in touched] + added, added
        # The other modes read the batch twice: its rows are written first and read again from where they are. Only files
        # that hold a row to be replaced are read and written anew, all others are carried over.
        folder = f"{table.location}/staging/{uuid.uuid4().hex}"
        staged = self._staged(folder, batch)
        shape = T.StructType([*meta.schema.fields, *([staged.schema[modes.OP]] if job.write_mode == "merge_into" else [])])
        staged = modes.align(staged, shape)
        keys = [job.partition_column or job.iceberg_partition.column] if job.write_mode == "overwrite" else job.merge.key_columns
        replacing = modes.split_changes(staged)[1] if job.write_mode == "merge_into" else staged
        touched = table.files_matching(replacing, keys)
        current = table.read_files(touched) if touched else None
        plan = {"overwrite": lambda: modes.overwrite(current, staged, keys[0]), "upsert": lambda: modes.upsert(current, staged, keys), "merge_into": lambda: modes.merge_into(current, staged, keys)}
        try:
            added = table.write_files(plan[job.write_mode](), meta)
        finally:
            table.files.delete_tree(folder)
        left = {f.path for f in touched}
        return [f for f in table._listed(meta.snapshot) if f.path not in left] + added, added

    def _staged(self, path: str, batch: DataFrame) -> DataFrame:
        batch.write.parquet(path)
        return self.spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema.fields])).parquet(path)

    def _run_by_batch(self, job: Job, df: DataFrame, extra: dict[str, str]) -> Summary:
        """Append page by page along the cursor, one commit each."""
        table, rows, pages, mark = None, 0, 0, None
        catalog = self.catalog(job.destination)
        if catalog.exists(job.full_name):
            held = catalog.load(job.full_name).metadata().properties
            after = held.get(OPEN_CURSOR) or None
            mark = datetime.fromisoformat(held[OPEN_WATERMARK]) if held.get(OPEN_WATERMARK) else None
            after = int(after) if after is not None and job.cursor_type == "int" else after
        else:
            after = None
        while True:
            page, seen = self._observed(job, keyset_page(df, job.cursor_column, after, job.batch_size))
            table = table or self._target(job, strip(df, CURSOR))
            highest = Observation(f"cursor {job.name} {pages}")
            page = page.observe(highest, F.max(CURSOR).alias("cursor"))
            added = table.write_files(strip(page, CURSOR))
            n, pages = seen.get["rows"], pages + 1
            if n:
                if after is not None and highest.get["cursor"] <= after:
                    raise RuntimeError(f"Job '{job.name}': the cursor does not advance beyond {after!r}")
                after, rows = highest.get["cursor"], rows + n
                marks = [m for m in (mark, datetime.fromisoformat(seen.get["mark"]) if seen.get["mark"] else None) if m]
                mark = max(marks) if marks else None
            properties = {LAST_RUN_AT: datetime.now(UTC).isoformat(), LAST_RUN_ROWS: str(rows), OPEN_CURSOR: str(after or ""), OPEN_WATERMARK: mark.isoformat() if mark else ""}
            if last := n < job.batch_size:
                properties |= {OPEN_CURSOR: "", OPEN_WATERMARK: "", **extra}
                if job.watermark_column and mark:
                    properties[watermark_key(job.watermark_column)] = mark.replace(tzinfo=UTC).isoformat()
            if n or rows:
                table.commit_append(added, properties)
            if last:
                return Summary(job.name, rows, 0, pages, mark)
