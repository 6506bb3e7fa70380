"""Command line: `python -m lakesync --warehouse DIR COMMAND …`."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from .functions.coerce import json_rows
from .functions.idents import parse_pair, parse_schema, parse_table, parse_type
from .plans import config as configs
from .plans.engine import SyncEngine
from .plans.scheduler import ordered, run_jobs
from .session import build_session, store_settings
from .sources.catalog import Catalog
from .streaming.consumer import Consumer


def grid(columns: list[str], rows: list[tuple]) -> str:
    """Rows as a table of characters; nulls are NULL, booleans true or false."""
    word = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    cells = [columns, *([word(v) for v in row] for row in rows)]
    widths = [max(len(row[i]) for row in cells) for i in range(len(columns))]
    line = lambda left, mid, right: left + mid.join("─" * (w + 2) for w in widths) + right
    body = ["│" + "│".join(f" {c:<{w}} " for c, w in zip(row, widths, strict=True)) + "│" for row in cells]
    return "\n".join([line("┌", "┬", "┐"), body[0], line("├", "┼", "┤"), *body[1:], line("└", "┴", "┘")])


def show(df: DataFrame, limit: int) -> int:
    rows = [tuple(r) for r in df.limit(limit).collect()]
    if rows:
        print(grid(df.columns, rows))
    return len(rows)


class Commands:
    """One method for each command, named like it."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.catalog = spark, Catalog(spark, warehouse)

    def list_namespaces(self, args) -> None:
        found = self.catalog.namespaces()
        print(grid(["namespace"], [(n,) for n in found]) if found else "(no namespaces)")

    def list_tables(self, args) -> None:
        found = self.catalog.tables(args.namespace)
        print(grid(["namespace", "table"], [(args.namespace, t) for t in found]) if found else "(no tables)")

    def describe(self, args) -> None:
        show(self.catalog.describe(args.table), 10_000)

    def scan(self, args) -> None:
        df = self.catalog.load(args.table).read()
        if args.columns:
            df = df.select(*(f"`{c.strip()}`" for c in args.columns.split(",")))
        if n := show(df, args.limit):
            print(f"({n} rows shown, limit={args.limit})")
        else:
            print("(no data)")

    def write(self, args) -> None:
        table = self.catalog.load(args.table)
        rows = json_rows(self.spark, args.json, table.metadata().schema)
        added = table.write_files(rows)
        if not added:
            print("No rows to write.")
            return
        table.commit_append(added)
        print(f"Wrote {sum(f.records for f in added)} rows to '{args.table}'")

    def create_namespace(self, args) -> None:
        new = self.catalog.create_namespace(args.namespace)
        print(f"Namespace '{args.namespace}' created" if new else f"Namespace '{args.namespace}' already exists — skipping")

    def drop_namespace(self, args) -> None:
        gone = self.catalog.drop_namespace(args.namespace)
        print(f"Namespace '{args.namespace}' dropped" if gone else f"Namespace '{args.namespace}' does not exist — skipping")

    def namespace_properties(self, args) -> None:
        found = self.catalog.namespace_properties(args.namespace, dict(map(parse_pair, args.set)), args.remove)
        print(grid(["key", "value"], sorted(found.items())) if found else "(no properties)")

    def create_table(self, args) -> None:
        _, new = self.catalog.create_table(args.table, parse_schema(args.schema))
        print(f"Table '{args.table}' created" if new else f"Table '{args.table}' already exists — skipping")

    def drop_table(self, args) -> None:
        done = self.catalog.drop_table(args.table, args.purge)
        if done is None:
            print(f"Table '{args.table}' does not exist — skipping")
        else:
            print(f"Table '{args.table}' dropped" + (f", {done[0]} files deleted, {done[1]} failed" if args.purge else ""))

    def rename_table(self, args) -> None:
        self.catalog.rename_table(args.from_, args.to)
        print(f"Table '{args.from_}' renamed to '{args.to}'")

    def count(self, args) -> None:
        print(self.catalog.load(args.table).count())

    def snapshots(self, args) -> None:
        df = self.catalog.load(args.table).snapshots()
        total = df.count()
        show(df, args.limit)
        print(f"({total} snapshots)")

    def expire_snapshots(self, args) -> None:
        print(f"{self.catalog.load(args.table).expire_snapshots(args.older_than_days)} snapshots expired")

    def table_stats(self, args) -> None:
        print(grid(["statistic", "value"], [(k, "—" if v is None else v) for k, v in self.catalog.load(args.table).stats().items()]))

    def add_column(self, args) -> None:
        name, colon, kind = args.column.partition(":")
        if not colon:
            raise ValueError(f"Column must be 'name:type', got '{args.column}'")
        self.catalog.load(args.table).add_column(name.strip(), parse_type(kind))
        print(f"Column '{name.strip()}' added to '{args.table}'")

    def drop_column(self, args) -> None:
        self.catalog.load(args.table).drop_column(args.column)
        print(f"Column '{args.column}' dropped from '{args.table}'")

    def copy_table(self, args) -> None:
        n = self.catalog.copy_table(args.from_, args.to, args.limit)
        print(f"Copied {n} rows from '{args.from_}' to '{args.to}'" if n else "Source has no rows — nothing copied")

    def sync(self, args) -> None:
        config = configs.load(args.config)
        jobs = ordered(config, args.job, args.group)
        if not jobs:
            print("No jobs to run.")
            return
        if args.dry_run:
            print("⚠  dry-run mode — no data will be written")
        engine = SyncEngine(self.spark, config, dry_run=args.dry_run)
        failed = 0
        for name, result in run_jobs(jobs, engine.run, args.parallel).items():
            if isinstance(result, Exception):
                failed += 1
                print(f"✗  {name}  error: {result}", file=sys.stderr)
            else:
                print(f"✓  {name}  rows={result.rows_written}  watermark={result.watermark}")
        if failed:
            raise RuntimeError("One or more sync jobs failed")

    def sync_consume(self, args) -> None:
        config = configs.load(args.config)
        checkpoints = args.checkpoints or f"{self.catalog.warehouse}/checkpoints"
        Consumer(self.spark, SyncEngine(self.spark, config), config, checkpoints).run(once=args.once)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lakesync", description="Snapshot tables and incremental synchronisation on Spark")
    out.add_argument("--warehouse", default="warehouse", help="folder or URL of tables and catalog")
    out.add_argument("--s3-endpoint")
    out.add_argument("--region", default="us-east-1")
    for flag in ("--access-key-id", "--secret-access-key", "--session-token"):
        out.add_argument(flag)
    out.add_argument("--master", help="Spark master; spark-submit's own by default")
    out.add_argument("-v", "--verbose", action="count", default=0)
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> None:
        sub = commands.add_parser(name)
        for flag, settings in options:
            sub.add_argument(flag, **settings)

    table, namespace, config = ("--table", {"required": True}), ("--namespace", {"required": True}), ("--config", {"required": True})
    source, target = ("--from", {"required": True, "dest": "from_"}), ("--to", {"required": True})
    command("list-namespaces")
    command("list-tables", namespace)
    command("describe", table)
    command("scan", table, ("--columns", {}), ("--limit", {"type": int, "default": 50}))
    command("write", table, ("--json", {"required": True}), ("--partition", {"help": "accepted and ignored: rows find their partition themselves"}))
    command("create-namespace", namespace)
    command("create-table", table, ("--schema", {"required": True}))
    command("drop-table", table, ("--purge", {"action": "store_true"}))
    command("rename-table", source, target)
    command("count", table)
    command("snapshots", table, ("--limit", {"type": int, "default": 20}))
    command("expire-snapshots", table, ("--older-than-days", {"type": float, "default": 7}))
    command("table-stats", table)
    command("add-column", table, ("--column", {"required": True}))
    command("drop-column", table, ("--column", {"required": True}))
    command("namespace-properties", namespace, ("--set", {"action": "append", "default": []}), ("--remove", {"action": "append", "default": []}))
    command("drop-namespace", namespace)
    command("copy-table", source, target, ("--limit", {"type": int}))
    command("sync", config, ("--job", {}), ("--group", {}), ("--dry-run", {"action": "store_true"}), ("--parallel", {"type": int, "default": 1}))
    command("sync-consume", config, ("--checkpoints", {}), ("--once", {"action": "store_true"}))
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; 0 if it went well, 1 with a message if not."""
    args = parser().parse_args(argv)
    logging.basicConfig(level=[logging.WARNING, logging.INFO, logging.DEBUG][min(args.verbose, 2)])
    try:
        for name in ("table", "from_", "to"):
            if (given := getattr(args, name, None)) is not None:
                parse_table(given)
        store = store_settings(args.s3_endpoint, args.region, args.access_key_id, args.secret_access_key, args.session_token)
        settings = {f"spark.hadoop.{k}": v for k, v in store.items()} | ({"spark.master": args.master} if args.master else {})
        spark = spark or build_session(**settings)
        getattr(Commands(spark, args.warehouse), args.command.replace("-", "_"))(args)
    except Exception as error:  # noqa: BLE001  a command line says what went wrong
        print(f"Error: {error}", file=sys.stderr)
        return 1
    return 0
