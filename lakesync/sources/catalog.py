"""Namespaces and table pointers in a warehouse folder.

catalog/<a>/<b>/ is namespace a.b, with its properties in _namespace.json; t.table.json in it points to the location of
table a.b.t. Tables live under tables/<uuid>, so a rename moves the pointer only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.idents import parse_namespace, parse_table
from .files import Files
from .snapshot import SnapshotTable

_PROPERTIES, _SUFFIX = "_namespace.json", ".table.json"


class NotFound(LookupError):
    """A namespace or table that isn't in the catalog."""


class Catalog:
    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.warehouse, self.files = spark, warehouse.rstrip("/"), Files(spark)

    def _folder(self, namespace: tuple[str, ...]) -> str:
        return "/".join([self.warehouse, "catalog", *namespace])

    def _pointer(self, name: str) -> str:
        namespace, table = parse_table(name)
        return f"{self._folder(namespace)}/{table}{_SUFFIX}"

    def _need_namespace(self, namespace: tuple[str, ...]) -> str:
        folder = self._folder(namespace)
        if not self.files.exists(f"{folder}/{_PROPERTIES}"):
            raise NotFound(f"Namespace '{'.'.join(namespace)}' does not exist")
        return folder

    # ---- namespaces ----

    def namespaces(self) -> list[str]:
        """Top-level namespaces."""
        root = f"{self.warehouse}/catalog"
        return [n for n in self.files.names(root) if self.files.exists(f"{root}/{n}/{_PROPERTIES}")]

    def create_namespace(self, name: str, properties: dict[str, str] | None = None) -> bool:
        """Whether it was new; parents are made too."""
        namespace, new = parse_namespace(name), False
        for k in range(1, len(namespace) + 1):
            try:
                self.files.create(f"{self._folder(namespace[:k])}/{_PROPERTIES}", json.dumps(properties if k == len(namespace) and properties else {}))
                new = k == len(namespace)
            except FileExistsError:
                continue
        return new

    def drop_namespace(self, name: str) -> bool:
        """Whether it was there; raises if it holds tables or namespaces."""
        namespace = parse_namespace(name)
        folder = self._folder(namespace)
        if not self.files.exists(f"{folder}/{_PROPERTIES}"):
            return False
        if held := [n for n in self.files.names(folder) if n.endswith(_SUFFIX) or self.files.exists(f"{folder}/{n}/{_PROPERTIES}")]:
            raise ValueError(f"Namespace '{name}' is not empty: {', '.join(n.removesuffix(_SUFFIX) for n in held[:5])}")
        self.files.delete(f"{folder}/{_PROPERTIES}")
        self.files.delete(folder, folder=True)
        return True

    def namespace_properties(self, name: str, set_: dict[str, str] | None = None, remove: list[str] | None = None) -> dict[str, str]:
        """The properties, after taking some away and then setting some."""
        path = f"{self._need_namespace(parse_namespace(name))}/{_PROPERTIES}"
        found = json.loads(self.files.read(path))
        if set_ or remove:
            found = {k: v for k, v in found.items() if k not in (remove or ())} | (set_ or {})
            self.files.replace(path, json.dumps(found))
        return found

    # ---- tables ----

    def tables(self, namespace: str) -> list[str]:
        folder = self._need_namespace(parse_namespace(namespace))
        return [n.removesuffix(_SUFFIX) for n in self.files.names(folder) if n.endswith(_SUFFIX)]

    def exists(self, name: str) -> bool:
        return self.files.exists(self._pointer(name))

    def load(self, name: str) -> SnapshotTable:
        if not self.files.exists(path := self._pointer(name)):
            raise NotFound(f"Table '{name}' does not exist")
        return SnapshotTable(self.spark, json.loads(self.files.read(path))["location"])

    def create_table(self, name: str, schema: T.StructType, partition: dict[str, str] | None = None, properties: dict[str, str] | None = None) -> tuple[SnapshotTable, bool]:
        """The table and whether it was new."""
        self._need_namespace(parse_table(name)[0])
        if self.exists(name):
            return self.load(name), False
        table = SnapshotTable.create(self.spark, f"{self.warehouse}/tables/{uuid.uuid4().hex}", schema, partition, properties)
        try:
            self.files.create(self._pointer(name), json.dumps({"location": table.location}))
        except FileExistsError:
            table.purge()
            return self.load(name), False
        return table, True

    def drop_table(self, name: str, purge: bool = False) -> tuple[int, int] | None:
        """None if there is no such table, else how many files were deleted and how many could not be. Files stay without purge."""
        if not self.exists(name):
            return None
        done = self.load(name).purge() if purge else (0, 0)
        self.files.delete(self._pointer(name))
        return done

    def rename_table(self, old: str, new: str) -> None:
        """Also into another namespace; the new name must be free."""
        location = self.load(old).location
        self._need_namespace(parse_table(new)[0])
        try:
            self.files.create(self._pointer(new), json.dumps({"location": location}))
        except FileExistsError as error:
            raise ValueError(f"Table '{new}' already exists") from error
        self.files.delete(self._pointer(old))

    def describe(self, name: str) -> DataFrame:
        """item, name, value of the table: its location and snapshot, fields, properties."""
        meta = self.load(name).metadata()
        rows = [("table", "format-version", "1"), ("table", "location", meta.location), ("table", "current-snapshot-id", meta.current), ("table", "manifest", meta.snapshot.manifest if meta.snapshot else None)]
        rows += [("table", "partition", f"{meta.partition['transform']}({meta.partition['column']})")] if meta.partition else []
        rows += [("field", f.name, f"{f.metadata['parquet.field.id']}: {f.dataType.simpleString()}, optional") for f in meta.schema.fields]
        rows += [("property", k, v) for k, v in sorted(meta.properties.items())]
        return self.spark.createDataFrame(rows, "item string, name string, value string")

    def copy_table(self, source: str, target: str, limit: int | None = None) -> int:
        """Append source's rows to target, which must have its columns; returns the rows copied. No snapshot for none."""
        rows, into = self.load(source).read(), self.load(target)
        missing = {(f.name, f.dataType) for f in rows.schema.fields} ^ {(f.name, f.dataType) for f in into.metadata().schema.fields}
        if missing:
            raise ValueError(f"Schemas of '{source}' and '{target}' differ in {sorted({n for n, _ in missing})}")
        added = into.write_files(rows if limit is None else rows.limit(limit))
        if added:
            into.commit_append(added)
        return sum(f.records for f in added)
