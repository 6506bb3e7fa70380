"""Small metadata files through Hadoop's file systems: local disks, HDFS and object stores look the same."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    """Whole-file operations on the driver."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def _local(self, path: str) -> str | None:
        """The local path where the file system is the local one."""
        store, where = self._at(path)
        return where.toUri().getPath() if store.getUri().getScheme() == "file" else None

    def exists(self, path: str) -> bool:
        store, where = self._at(path)
        return store.exists(where)

    def mkdirs(self, path: str) -> None:
        store, where = self._at(path)
        store.mkdirs(where)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none for a folder that isn't there."""
        store, where = self._at(path)
        return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []

    def is_dir(self, path: str) -> bool:
        store, where = self._at(path)
        return store.exists(where) and store.getFileStatus(where).isDirectory()

    def read(self, path: str) -> str:
        store, where = self._at(path)
        stream = store.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path: str, text: str, overwrite: bool) -> None:
        store, where = self._at(path)
        stream = store.create(where, overwrite)
        try:
            self._jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file at once or raise FileExistsError: of several writers of one path a single one gets through."""
        if (local := self._local(path)) is not None:
            os.makedirs(os.path.dirname(local), exist_ok=True)
            part = f"{local}.{uuid.uuid4().hex}.tmp"
            with open(part, "x", encoding="utf-8") as file:
                file.write(text)
            try:
                os.link(part, local)
            finally:
                os.unlink(part)
            return
        if self.exists(path):
            raise FileExistsError(path)
        try:
            self._put(path, text, overwrite=False)
        except Exception as error:  # the store's own class of exception
            if "AlreadyExists" in str(error):
                raise FileExistsError(path) from error
            raise

    def replace(self, path: str, text: str) -> None:
        if (local := self._local(path)) is not None:
            os.makedirs(os.path.dirname(local), exist_ok=True)
            part = f"{local}.{uuid.uuid4().hex}.tmp"
            with open(part, "x", encoding="utf-8") as file:
                file.write(text)
            os.replace(part, local)
            return
        self._put(path, text, overwrite=True)

    def delete(self, path: str, folder: bool = False) -> bool:
        """Whether a file was deleted, or a folder, which must be empty."""
        store, where = self._at(path)
        if not store.exists(where) or (folder and self.names(path)):
            return False
        return store.delete(where, folder)

    def delete_tree(self, path: str) -> bool:
        """Delete a folder with all that is in it; only for folders that their caller alone has written."""
        store, where = self._at(path)
        return store.delete(where, True)
