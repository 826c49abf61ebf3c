"""A numbered list of small committed entries in a shared folder.

Writers put their data wherever they like and then commit one entry; what no entry
names does not exist for readers.  An entry is a file that is written under another
name and renamed to its number.  A number that another writer took first is refused,
so two writers never commit the same one.

That rests on the store's rename failing where the target exists, as HDFS, ``abfs``
and local file systems do.  On a plain object store, let one writer at a time commit.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

_DIGITS = 19


class Ledger:
    """Entries ``1, 2, ...`` below ``path``; each is a small JSON object."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._path(path)
        self._files = self._folder.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.makeQualified(self._folder).toUri(), conf
        )

    def _path(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def numbers(self) -> list[int]:
        """The committed numbers in ascending order."""
        if not self._files.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return sorted(int(name) for name in names if name.isdigit() and len(name) == _DIGITS)

    def read(self, number: int) -> dict[str, Any]:
        stream = self._files.open(self._path(self._folder, f"{number:0{_DIGITS}}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict[str, Any]] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def commit(self, number: int, entry: dict[str, Any]) -> bool:
        """Commit ``entry`` as ``number``; False if that number is taken."""
        self._files.mkdirs(self._folder)
        target = self._path(self._folder, f"{number:0{_DIGITS}}")
        if self._files.exists(target):
            return False
        draft = self._path(self._folder, f".draft-{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(entry), "utf-8"))
        finally:
            stream.close()
        # Without the overwrite option a rename onto an existing file is an error.
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1
        )
        self._jvm.java.lang.reflect.Array.set(options, 0, rename.NONE)
        try:
            self._context.rename(
                self._files.makeQualified(draft), self._files.makeQualified(target), options
            )
        except Exception as refused:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(refused):
                return False
            raise
        return True

    def remove(self, number: int) -> None:
        self._files.delete(self._path(self._folder, f"{number:0{_DIGITS}}"), False)

    def folders(self, path: str) -> dict[str, int]:
        """The folders below ``path`` with the time, in milliseconds, of their last change."""
        where = self._path(path)
        if not self._files.exists(where):
            return {}
        return {
            status.getPath().getName(): status.getModificationTime()
            for status in self._files.listStatus(where)
            if status.isDirectory()
        }

    def remove_folder(self, path: str) -> None:
        self._files.delete(self._path(path), True)
