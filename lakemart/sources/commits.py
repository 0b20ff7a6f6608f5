"""A log of numbered commits: one small JSON file each, whole or absent, and never written twice."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer has taken the number first."""


class Folder:
    """Small files of one folder, through the session's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names in the folder without those of unfinished files, in order; none if there is no folder."""
        if not self._files.exists(self._at("")):
            return []
        found = [status.getPath().getName() for status in self._files.listStatus(self._at(""))]
        return sorted(name for name in found if not name.startswith("."))

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def read(self, name: str) -> Any:
        stream = self._files.open(self._at(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, name: str, value: Any) -> None:
        """Write a file that is not there yet; it appears whole, under its name, or not at all."""
        temporary = self._at(f".{uuid.uuid4().hex}")
        stream = self._files.create(temporary, False)
        try:
            stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            stream.close()
        try:
            # The rename that refuses to replace a file.
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
            rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
            options = self._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context.rename(temporary, self._at(name), options)
        except Exception as refused:
            self._files.delete(temporary, False)
            if self.exists(name):
                raise Conflict(f"{self.path}/{name} is there already") from refused
            raise

    def delete(self, name: str) -> bool:
        """Delete a file or a folder with all it holds."""
        return self._files.delete(self._at(name), True)


class CommitLog:
    """Commits 1, 2, 3, ... of one folder. A reader that has read the log once keeps what it saw."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(name.removesuffix(".json")) for name in self.folder.names() if name.endswith(".json")]

    def entries(self) -> list[tuple[int, Any]]:
        """All commits, oldest first."""
        return [(number, self.read(number)) for number in self.numbers()]

    def latest(self) -> tuple[int, Any]:
        """The newest commit; number 0 and nothing if there is none."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def read(self, number: int) -> Any:
        return self.folder.read(f"{number:012d}.json")

    def commit(self, number: int, value: Any) -> int:
        """Add commit ``number``, one above the last that the caller knows; raises ``Conflict`` if it is taken."""
        self.folder.create(f"{number:012d}.json", value)
        return number

    def forget(self, number: int) -> None:
        self.folder.delete(f"{number:012d}.json")
