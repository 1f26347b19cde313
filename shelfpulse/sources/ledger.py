"""Small numbered records in a shared folder: a new one takes effect all at once, or not at all."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Ledger:
    """The records of one folder, JSON files that are written aside and moved into place.

    The record with the highest number counts. A move onto a number that another run took
    meanwhile fails, so of two runs at the same time one does.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.path).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._fs.Path(name)

    def _record(self, number: int):
        return self._files.makeQualified(self._path(f"{self.path}/{number:08d}.json"))

    def numbers(self) -> list[int]:
        """Numbers of all records, newest first."""
        folder = self._path(self.path)
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[0] != "."), reverse=True)

    def read(self, number: int) -> Any:
        stream = self._files.open(self._record(number))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self) -> Any:
        """The content of the newest record, or None."""
        numbers = self.numbers()
        return self.read(numbers[0]) if numbers else None

    def add(self, content: Any) -> int:
        """Put a record with the next number in place."""
        number = next(iter(self.numbers()), 0) + 1
        aside = self._path(f"{self.path}/.{uuid.uuid4().hex}")
        stream = self._files.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        kind = getattr(self._fs, "Options$Rename")
        never_replace = self._gateway.new_array(kind, 1)
        never_replace[0] = kind.NONE
        context = self._fs.FileContext.getFileContext(aside.toUri(), self._conf)
        context.rename(self._files.makeQualified(aside), self._record(number), never_replace)
        return number

    def delete(self, path: str) -> None:
        """Delete a folder or file below the same file system."""
        self._files.delete(self._path(path), True)

    def folders(self, path: str) -> list[str]:
        """Names of what lies in a folder, none if there is no such folder."""
        return names_in(self._spark, path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder of any file system, none if there is no such folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(folder))
