"""Versions of a table, claimed by create-if-absent.

A log folder holds one small JSON file a version: ``00000001.json``, ``00000002.json``, ...  A writer reads the last
version, and claims the next number by creating its file only if it does not exist.  Of two writers that try the same
number the file system lets one create it; the other reads what was committed meanwhile and tries the number after.  So numbers, and
whatever an entry derives from the entry before it (such as the next key of a sequence), are never given twice, and an entry is
there whole or not at all.

The entry is written to a file of its own first.  On a local or mounted file system (``file:``) it is then hard-linked to
the version's name, elsewhere renamed to it; both fail where the name exists.  The file system must refuse to rename onto an
existing file (HDFS does; an object store needs a committer of its own).
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

_NAME = re.compile(r"([0-9]{8,})\.json")


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; False where there is none."""
    fs, at = file_system(spark, path)
    return fs.delete(at, True)


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    folder: str

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:08d}.json"

    def numbers(self) -> list[int]:
        """All versions, ascending."""
        fs, at = file_system(self.spark, self.folder)
        if not fs.exists(at):
            return []
        found = [_NAME.fullmatch(status.getPath().getName()) for status in fs.listStatus(at)]
        return sorted(int(m.group(1)) for m in found if m)

    def entry(self, number: int) -> dict:
        return json.loads(self.spark.read.text(self._file(number), wholetext=True).first()["value"])

    def last(self) -> tuple[int, dict | None]:
        """The last version and its entry; (0, None) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.entry(numbers[-1])) if numbers else (0, None)

    def claim(self, number: int, entry: dict) -> bool:
        """Create version ``number``; False if it exists."""
        fs, target = file_system(self.spark, self._file(number))
        mine = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/_{uuid.uuid4().hex}")
        out = fs.create(mine, False)
        out.write(bytearray(json.dumps(entry).encode("utf-8")))
        out.close()
        try:
            if fs.getScheme() == "file":
                try:
                    os.link(mine.toUri().getPath(), target.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            return fs.rename(mine, target)
        finally:
            fs.delete(mine, False)

    def commit(self, make: Callable[[int, dict | None], dict]) -> tuple[int, dict]:
        """Claim the next version with ``make(its number, the entry before it)``, again until no other writer is first."""
        while True:
            number, before = self.last()
            entry = make(number + 1, before)
            if self.claim(number + 1, entry):
                return number + 1, entry

    def forget(self, number: int) -> None:
        """Remove a version's entry; the last one stays, since numbers go on from it."""
        if number != self.last()[0]:
            fs, target = file_system(self.spark, self._file(number))
            fs.delete(target, False)
