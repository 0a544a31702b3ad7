"""Folders whose content changes all at once: parts are written aside, then one small file names them.

``<root>/_versions/<number>.json`` is a manifest. Readers follow the newest one that is whole; a run
that fails before its manifest is written leaves the version before it as it was, and of two runs that
start from the same version only one can write the next.
"""

from __future__ import annotations

import json
from typing import Any
from uuid import uuid4

from pyspark.sql import SparkSession

FOLDER = "_versions"


class VersionConflict(RuntimeError):
    """Another run has written the next version first."""


class VersionedFolder:
    """A folder on any file system that Spark's Hadoop configuration knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        path = self._path(self.root)
        self._files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(path))

    def subfolders(self, folder: str) -> list[str]:
        """Names of what lies in ``folder``, without Spark's marks."""
        return [name for name in self._names(folder) if not name.startswith(("_", "."))]

    def _numbers(self) -> list[int]:
        names = self._names(f"{self.root}/{FOLDER}")
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def _file(self, number: int) -> str:
        return f"{self.root}/{FOLDER}/{number:010d}.json"

    def _read(self, number: int) -> dict[str, Any] | None:
        stream = self._files.open(self._path(self._file(number)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:  # its writer was stopped
            return None

    def current(self) -> tuple[int, dict[str, Any]]:
        """The number and content of the newest whole manifest; 0 and nothing if there is none."""
        for number in reversed(self._numbers()):
            content = self._read(number)
            if content is not None:
                return number, content
        return 0, {}

    def new_part(self) -> str:
        """A folder for the parts of a version to come, which nothing else uses."""
        return f"{self.root}/parts/{uuid4().hex}"

    def publish(self, base: int, content: dict[str, Any]) -> int:
        """Make ``content`` the current version, if ``base`` still is; returns its number."""
        if self.current()[0] != base:
            raise VersionConflict(f"version {base} of {self.root} is not the newest any more")
        number = max(self._numbers(), default=0) + 1
        try:
            stream = self._files.create(self._path(self._file(number)), False)
        except Exception as error:
            if self._files.exists(self._path(self._file(number))):
                raise VersionConflict(f"version {number} of {self.root} exists") from error
            raise
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        return number

    def prune(self, used: set[str], keep: int = 2) -> None:
        """Delete the manifests before the newest ``keep``, and all parts that neither those nor
        ``used`` name. Not while another run writes: its parts are not named yet."""
        numbers = self._numbers()
        named = set(used)
        for number in numbers[-keep:]:
            named |= _parts_named(self._read(number))
        for number in numbers[:-keep]:
            self._files.delete(self._path(self._file(number)), False)
        for name in self._names(f"{self.root}/parts"):
            if name not in named:
                self._files.delete(self._path(f"{self.root}/parts/{name}"), True)


def _parts_named(content: Any) -> set[str]:
    """All names of part folders in a manifest: the piece of a path after ``/parts/``."""
    if isinstance(content, str):
        return {content.split("/parts/", 1)[1].split("/")[0]} if "/parts/" in content else set()
    if isinstance(content, dict):
        content = list(content.values())
    if isinstance(content, list):
        return set().union(*map(_parts_named, content)) if content else set()
    return set()
