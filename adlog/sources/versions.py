"""Versions of kept tables: what is current is said by one small file.

Data goes to new folders that nobody reads yet. Then a numbered manifest that names them is put in place by one rename, which
fails if that number is taken. So readers see a version as a whole or not at all, a run that fails halfway leaves the old
version, and of two writers at once the later one fails instead of undoing the other's work.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

MANIFEST = re.compile(r"version-(\d{10})\.json$")


class Versions:
    """The versions below a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _manifests(self) -> dict[int, str]:
        folder = self._path(f"{self.root}/versions")
        if not self._files.exists(folder):
            return {}
        names = [str(status.getPath().getName()) for status in self._files.listStatus(folder)]
        return {int(found[1]): f"{self.root}/versions/{name}" for name in names if (found := MANIFEST.fullmatch(name))}

    def _read(self, path: str) -> dict:
        stream = self._files.open(self._path(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """Number and content of the newest version; 0 and nothing before the first."""
        found = self._manifests()
        return (max(found), self._read(found[max(found)])) if found else (0, {})

    def new_folder(self, label: str) -> str:
        """The path of a new folder for a version's data."""
        return f"{self.root}/data/{label}-{uuid.uuid4().hex}"

    def publish(self, content: dict, after: int) -> int:
        """Make ``content`` the version that follows number ``after``, and return its number.

        Fails if there is such a version already.
        """
        number = after + 1
        written = f"{self.root}/versions/.{uuid.uuid4().hex}.json"
        stream = self._files.create(self._path(written), False)
        try:
            stream.write(json.dumps(content).encode())
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        kind = getattr(self._hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 0)
        try:
            context.rename(self._path(written), self._path(f"{self.root}/versions/version-{number:010d}.json"), options)
        except Exception as error:
            self._files.delete(self._path(written), False)
            raise RuntimeError(f"version {number} of {self.root} is there already") from error
        return number

    def prune(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions, and the data that only they name.

        For times at which nobody writes: data of a version that is not published yet goes as well.
        """
        found = self._manifests()
        kept, gone = sorted(found)[-keep:], sorted(found)[:-keep]
        named = json.dumps([self._read(found[number]) for number in kept])
        for number in gone:
            self._files.delete(self._path(found[number]), False)
        data = self._path(f"{self.root}/data")
        for status in self._files.listStatus(data) if self._files.exists(data) else []:
            if f"data/{status.getPath().getName()}" not in named:
                self._files.delete(status.getPath(), True)
