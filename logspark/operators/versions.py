"""Versions of a table: each is one small file that lists what belongs to it, put in place by one rename.

The rename must refuse to replace a file, as it does on HDFS and local disks, so of two writers of one
version the second gets an error.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer has put the same version in place."""


class Versions:
    """What tables with versions share; they have a ``path``."""

    path: str

    def _place(self, spark: SparkSession, name: str):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        place, files = self._place(spark, folder)
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(spark, "_versions") if n.startswith("v") and n.endswith(".json"))

    def _listed(self, spark: SparkSession, version: int):
        """What the file of a version holds."""
        place, files = self._place(spark, f"_versions/v{version:012d}.json")
        if not files.exists(place):
            raise FileNotFoundError(f"no version {version} of {self.path}")
        stream = files.open(place)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _remove(self, spark: SparkSession, name: str) -> None:
        place, files = self._place(spark, name)
        files.delete(place, True)

    def _put_in_place(self, spark: SparkSession, version: int, content) -> None:
        """Make a version, unless there is one of that number."""
        jvm = spark._jvm
        place, files = self._place(spark, f"_versions/v{version:012d}.json")
        draft, _ = self._place(spark, f"_versions/draft-{uuid.uuid4().hex}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, place, options)
        except Exception as refused:
            files.delete(draft, False)
            if files.exists(place):
                raise VersionConflict(f"version {version} of {self.path} is there already") from refused
            raise
