"""Notes: small JSON files in one folder, each written once, after what it speaks of is whole.

A note becomes visible by a rename that fails where the name is taken, so of
two writers of one name exactly one succeeds, and no reader sees half a note
(atomic on HDFS-like stores; on a plain local folder the check and the rename
are two steps). What no note names does not exist for readers: rows are
written first, under a folder of their own, and published by their note.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder (hidden files aside); none if it is not there."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(".")) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


class Notes:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def names(self) -> list[str]:
        """All names, in order: one listing, nothing is opened."""
        return folders(self.spark, self.path)

    def read(self, name: str) -> dict:
        p, fs = _path(self.spark, f"{self.path}/{name}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> tuple[str, dict] | None:
        names = self.names()
        return (names[-1], self.read(names[-1])) if names else None

    def write(self, name: str, content: dict) -> bool:
        """Publish a note; False, and nothing is changed, if the name is taken."""
        target, fs = _path(self.spark, f"{self.path}/{name}")
        draft, _ = _path(self.spark, f"{self.path}/.{name}.{uuid.uuid4().hex}")
        if fs.exists(target):
            return False
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, target, none)
        except Exception:
            fs.delete(draft, False)
            if fs.exists(target):
                return False
            raise
        return True

    def keep_newest(self, n: int) -> None:
        for name in self.names()[:-n]:
            delete(self.spark, f"{self.path}/{name}")
