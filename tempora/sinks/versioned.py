"""A parquet table whose partitions are replaced as a whole, each by a new version.

Layout: ``<path>/version=<id>/<part>=<value>/``, and notes ``<path>__manifest``
numbered upwards; the newest says which version of each partition counts, and
carries what the caller keeps with it (such as the deliveries merged). A
replacement writes a new version of the partitions it touches, then publishes
the next number: readers see all of it or nothing, a writer that dies leaves
rows that no manifest names, and of two writers that start from one manifest
one is refused (``StaleWrite``) and starts again. Reads list only the folders
they use. ``vacuum`` drops what the last manifests do not name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.sinks.notes import Notes, delete, folders

FILES = {"compression": "zstd", "parquet.writer.version": "v2"}  # of the stores: sorted keys and stamps as differences


class StaleWrite(RuntimeError):
    """Another writer has published since this one read the table."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, part: str):
        """``schema`` holds the partition column ``part`` as well."""
        self.spark, self.path, self.schema, self.part = spark, path.rstrip("/"), schema, part
        self.notes = Notes(spark, self.path + "__manifest")

    def manifest(self) -> dict:
        """{number, parts: {value: version}, kept: {...}} as of now."""
        found = self.notes.newest()
        return {"number": int(found[0]), **found[1]} if found else {"number": 0, "parts": {}, "kept": {}}

    def read(self, parts: Iterable | None = None, manifest: dict | None = None) -> DataFrame:
        """The rows of the named partitions (all if None); other folders are not even listed."""
        chosen = (manifest or self.manifest())["parts"]
        if parts is not None:
            wanted = {str(p) for p in parts}
            chosen = {value: version for value, version in chosen.items() if value in wanted}
        paths = [f"{self.path}/version={version}/{self.part}={value}" for value, version in sorted(chosen.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("version", T.StringType())]))
        return rows.option("basePath", self.path).parquet(*paths).select(*self.schema.fieldNames())

    def replace(self, rows: DataFrame, parts: Iterable, kept: dict, base: dict, sort: Iterable[str] = (), dealt: bool = False) -> dict:
        """Publish ``rows`` as the new contents of ``parts`` (emptied where no row falls), on top of manifest ``base``.

        ``dealt``: the rows lie by partition already (a partition in few tasks), so they are written without an exchange.
        """
        version = uuid.uuid4().hex[:12]
        target = f"{self.path}/version={version}"
        out = rows.select(*self.schema.fieldNames())
        out = out if dealt else out.hint("rebalance", self.part)
        if sort:
            out = out.sortWithinPartitions(self.part, *sort)
        out.write.partitionBy(self.part).options(**FILES).parquet(target)
        written = {f.split("=", 1)[1] for f in folders(self.spark, target) if f.startswith(f"{self.part}=")}
        now = {v: x for v, x in base["parts"].items() if v not in {str(p) for p in parts}} | {v: version for v in written}
        content = {"parts": now, "kept": kept}
        if not self.notes.write(f"{base['number'] + 1:012d}", content):
            delete(self.spark, target)
            raise StaleWrite(self.path)
        return {"number": base["number"] + 1, **content}

    def vacuum(self, manifests: int = 2) -> None:
        """Drop all but the newest ``manifests`` and the versions of which those name nothing."""
        self.notes.keep_newest(manifests)
        live = {v for name in self.notes.names() for v in self.notes.read(name)["parts"].values()}
        for folder in folders(self.spark, self.path):
            if folder.startswith("version=") and folder.split("=", 1)[1] not in live:
                delete(self.spark, f"{self.path}/{folder}")


def values_of(df: DataFrame, column: str) -> list:
    """The distinct values of a partition column in a delivery (as many as folders it touches)."""
    return [r[0] for r in df.select(F.col(column).alias("v")).distinct().collect()]
