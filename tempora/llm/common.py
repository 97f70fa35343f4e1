"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import ensure_checkpoint_dir, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder: columnar and compressed, for many narrow rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies beside the driver's (elsewhere: --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """mapInArrow with this package at hand in the workers."""
    python_ready(df.sparkSession)
    return df.mapInArrow(fn, schema)


def group_arrow(df: DataFrame, keys: list[str], fn, schema) -> DataFrame:
    """applyInArrow per group of keys with this package at hand in the workers."""
    python_ready(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(fn, schema)


def slots(df: DataFrame) -> int:
    """Partitions that a shuffle of this session makes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def merge_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Union-find over arrays: join the classes of u[i] and v[i]; label[x] is x's smallest member."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def ascii_lower(col):
    """A-Z to a-z, other letters unchanged."""
    return F.translate(col, UPPER, LOWER)
