"""Versioned model storage.

Each save goes to a new path ``<root>/<kind>/v<version>``, then one row is
appended to a small Parquet registry; the current model is the highest
registered version.  A reader therefore never sees a half-written model, and
a nightly retrain is picked up by the next micro-batch without restart.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("saved_at_ms", T.LongType(), False),
    ]
)


def _registry_path(root: str) -> str:
    return f"{root.rstrip('/')}/_registry"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def current(spark: SparkSession, root: str, kind: str) -> tuple[int, str] | None:
    """(version, path) of the newest registered model of ``kind``."""
    if not exists(spark, _registry_path(root)):
        return None
    reg = spark.read.schema(_SCHEMA).parquet(_registry_path(root))
    row = reg.filter(F.col("kind") == kind).agg(F.max_by(F.struct("version", "path"), "version").alias("v")).first()
    if row is None or row["v"] is None:
        return None
    return int(row["v"]["version"]), row["v"]["path"]


def save(spark: SparkSession, model, root: str, kind: str, version: int | None = None,
         register_now: bool = True) -> tuple[int, str]:
    """Save ``model`` as the next version of ``kind``; returns (version, path).

    With ``register_now=False`` the model is written but not yet visible;
    call ``register`` once everything that belongs to the version (e.g. its
    donor lists) is written too.
    """
    if version is None:
        cur = current(spark, root, kind)
        version = 1 if cur is None else cur[0] + 1
        # a folder left by a save that was never registered is not taken over
        while exists(spark, f"{root.rstrip('/')}/{kind}/v{version}"):
            version += 1
    path = f"{root.rstrip('/')}/{kind}/v{version}"
    if hasattr(model, "save_to"):
        model.save_to(path)
    else:
        model.write().overwrite().save(path)
    if register_now:
        register(spark, root, kind, version, path)
    return version, path


def register(spark: SparkSession, root: str, kind: str, version: int, path: str) -> None:
    """Make a saved version the current one (one appended registry row)."""
    register_all(spark, root, [(kind, version, path)])


def register_all(spark: SparkSession, root: str, saved: list[tuple[str, int, str]]) -> None:
    """Make saved versions ``(kind, version, path)`` current together: their rows are one file, so readers see all or none."""
    now = int(time.time() * 1000)
    rows = [(kind, int(version), path, now) for kind, version, path in saved]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(_registry_path(root))


def load(spark: SparkSession, root: str, kind: str, loader):
    """(version, model) of the current ``kind``; ``loader`` is e.g. ``ALSModel.load``."""
    cur = current(spark, root, kind)
    if cur is None:
        return None, None
    version, path = cur
    return version, loader(path)
