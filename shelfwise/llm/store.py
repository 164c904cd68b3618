"""Shared intermediate tables under the folder named in ``spark.checkpoint.dir``."""

from __future__ import annotations

import sys
import tempfile
import uuid
import weakref
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Folders of the tables that ``keep`` wrote.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; one is made only for a single-machine session that names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    _folders[kept] = path
    return kept


def discard(*tables: DataFrame | None) -> None:
    """Remove tables that ``keep`` wrote, once all that was made of them is itself written."""
    for kept in tables:
        path = None if kept is None else _folders.pop(kept, None)
        if path:
            remove(kept.sparkSession, path)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def by_value(name: str) -> ModuleType:
    """Let the module's functions travel to executors inside the task, so that executors need no copy of the repository."""
    module = sys.modules[name]
    cloudpickle.register_pickle_by_value(module)
    return module
