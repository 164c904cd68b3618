"""Keyed tables: folders of changes plus a "latest per key" view.

The original system kept users, books and recommendations in a wide-row key
value store where a put writes one cell and the last write wins per cell.
Here a keyed table is a folder of Parquet files:

    <path>/log/writer=../batch_id=..      changes, one folder per batch
    <path>/snapshots/v<n>/rows            the merged state of some batches, placed by key
    <path>/snapshots/v<n>/held            which batches those are, until they are removed

* **upsert** writes one batch; a replay of the same ``(writer, batch_id)``
  replaces that folder (dynamic partition overwrite), so a re-run batch
  converges instead of duplicating rows.
* **latest** is a ``groupBy(key)`` over the newest snapshot and the batches
  that it does not hold.  ``merge="cell"`` takes, per column, the newest
  written value; ``merge="row"`` takes whole rows, so columns that belong
  together (a list and its scores) never mix.
* The version of a row is ``(gen, at, batch, file, block, pos)``: a writer
  generation (0 for bootstrap, higher for feeds), then the place of the line
  it came from (see ``text.sequenced``).  All cells of one line share it, so
  the last line of a key wins as a whole.
* **snapshot** is a plain job: it names the batches there are, writes their
  latest rows to a new folder, and says which batches that folder holds.
  Batches written meanwhile are not among the named ones and are read as
  before, so no write is lost and none has to wait.
* **get** and **lookup** read the snapshot by key (see ``placed``), and of the
  batches after it only the keys asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.placed import BUCKET_ROWS, Placed
from shelfwise.sources.placed import write as write_placed

SEQ = "_seq"
VERSION = "_v"
FULL = "_full"
WRITER = "writer"
BATCH_ID = "batch_id"

_VERSION_TYPE = T.StructType(
    [T.StructField("gen", T.IntegerType())] + [T.StructField(c, T.LongType()) for c in ("at", "batch", "file", "block", "pos")]
)


def nullable(dt: T.DataType) -> T.DataType:
    """The same type with every nested field and element nullable."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(nullable(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, nullable(dt.valueType), True)
    return dt


@dataclass
class KeyedTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    merge: str = "cell"  # or "row"
    # Extra version columns ranked before the row's version, e.g. a source rank.
    rank_cols: list[str] = field(default_factory=list)

    # -- layout ---------------------------------------------------------------

    @property
    def value_cols(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name not in self.keys]

    @property
    def _fields(self) -> list[T.StructField]:
        return [T.StructField(f.name, nullable(f.dataType), True) for f in self.schema.fields]

    @property
    def log_schema(self) -> T.StructType:
        return T.StructType(
            [
                *self._fields,
                T.StructField(VERSION, _VERSION_TYPE),
                T.StructField(FULL, T.BooleanType()),
                T.StructField(WRITER, T.StringType()),
                T.StructField(BATCH_ID, T.LongType()),
            ]
        )

    @property
    def state_schema(self) -> T.StructType:
        """Merged rows with the version of the row, or of every cell."""
        versions = [VERSION] if self.merge == "row" else [f"{VERSION}__{c}" for c in self.value_cols]
        return T.StructType([*self._fields, *[T.StructField(v, _VERSION_TYPE) for v in versions]])

    @property
    def _log(self) -> str:
        return f"{self.path.rstrip('/')}/log"

    def _fs(self, path: str):
        """(file system, path) in the JVM, for the existence checks that Spark's reader only answers by an error."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _is_there(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _snapshots(self) -> list[int]:
        """Numbers of the complete snapshots (one listing of a few entries); ``held`` is written last."""
        fs, p = self._fs(f"{self.path.rstrip('/')}/snapshots")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[1:]) for n in names if n[1:].isdigit() and self._is_there(f"{self._snapshot(int(n[1:]))}/held/_SUCCESS"))

    def _snapshot(self, number: int) -> str:
        return f"{self.path.rstrip('/')}/snapshots/v{number}"

    def _newest(self) -> tuple[Placed | None, list]:
        """The newest snapshot and the ranges of batch ids, per writer, that it holds."""
        done = self._snapshots()
        if not done:
            return None, []
        folder = self._snapshot(done[-1])
        cleaned = self._is_there(f"{folder}/cleaned/_SUCCESS")
        held = [] if cleaned else self.spark.read.schema(_HELD).parquet(f"{folder}/held").collect()
        return Placed(self.spark, f"{folder}/rows", self.state_schema, self.keys), held

    # -- K1: create if absent ---------------------------------------------------

    def exists(self) -> bool:
        return self._is_there(self._log)

    def create(self) -> bool:
        """Create an empty table; an existing table is left as it is.

        Returns True when created, False when it already existed (the
        original printed a message and carried on).
        """
        if self.exists():
            return False
        empty = self.spark.createDataFrame([], self.log_schema)
        empty.write.mode("ignore").partitionBy(WRITER, BATCH_ID).parquet(self._log)
        return True

    # -- K2: upsert -------------------------------------------------------------

    def upsert(self, df: DataFrame, writer: str, batch_id: int, generation: int = 0, full: bool = False) -> None:
        """Write one batch of (possibly partial) rows.

        Missing value columns are written as null.  Null means "not written"
        unless ``full``: then every cell of the row is written, null or not.
        A ``_seq`` column (see ``text.sequenced``) orders rows of one key.
        Replaying ``(writer, batch_id)`` replaces the earlier attempt.
        """
        cols = []
        for f in self.schema.fields:
            dt = nullable(f.dataType)
            cols.append((F.col(f.name).cast(dt) if f.name in df.columns else F.lit(None).cast(dt)).alias(f.name))
        seq = {c: (F.col(f"{SEQ}.{c}") if SEQ in df.columns else F.lit(0)).cast("bigint") for c in ("at", "file", "block", "pos")}
        version = F.struct(
            F.lit(generation).cast("int").alias("gen"), seq["at"].alias("at"), F.lit(batch_id).cast("bigint").alias("batch"),
            *[seq[c].alias(c) for c in ("file", "block", "pos")],
        )
        out = df.select(
            *cols,
            version.alias(VERSION),
            F.lit(full).alias(FULL),
            F.lit(writer).alias(WRITER),
            F.lit(batch_id).cast("bigint").alias(BATCH_ID),
        )
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WRITER, BATCH_ID).parquet(self._log)

    # -- S7: scan -----------------------------------------------------------------

    def log(self) -> DataFrame:
        """All changes, batch by batch."""
        if not self._is_there(self._log):
            return self.spark.createDataFrame([], self.log_schema)
        return self.spark.read.schema(self.log_schema).parquet(self._log)

    def _state_cols(self, cols: list[str]) -> list[str]:
        if self.merge == "row":
            return [*self.keys, *self.value_cols, VERSION]
        return [*self.keys, *cols, *[f"{VERSION}__{c}" for c in cols]]

    def _as_state(self, log: DataFrame, cols: list[str]) -> DataFrame:
        """Rows of the log in the state's shape, not merged."""
        if self.merge == "cell":
            for c in cols:
                log = log.withColumn(f"{VERSION}__{c}", F.when(F.col(FULL) | F.col(c).isNotNull(), F.col(VERSION)))
        return log.select(*self._state_cols(cols))

    def _parts(self, without: tuple[str, int] | None = None) -> tuple[Placed | None, DataFrame]:
        """The newest snapshot and the changes it does not hold; held batches are pruned with their folders."""
        placed, held = self._newest()
        ranges = [*held, *([(*without, without[1])] if without else [])]
        return placed, self.log().filter(~_held(ranges)) if ranges else self.log()

    def _rows(self, cols: list[str], without: tuple[str, int] | None = None) -> DataFrame:
        placed, log = self._parts(without)
        rows = self._as_state(log, cols)
        return rows if placed is None else placed.rows().select(*self._state_cols(cols)).unionByName(rows)

    def rows(self, cols: list[str]) -> DataFrame:
        """Rows not merged (keys + ``cols``), for scans that do not need the
        merge (e.g. "has any row with source X")."""
        return self._rows(self.value_cols if self.merge == "row" else cols).select(*self.keys, *cols)

    def _merge(self, rows: DataFrame, cols: list[str], keep_versions: bool = False) -> DataFrame:
        if self.merge == "row":
            # the largest rank carries its row: one struct a key, not a second one beside it
            rank = F.struct(*self.rank_cols, VERSION, F.struct(*self.value_cols).alias("v"))
            merged = rows.groupBy(*self.keys).agg(F.max(rank).alias("_r"))
            out = [F.col(f"_r.v.{c}").alias(c) for c in cols]
            return merged.select(*self.keys, *out, *([F.col(f"_r.{VERSION}").alias(VERSION)] if keep_versions else []))
        aggs = []
        for c in cols:
            v = F.col(f"{VERSION}__{c}")
            # equal versions (rows without a sequence): the larger value, deterministically
            aggs.append(F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), F.col(c).alias("x")))).alias(f"_{c}"))
        merged = rows.groupBy(*self.keys).agg(*aggs)
        out = [F.col(f"_{c}.x").alias(c) for c in cols]
        if keep_versions:
            out += [F.col(f"_{c}.v").alias(f"{VERSION}__{c}") for c in cols]
        return merged.select(*self.keys, *out)

    def latest(self, cols: list[str] | None = None, without: tuple[str, int] | None = None) -> DataFrame:
        """Current state: one row per key (project ``cols`` to prune the scan).

        ``without`` names a ``(writer, batch_id)`` to leave out: the state
        that a batch found, when it is run again.
        """
        cols = cols if cols is not None else self.value_cols
        return self._merge(self._rows(cols, without), cols)

    # -- S8: lookup ----------------------------------------------------------------

    def lookup(self, keys_df: DataFrame, cols: list[str] | None = None, keep_absent: bool = False) -> DataFrame:
        """Latest values for the keys in ``keys_df``.

        Absent keys give no row, or with ``keep_absent`` a row of nulls (the
        original's point get answered "" for an absent cell).  The keys
        prune the snapshot's buckets and pages and filter the log before the
        aggregation, so the shuffle carries only matching keys.
        """
        cols = cols if cols is not None else self.value_cols
        wanted = keys_df.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).distinct()
        placed, log = self._parts()
        rows = self._as_state(log.join(wanted, self.keys, "left_semi"), cols)
        if placed is not None:
            rows = placed.of(wanted).select(*self._state_cols(cols)).unionByName(rows)
        found = self._merge(rows, cols)
        return wanted.join(found, self.keys, "left") if keep_absent else found

    def get(self, key_values: dict, cols: list[str] | None = None) -> DataFrame:
        """Point lookup of one key: one bucket of the snapshot, and a filter that reaches the log's scan."""
        cols = cols if cols is not None else self.value_cols
        placed, log = self._parts()
        for k, v in key_values.items():
            log = log.filter(F.col(k) == F.lit(v).cast(self.schema[k].dataType))
        rows = self._as_state(log, cols)
        if placed is not None:
            rows = placed.at(key_values).select(*self._state_cols(cols)).unionByName(rows)
        return self._merge(rows, cols)

    # -- snapshot ----------------------------------------------------------------------

    def snapshot(self, bucket_rows: int = BUCKET_ROWS) -> int:
        """Write the latest rows of the batches there are now, placed by key; returns the snapshot's number.

        Versions are kept (per cell for cell merge), so later writes of any
        generation merge as if nothing had been written together.  Readers
        and writers go on meanwhile: a batch that comes after the listing is
        not held and is read from the log.
        """
        placed, before = self._newest()
        # a row per batch folder since the last clean-up
        found = self.log().select(WRITER, BATCH_ID).distinct().collect()
        ranges = _ranges(found, before)
        rows = self._as_state(self.log().filter(_held(ranges) & (~_held(before) if before else F.lit(True))), self.value_cols)
        if placed is not None:
            rows = placed.rows().unionByName(rows)
        merged = self._merge(rows, self.value_cols, keep_versions=True).select(*self.state_schema.fieldNames())
        number = max(self._snapshots(), default=0) + 1
        while self._is_there(self._snapshot(number)):  # left by a snapshot that was never completed
            number += 1
        write_placed(merged, f"{self._snapshot(number)}/rows", self.keys, rows.count(), bucket_rows)
        self.spark.createDataFrame(ranges, _HELD).coalesce(1).write.mode("overwrite").parquet(f"{self._snapshot(number)}/held")
        return number

    def clean(self) -> None:
        """Remove what the newest snapshot has made superfluous: folders of batches that it holds, and older snapshots.

        Maintenance, for when no reader that began before the snapshot is
        still running.  Afterwards the snapshot hides no batch any more: one
        that is replayed comes back with its old versions and changes nothing.
        """
        done = self._snapshots()
        _, held = self._newest()
        if not done or not held:
            return
        fs, log = self._fs(self._log)
        for writer in fs.listStatus(log):
            for batch in fs.listStatus(writer.getPath()) if writer.isDirectory() else []:
                names = [unquote(p.getPath().getName()).partition("=") for p in (writer, batch)]
                if names[1][0] == BATCH_ID and any(r[WRITER] == names[0][2] and r["low"] <= int(names[1][2]) <= r["high"] for r in held):
                    fs.delete(batch.getPath(), True)
        self.spark.createDataFrame([], _HELD).write.mode("overwrite").parquet(f"{self._snapshot(done[-1])}/cleaned")
        for number in done[:-1]:
            fs.delete(self._fs(self._snapshot(number))[1], True)

    def compact(self) -> int:
        """A snapshot, and what it makes superfluous removed; returns its number."""
        number = self.snapshot()
        self.clean()
        return number


# -- batches that a snapshot holds -------------------------------------------------------

_HELD = T.StructType([T.StructField(WRITER, T.StringType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])


def _ranges(batches: list, before: list) -> list[tuple]:
    """``(writer, low, high)``: runs of consecutive batch ids among ``batches`` and the ranges ``before``."""
    spans = sorted({(w, b, b) for w, b in batches} | {(r[WRITER], r["low"], r["high"]) for r in before})
    out: list[list] = []
    for writer, low, high in spans:
        if out and out[-1][0] == writer and low <= out[-1][2] + 1:
            out[-1][2] = max(out[-1][2], high)
        else:
            out.append([writer, low, high])
    return [tuple(x) for x in out]


def _held(ranges: list) -> Column:
    """Whether a batch is in one of the ranges; on partition columns only, so that folders are pruned."""
    inside = F.lit(False)
    for writer, low, high in ranges:
        inside = inside | ((F.col(WRITER) == writer) & F.col(BATCH_ID).between(low, high))
    return inside
