"""Key-placed Parquet tables: rows in the order of their keys' hashes, cut into buckets by ranges of the hash.

    <path>/buckets=<n>/bucket=<b>/part-*.parquet      columns of the table and the hash

The number of buckets follows the number of rows.  A point read opens one
bucket.  A read of few keys opens their buckets and, as files are sorted by
the hash and written in small pages with a bloom filter, decodes only the
pages that can hold them; ranges of buckets do not overlap, so no other
bucket's key falls between a page's bounds.  A read of many keys prunes
buckets by the keys at run time (dynamic partition pruning), so keys are
never collected then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = "buckets"
BUCKET = "bucket"
HASH = "_h"
#: Rows of a bucket, and the most buckets of a table.
BUCKET_ROWS = 50_000
MOST_BUCKETS = 4096
#: Rows of a page: what a read of one key decodes.
PAGE_ROWS = 20
#: Keys that are sent to the scan one by one; beyond them only buckets are pruned.
FEW_KEYS = 1000
#: Values of one IN that the reader takes apart (more would become a range).
IN_VALUES = 10


def bucket(n: int | Column) -> Column:
    """The bucket of HASH: its upper 31 bits cut into ``n`` ranges."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.shiftright(F.shiftrightunsigned(F.col(HASH), 33) * n.cast("bigint"), 31).cast("int")


def write(df: DataFrame, path: str, keys: list[str], n_rows: int, bucket_rows: int = BUCKET_ROWS) -> None:
    """Writes ``df`` in one file a bucket; ``n_rows`` (about how many there are) sets the number of buckets."""
    n = max(1, min(MOST_BUCKETS, -(-n_rows // bucket_rows)))
    dealt = df.withColumn(HASH, F.xxhash64(*keys)).withColumn(BUCKETS, F.lit(n)).withColumn(BUCKET, bucket(n))
    placed = dealt.repartition(n, BUCKET).sortWithinPartitions(BUCKET, HASH)
    out = placed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    for setting in ("parquet.page.row.count.limit", "parquet.page.size.row.check.min"):
        out = out.option(setting, str(PAGE_ROWS))
    out = out.option(f"parquet.bloom.filter.enabled#{HASH}", "true").option(f"parquet.bloom.filter.expected.ndv#{HASH}", str(max(1, n_rows // n)))
    out.partitionBy(BUCKETS, BUCKET).parquet(path)


class Placed:
    """A written table.  ``schema`` is that of its rows, without the hash and bucket columns."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys

    @property
    def _typed(self) -> dict:
        return {f.name: f.dataType for f in self.schema.fields}

    def scan(self) -> DataFrame:
        """All rows, with the hash and bucket columns."""
        more = [T.StructField(HASH, T.LongType()), T.StructField(BUCKETS, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]
        return self.spark.read.schema(T.StructType([*self.schema.fields, *more])).parquet(self.path)

    def rows(self) -> DataFrame:
        return self.scan().drop(HASH, BUCKETS, BUCKET)

    def at(self, values: dict) -> DataFrame:
        """The row of one key: one bucket is listed, and the key's hash reaches the reader."""
        given = [F.lit(values[k]).cast(self._typed[k]) for k in self.keys]
        h = self.spark.range(1).select(F.xxhash64(*given).alias(HASH)).first()[HASH]
        there = (F.col(BUCKET) == F.lit(((h % (1 << 64)) >> 33) * self._buckets() >> 31)) & (F.col(HASH) == F.lit(h))
        same = [F.col(k) == v for k, v in zip(self.keys, given, strict=True)]
        return self.scan().filter(reduce(Column.__and__, same, there)).drop(HASH, BUCKETS, BUCKET)

    def of(self, wanted: DataFrame) -> DataFrame:
        """Rows of the keys in ``wanted`` (distinct keys under their own names and types)."""
        rows = self.scan()
        asked = wanted.select(*self.keys).withColumn(HASH, F.xxhash64(*self.keys)).withColumn(BUCKET, bucket(self._buckets()))
        few = asked.limit(FEW_KEYS + 1).collect()
        if not few:
            return rows.filter(F.lit(False)).drop(HASH, BUCKETS, BUCKET)
        if len(few) <= FEW_KEYS:
            asked = self.spark.createDataFrame(few, T.StructType([*[T.StructField(k, self._typed[k]) for k in self.keys], T.StructField(HASH, T.LongType()), T.StructField(BUCKET, T.IntegerType())]))
            values = sorted({r[HASH] for r in few})
            cuts = [values[i : i + IN_VALUES] for i in range(0, len(values), IN_VALUES)]
            rows = rows.filter(F.col(BUCKET).isin(sorted({r[BUCKET] for r in few}))).filter(reduce(Column.__or__, [F.col(HASH).isin(c) for c in cuts]))
        else:
            # a condition on the small side makes its buckets a pruning filter of the scan
            asked = asked.filter(F.col(BUCKET) >= 0)
        return rows.join(asked, [BUCKET, HASH, *self.keys], "left_semi").drop(HASH, BUCKETS, BUCKET)

    def _buckets(self) -> int:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        return next((int(x.partition("=")[2]) for x in found if x.startswith(f"{BUCKETS}=")), 1)


def scanned(df: DataFrame) -> dict:
    """Files, their bytes and rows that the Parquet scans of an already executed ``df`` have read, by Spark's own metrics."""
    totals = {"numFiles": 0, "filesSize": 0, "numOutputRows": 0}

    def walk(node) -> None:
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            for name in totals:
                found = node.metrics().get(name)
                totals[name] += found.get().value() if found.isDefined() else 0
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return totals
