"""Key indexes: stored entries by key, of which a batch reads only the buckets that its own keys fall into.

Layout: ``<path>/buckets=<n>/batch=<b>/bucket=<k>``; a key's bucket is its hash modulo n. Entries are only added; what
a key stands for follows from its entries (the latest one, or the least id). A replayed batch replaces its own entries
and never sees them. When buckets become larger than BUCKET_ROWS on average, the entries are written once into GROWTH
times as many, so what one key's lookup reads stays bounded while the index grows. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "key STRING, id BIGINT, mark BIGINT, alive BOOLEAN"
STORED = f"{ENTRY}, bucket INT, batch BIGINT"
FIRST_BUCKETS = 64
GROWTH = 4
BUCKET_ROWS = 1_000_000


class KeyIndex:
    """Entries (key, id, mark, alive) under ``path``; ``mark`` is free for the caller, ``alive`` false takes a key out."""

    def __init__(self, spark: SparkSession, path: str, first_buckets: int = FIRST_BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path = spark, path.rstrip("/")
        self.first_buckets, self.bucket_rows = first_buckets, bucket_rows

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def buckets(self) -> int:
        """Number of buckets now in use; 0 before the first batch. The first generation is filled batch by batch, a
        larger one counts once the job that wrote it has committed."""
        fs, folder = self._folder(self.path)
        if not fs.exists(folder):
            return 0
        found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("buckets=")]
        sizes = {int(p.getName().split("=")[1]): p for p in found}
        return max((n for n, p in sizes.items() if n == self.first_buckets or fs.exists(self._folder(f"{p}/_SUCCESS")[1])), default=0)

    def _generation(self, n: int) -> str:
        return f"{self.path}/buckets={n}"

    def _summary(self) -> str:
        return f"{self.path}/summary"

    def summary(self, before: int | None = None) -> tuple[int, int | None]:
        """``(entries, largest id)`` of the batches (before ``before``), from one row per batch."""
        fs, folder = self._folder(self._summary())
        if not fs.exists(folder):
            return 0, None
        rows = self.spark.read.schema("n BIGINT, high BIGINT, batch BIGINT").parquet(self._summary())
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        n, high = rows.agg(F.sum("n"), F.max("high")).first()
        return n or 0, high

    def entries(self, keys: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """Entries of the batches before ``before``; with ``keys`` (a column ``key``) those of its keys, read from their
        buckets only. Rows: key, id, mark, alive, batch."""
        n = self.buckets()
        if not n:
            return self.spark.createDataFrame([], f"{ENTRY}, batch BIGINT")
        rows = self.spark.read.schema(STORED).parquet(self._generation(n))
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        if keys is not None:
            asked = keys.select("key").where(F.col("key").isNotNull()).distinct()
            # At most n bucket numbers; the filter on them prunes folders.
            touched = [r[0] for r in asked.select(self._bucket(n).alias("b")).distinct().collect()]
            if len(touched) < n:
                rows = rows.where(F.col("bucket").isin(touched)) if touched else rows.where("false")
            rows = rows.join(asked, "key", "left_semi")
        return rows.select("key", "id", "mark", "alive", "batch")

    @staticmethod
    def _bucket(n: int):
        return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")

    def latest(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Keys whose latest entry is alive: key, id, mark. Of entries of one batch the alive one counts."""
        last = F.max_by(F.struct("id", "mark", "alive"), F.struct("batch", "alive", "id"))
        return self.entries(keys, before).groupBy("key").agg(last.alias("e")).where("e.alive").select("key", "e.id", "e.mark")

    def least(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The least id of each key: key, id."""
        return self.entries(keys, before).groupBy("key").agg(F.min("id").alias("id"))

    def add(self, rows: DataFrame, batch: int) -> None:
        """Adds the entries of ``batch`` (key, id, and mark and alive if there are such columns); null keys are left
        out. Adding a batch again replaces what it added."""
        have = rows.columns
        out = rows.where(F.col("key").isNotNull()).select(
            "key", F.col("id").cast("bigint").alias("id"),
            (F.col("mark") if "mark" in have else F.lit(None)).cast("bigint").alias("mark"),
            (F.col("alive") if "alive" in have else F.lit(True)).alias("alive"))
        n = self.buckets() or self.first_buckets
        # The summary is written last: a batch that stops in between is added again as a whole.
        folder = f"{self._generation(n)}/batch={batch}"
        (out.withColumn("bucket", self._bucket(n)).repartition("bucket").sortWithinPartitions("bucket", "key")
            .write.mode("overwrite").partitionBy("bucket").parquet(folder))
        added = self.spark.read.schema(f"{ENTRY}, bucket INT").parquet(folder)
        (added.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("high"))
            .write.mode("overwrite").parquet(f"{self._summary()}/batch={batch}"))
        if self.summary()[0] > n * self.bucket_rows:
            self._grow(n)

    def _grow(self, n: int) -> None:
        """All entries into more buckets, in one job that either commits or leaves the old generation in use."""
        more = n
        while self.summary()[0] > more * self.bucket_rows:
            more *= GROWTH
        rows = self.spark.read.schema(STORED).parquet(self._generation(n)).drop("bucket")
        (rows.withColumn("bucket", self._bucket(more)).repartition("bucket").sortWithinPartitions("batch", "bucket", "key")
            .write.mode("overwrite").partitionBy("batch", "bucket").parquet(self._generation(more)))
        # The generation that was in use stays for readers that still have it; older ones go.
        fs, folder = self._folder(self.path)
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("buckets=") and int(name.split("=")[1]) < n:
                fs.delete(status.getPath(), True)
