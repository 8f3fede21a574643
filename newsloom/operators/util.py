"""Small plan helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read again. Cuts the lineage and survives a
    lost executor like a checkpoint; later steps also read single columns and Spark knows the table's size."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame):
    """Scalar-subquery Column: TRUE when ``df`` has no rows (evaluated once per query)."""
    return df.select(F.count(F.lit(1))).scalar() == 0


# A key with more rows than this on the big side of a join is "hot": its rows are salted over several tasks.
# There can be at most rows / HOT_KEY_ROWS hot keys.
HOT_KEY_ROWS = 1_000_000


def join_hot_split(big: DataFrame, keyed: DataFrame, key: str, how: str = "inner",
                   key_counts: DataFrame | None = None, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``big ⋈ keyed`` on ``key`` where ``keyed`` has one row per key, safe for hot keys.

    ``key_counts`` (``key``, ``_n`` = rows of ``big`` per key) comes from an
    aggregate the caller already has, else from a partial aggregate of ``big``.
    Keys with more than ``hot_rows`` rows are salted: each of their ``big`` rows
    gets a salt ``xxhash64(row) % ceil(n / hot_rows)`` (deterministic, so a
    recomputed task gives the same rows), and their single ``keyed`` row is
    copied once per salt. One scan of ``big``, one shuffle on ``(key, salt)``,
    and no task receives more than about ``hot_rows`` rows of one key.

    The table of hot keys' hashes is broadcast; its size is bounded by construction (at
    most ``rows(big) / hot_rows`` rows of 12 bytes, however long the keys are). A key that shares a hot
    key's hash is salted like it, on both sides. ``how`` is 'inner' or 'left'.
    """
    if key_counts is None:
        key_counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = key_counts.where(F.col("_n") > hot_rows).groupBy(F.xxhash64(key).alias("_hot")).agg(
        F.max(F.ceil(F.col("_n") / F.lit(hot_rows))).cast("int").alias("_salts"))
    hot = F.broadcast(hot)
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    salted_big = big.join(hot, F.xxhash64(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(row_hash, F.col("_salts"))).cast("int")
    ).drop("_salts", "_hot")
    salted_keyed = keyed.join(hot, F.xxhash64(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts", "_hot")
    return salted_big.join(salted_keyed, [key, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, keyed: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a one-row-per-key dimension: a broadcast where Spark measures it as small, otherwise a sort-merge join
    whose skewed partitions (one source may hold a third of all rows) adaptive execution splits. Starts no job."""
    return big.join(keyed, key, how)
