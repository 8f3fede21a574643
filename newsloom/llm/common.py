"""Helpers of the training-data operators: shared-folder tables, connected components, exact sums."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import checkpoint_dir


# Text bytes that a Python worker gets at a time, about: rows by the thousand (Spark's default) can hold any amount, and both
# the executor's Arrow buffers and the worker keep several times a batch.
BATCH_BYTES = 3 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of each batch that goes to a Python worker, unless the session sets a bound of its own. Rows are the
    same; a longer row is a batch of its own. It holds for the session, as plans made now run later."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts the lineage, survives
    a lost executor, and lets later jobs read single columns."""
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_places(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a unique long ``name``: the number of the Parquet part that a row is in, and its place there. It
    ascends in the order in which the table was written. What isn't read from numbered parts is stored first."""
    parts = [re.search(r"part-(\d+)[^/]*$", f) for f in df.inputFiles()]
    if not parts or not all(parts) or len({int(p.group(1)) for p in parts}) < len(parts):
        df = stored(df.sparkSession, df, "rows")
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return df.select("*", (F.shiftleft(part, 33) + F.col("_metadata.row_index")).alias(name))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def components(spark: SparkSession, links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components of ``links``: ``(node, component)`` with the smallest node of each component.

    Alternates small-star and large-star steps (Kiveris et al. 2014): each re-links a node's smaller or larger
    neighbours to its smallest one and never adds a link, so all nodes point at their component's smallest node after
    about log n steps. A step is one aggregate and one equi join; the aggregate, the smallest and largest neighbour of
    every node, also shows when all links are stars, so no step is made only to find that nothing changes. It is stored,
    so that the join is between two plain shuffles and the side of a node with very many links can be split. Steps are
    cut by tables in the shared folder. Nodes without links are absent.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    edges = stored(spark, links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where(u != v), "edges")
    small = True
    while True:
        both = edges.union(edges.select(v.alias("u"), u.alias("v")))
        low = stored(spark, both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")), "low")
        if low.where((m < u) & (F.col("x") != m)).isEmpty():
            return low.select(u.alias("node"), F.least("u", "m").alias("component"))
        # The neighbour that is the smallest itself stands for the node.
        if small:  # edges point from a node to a smaller one
            linked = edges.join(low, "u").select(F.when(v == m, u).otherwise(v).alias("u"), m.alias("v"))
        else:
            linked = edges.select(u.alias("b"), v.alias("u")).join(low, "u").select(F.col("b").alias("u"), F.least("u", "m").alias("v"))
        edges = stored(spark, linked.distinct(), "edges")
        small = not small


def prefix_scan(df: DataFrame, order: str, within: str, span: int = 1024, sums: dict | None = None,
                maxima: dict | None = None) -> DataFrame:
    """Adds, for every ``out: value`` of ``sums`` and ``maxima``, the sum or maximum of ``value`` over the rows
    of the same ``within`` before this one by the gapless long ``order`` (0 and null before the first).

    A scan in two levels: inside runs of ``span`` rows, then over one total per run, so that one long file
    does not mean one long task."""
    from pyspark.sql import Window

    run = Window.partitionBy(within, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    runs = Window.partitionBy(within).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_run", F.floor(F.col(order) / span))
    items = [(o, v, F.sum) for o, v in (sums or {}).items()] + [(o, v, F.max) for o, v in (maxima or {}).items()]
    totals = rows.groupBy(within, "_run").agg(*[f(v).alias(f"_t_{o}") for o, v, f in items])
    before = totals.select(within, "_run", *[f(f"_t_{o}").over(runs).alias(f"_b_{o}") for o, _, f in items])
    rows = rows.select("*", *[f(v).over(run).alias(f"_i_{o}") for o, v, f in items]).join(before, [within, "_run"])
    for o, _, f in items:
        inner, outer = F.col(f"_i_{o}"), F.col(f"_b_{o}")
        rows = rows.withColumn(o, F.greatest(inner, outer) if f is F.max else F.coalesce(inner, F.lit(0)) + F.coalesce(outer, F.lit(0)))
    return rows.drop("_run", *[c for o, _, _ in items for c in (f"_i_{o}", f"_b_{o}")])
