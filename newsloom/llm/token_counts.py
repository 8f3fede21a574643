"""Token counts by a separator scan over flat token files.

A flat file is nothing but token ids of fixed width, with an end-of-document id after each document and no index.
Files are read in blocks by many tasks; numpy finds the end ids of a block in one comparison, and a prefix scan over
the blocks' small summaries carries document numbers and open documents from block to block. The ids are read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, prefix_scan, shared_path, stored
from .tokenize import PLAIN_WORD_BPE, Vocabulary, encoded

END_ID = 49407  # the vocabulary's end-of-text id; special strings being plain text here, no text encodes to it
BLOCK_BYTES = 4 << 20
TASK_BYTES = 32 << 20


def _store(uri: str):
    """``(file system, path)`` of a local, HDFS or object-store URI, in a task."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def write_flat(docs: DataFrame, folder: str, vocabulary: Vocabulary = PLAIN_WORD_BPE, end_id: int = END_ID) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as flat files of unsigned 16-bit ids, one per input partition, and returns
    (stored) which document is where: file, ordinal, doc_id. A file gets its name when it is complete, and a task
    that runs again writes the same file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        store, top = _store(folder)
        store.create_dir(top, recursive=True)
        name, draft, ordinal = f"part-{task.partitionId():06d}.ids", f"{top}/_draft-{task.taskAttemptId()}", 0
        with store.open_output_stream(draft) as out:
            for rows, ids, ends in encoded(batches, vocabulary):
                out.write(np.insert(ids, ends, end_id).astype("<u2").tobytes())
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(range(ordinal, ordinal + n), pa.int64()), rows.column("doc_id")],
                    ["file", "ordinal", "doc_id"])
                ordinal += n
        store.move(draft, f"{top}/{name}")

    spark = docs.sparkSession
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)  # also there when no partition writes
    top.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(top)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        write, "file string, ordinal long, doc_id long")
    return stored(spark, rows, "places")


def separator_scan(spark: SparkSession, folder: str, end_id: int = END_ID, width: int = 2,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All documents of the flat files ``*.ids`` under ``folder``: file, ordinal (from 0), start, n_tokens (without
    the end id), ended (false: ids after a file's last end id). ``width``: bytes of an unsigned id.

    An empty file has no documents; two end ids in a row hold an empty one."""
    block_bytes -= block_bytes % width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "length")
    total = files.agg(F.sum("length")).first()[0] or 0
    file = F.element_at(F.split("path", "/"), -1)
    blocks = files.where(F.col("length") > 0).select(
        "path", "length", file.alias("file"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes))).alias("block"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                store, path = _store(b["path"])
                with store.open_input_file(path) as f:
                    f.seek(b["block"] * block_bytes)
                    ids = np.frombuffer(f.read(min(block_bytes, b["length"] - b["block"] * block_bytes)), f"<u{width}")
                at = np.flatnonzero(ids == end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["file"]]), pa.array([b["block"]], pa.int64()), pa.array([len(ids)], pa.int64()),
                     pa.array([len(at)], pa.int64()), pa.array([at.tolist()], pa.list_(pa.int64()))],
                    ["file", "block", "n_ids", "n_ends", "ends"])

    # One row per block: dealt by number, as their bytes are not in the rows.
    found = stored(spark, blocks.repartition(max(1, -(-total // TASK_BYTES)), "path", "block").mapInArrow(
        scan, "file string, block long, n_ids long, n_ends long, ends array<long>"), "ends")
    rows = prefix_scan(found, "block", "file", sums={"base": "n_ids", "before": "n_ends"})
    rows = rows.withColumn("last_end", F.when(F.col("n_ends") > 0, F.col("base") + F.element_at("ends", -1) + 1))
    rows = prefix_scan(rows, "block", "file", maxima={"carried": "last_end"})
    first = F.coalesce(F.col("carried"), F.lit(0))
    docs = rows.select("file", "before", "base", "ends", first.alias("first"), F.posexplode("ends").alias("k", "end")).select(
        "file", (F.col("before") + F.col("k")).alias("ordinal"),
        F.when(F.col("k") == 0, F.col("first")).otherwise(F.col("base") + F.get("ends", F.col("k") - 1) + 1).alias("start"),
        (F.col("base") + F.col("end")).alias("end"), F.lit(True).alias("ended"))
    rest = rows.groupBy("file").agg(
        F.sum("n_ends").alias("ordinal"), F.coalesce(F.max("last_end"), F.lit(0)).alias("start"),
        F.sum("n_ids").alias("end")).where(F.col("end") > F.col("start")).withColumn("ended", F.lit(False))
    return docs.unionByName(rest).select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended")


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count, read off flat token files of the whole table."""
    folder = shared_path(spark, "flat")
    places = write_flat(documents(spark, sf_dir, "doc_id", "text"), folder)
    return separator_scan(spark, folder).join(places, ["file", "ordinal"]).select(
        "doc_id", "n_tokens", "file", "ordinal", "start")
