"""User scorer hook: run a Python callable per article, several at a time, and keep its answers."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.signals import OFFLINE_SIGNALS

# Retry policy and the offline answer used after the last failure.
ATTEMPTS = 2
PAUSE_SEC = 2.0
OFFLINE_ANSWER = json.dumps({k: OFFLINE_SIGNALS[k] for k in ("db_engine", "topic", "relevance",
                                                            "architectural_impact", "production_impact",
                                                            "security_impact", "retrieval_complexity")})

CALLS_AT_ONCE = 8  # of one task
CHUNK = 64  # articles whose answers are kept together


def _answer(fn: Callable[[str], str], text: str, attempts: int, pause_sec: float) -> str:
    for i in range(attempts):
        try:
            if (answer := fn(text)) is not None:
                return answer
        except Exception:  # a failing call is retried, then replaced
            pass
        if pause_sec and i + 1 < attempts:
            time.sleep(pause_sec)
    return OFFLINE_ANSWER


def _store(folder: str):
    """``(file system, path)`` of a local, HDFS or object-store URI, in a task."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def with_responses(articles: DataFrame, fn: Callable[[str], str], attempts: int = ATTEMPTS,
                   pause_sec: float = PAUSE_SEC, id_col: str = "id", text_col: str = "content",
                   prompt_mode: str | None = None, kept: str | None = None, calls_at_once: int = CALLS_AT_ONCE) -> DataFrame:
    """``(raw_id, response)`` from ``fn(text)`` for every article: Spark partitions the articles, each task makes up to
    ``calls_at_once`` calls at a time. ``fn`` is tried ``attempts`` times with a pause between; an exception or a None
    answer then falls back to the offline answer.

    With ``kept``, a shared folder, answers outlive tasks and runs: a task stores the answers of each chunk of articles
    under the chunk's fingerprint (ids, texts) before it goes on, so a task that runs again, on whatever executor, makes
    no call twice but for the chunk it was in. :func:`durable_responses` also skips articles answered in earlier runs.

    With ``prompt_mode`` ('weekly' / 'ai_radar') ``fn`` receives the mode's classification
    prompt (built JVM-side) instead of the bare text, as a model would."""
    if prompt_mode is not None:
        from ..functions.markdown import classify_prompt
        from ..sources.templates import classify_template
        articles = articles.withColumn(text_col, classify_prompt(classify_template(prompt_mode), F.col(text_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(kept) if kept else (None, None)
        if store:
            store.create_dir(top, recursive=True)
        with ThreadPoolExecutor(calls_at_once) as calls:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    ids, texts = (c.to_pylist() for c in batch.slice(at, CHUNK).columns)
                    file = None
                    if store:
                        name = hashlib.sha256(repr((ids, texts)).encode("utf-8", "replace")).hexdigest()
                        file = f"{top}/{name}.parquet"
                        if store.get_file_info(file).is_file:
                            yield from pq.read_table(file, filesystem=store).to_batches()
                            continue
                    answers = list(calls.map(lambda t: _answer(fn, t, attempts, pause_sec), texts))
                    out = pa.table({"raw_id": pa.array(ids, pa.int64()), "response": pa.array(answers, pa.string())})
                    if file:
                        from pyspark import TaskContext
                        draft = f"{top}/_{name}-{TaskContext.get().taskAttemptId()}"
                        pq.write_table(out, draft, filesystem=store)
                        if not store.get_file_info(file).is_file:  # else a twin of this task was first
                            store.move(draft, file)
                    yield from out.to_batches()
    return articles.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "raw_id LONG, response STRING")


def durable_responses(articles: DataFrame, fn: Callable[[str], str], folder: str, id_col: str = "id", **options) -> DataFrame:
    """:func:`with_responses` whose answers are a growing table in ``folder``: articles that it holds are not asked
    again, new answers are appended when all are there. Returns the answers of ``articles``."""
    spark = articles.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/answers")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        known = spark.read.schema("raw_id LONG, response STRING").parquet(f"{folder}/answers").select(F.col("raw_id").alias("_known"))
        open_ = articles.join(known, articles[id_col] == F.col("_known"), "left_anti")
    else:
        open_ = articles
    with_responses(open_, fn, id_col=id_col, kept=f"{folder}/chunks", **options).write.mode("append").parquet(f"{folder}/answers")
    answers = spark.read.schema("raw_id LONG, response STRING").parquet(f"{folder}/answers")
    asked = articles.select(F.col(id_col).alias("_id"))
    return answers.join(asked, answers["raw_id"] == F.col("_id"), "left_semi")


def length_scorer(text: str) -> str:
    """Deterministic stand-in for a model: signals from the text's length and line count."""
    if text is None:
        raise ValueError("no text")
    return json.dumps({"relevance": len(text) % 7, "architectural_impact": text.count("\n") % 7,
                       "db_engine": "PostgreSQL" if "the" in text else None})
