"""Durable answers: a task or a run that is made again calls the model for nothing it has answered."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from newsloom.operators import scorer as SC
from newsloom.operators.util import shared_folder


def counting(folder, fail=()):
    """A scorer that leaves one file per call in ``folder``; texts in ``fail`` raise."""
    def fn(text):
        import uuid
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(str(text))
        if text in fail:
            raise RuntimeError("down")
        return '{"relevance": 1}'
    return fn


def calls(folder):
    return len(os.listdir(folder))


def test_a_task_that_runs_again_calls_nothing_twice(spark):
    seen, kept = tempfile.mkdtemp(prefix="newsloom-calls-"), shared_folder(spark, "t-answers")
    arts = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "id long, content string").repartition(3, "id")
    got = SC.with_responses(arts, counting(seen), kept=kept, pause_sec=0)
    first = sorted(map(tuple, got.collect()))
    assert calls(seen) == 300 and len(first) == 300
    assert sorted(map(tuple, got.collect())) == first and calls(seen) == 300  # every task again
    changed = arts.withColumn("content", F.when(F.col("id") == 7, "other").otherwise(F.col("content")))
    assert SC.with_responses(changed, counting(seen), kept=kept, pause_sec=0).count() == 300
    assert 300 < calls(seen) <= 300 + SC.CHUNK  # the changed article's chunk only


def test_a_failed_run_goes_on_where_it_stopped(spark):
    seen, folder = tempfile.mkdtemp(prefix="newsloom-calls-"), shared_folder(spark, "t-answers")
    arts = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "id long, content string").coalesce(1)

    def stopping(answer):
        def fn(text):
            if text == "text 150":
                os._exit(1)  # the worker dies
            return answer(text)
        return fn

    try:
        SC.durable_responses(arts, stopping(counting(seen)), folder, pause_sec=0)
        raise AssertionError("the job should fail")
    except AssertionError:
        raise
    except Exception:
        pass
    before = calls(seen)
    assert 128 <= before < 200
    got = SC.durable_responses(arts, counting(seen), folder, pause_sec=0)
    assert got.count() == 200 and calls(seen) <= 200 + SC.CHUNK  # whole chunks before the stop are not asked again
    after = calls(seen)
    more = arts.unionByName(spark.createDataFrame([(900, "new")], "id long, content string"))
    assert SC.durable_responses(more, counting(seen), folder, pause_sec=0).count() == 201 and calls(seen) == after + 1
    assert SC.durable_responses(arts, counting(seen), folder, pause_sec=0).count() == 200 and calls(seen) == after + 1


def test_retries_pause_and_run_side_by_side(spark):
    seen = tempfile.mkdtemp(prefix="newsloom-calls-")
    arts = spark.createDataFrame([(i, "bad") for i in range(8)], "id long, content string").coalesce(1)
    begin = time.time()
    got = SC.with_responses(arts, counting(seen, fail=("bad",)), pause_sec=1.0, calls_at_once=8).collect()
    assert {r["response"] for r in got} == {SC.OFFLINE_ANSWER} and calls(seen) == 16
    assert 1.0 <= time.time() - begin < 8.0
    assert SC.with_responses(arts.where("false"), counting(seen)).count() == 0
