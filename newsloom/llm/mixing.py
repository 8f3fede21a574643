"""Mixing sources to target weights by temperature.

Each source's share of all tokens is raised to an exponent and normalised; the exponent is bisected until the
weights meet a target entropy, or until no source is repeated more often than allowed. The weights are then met by
budgeted block permutations: a source's documents fall into hashed blocks, every epoch is a new permutation of
them, and the last epoch stops where the source's token budget ends.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored
from .tokenize import BYTE_BPE, Vocabulary, encoded

BLOCK_TOKENS = 4_000_000
FINE = 16_384  # most blocks of a source
SECTIONS = 16  # parts into which one pass over the shares cuts the exponent's range
REPETITIONS = 2.0


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet: the weights' entropy (nats), or a most of repetitions of any source, under a
    token budget (None: the least budget at which no document is left out)."""
    entropy: float | None = None
    repetitions: float | None = REPETITIONS
    budget: float | None = None


def document_tokens(docs: DataFrame, vocabulary: Vocabulary = BYTE_BPE) -> DataFrame:
    """One narrow row per document of ``docs`` (doc_id, source, text): source, fine block, key (a hash of id and text)
    and tokens (an end id included)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, ends in encoded(batches, vocabulary):
            yield pa.RecordBatch.from_arrays(
                [rows.column("source"), rows.column("fine"), rows.column("key"),
                 pa.array(np.diff(ends, prepend=0) + 1, pa.int64())], ["source", "fine", "key", "tokens"])

    return docs.select("source", fine_block().alias("fine"), row_key().alias("key"), "text").mapInArrow(
        count, "source string, fine int, key long, tokens long")


def source_tokens(docs: DataFrame, vocabulary: Vocabulary = BYTE_BPE) -> DataFrame:
    """Tokens by source and fine block; ``docs``: doc_id, source, text."""
    return block_tokens_of(document_tokens(docs, vocabulary))


def block_tokens_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "fine").agg(F.sum("tokens").alias("tokens"))


def row_key(seed: int = 0) -> Column:
    """A hash of a row's id and text: equal rows share it."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def fine_block(seed: int = 0) -> Column:
    """A row's fine block, by doc_id and text: different texts of a hot id fall into different blocks."""
    return F.pmod(row_key(seed), F.lit(FINE)).cast("int")


def _statistics(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """``(sum of p^a, sum of p^a ln p)`` for each exponent, in one pass over the shares."""
    cols = []
    for a in exponents:
        power = F.pow("p", F.lit(a))
        cols += [F.sum(power), F.sum(power * F.log("p"))]
    row = shares.agg(*cols).first()
    return [(row[2 * k], row[2 * k + 1]) for k in range(len(exponents))]


def bisect_exponent(shares: DataFrame, target: Target, rounds: int = 8) -> float:
    """The largest exponent in [0, 1] whose weights have at least the target entropy, or the smallest that keeps
    to the repetitions (0 flattens most; 1 leaves the shares as they are). ``shares``: p, tokens per source.

    Both are monotone in the exponent. Each round cuts the range into SECTIONS with one aggregate."""
    low_p, high_p, total = shares.agg(F.min("p"), F.max("p"), F.sum("tokens")).first()
    if low_p is None or low_p == high_p:
        return 1.0

    def flat_enough(a: float, z: float, s: float) -> bool:
        return math.log(z) - a * s / z >= target.entropy

    def kept(a: float, z: float, s: float) -> bool:
        if target.budget is None:
            return (high_p / low_p) ** (1 - a) <= target.repetitions
        return target.budget * max(low_p ** a / low_p, high_p ** a / high_p) / z / total <= target.repetitions

    holds: Callable[[float, float, float], bool] = flat_enough if target.entropy is not None else kept
    upward = target.entropy is None  # whether larger exponents hold
    begin, end = 0.0, 1.0
    for _ in range(rounds):
        grid = [begin + (end - begin) * k / SECTIONS for k in range(SECTIONS + 1)]
        good = [holds(a, z, s) for a, (z, s) in zip(grid, _statistics(shares, grid))]
        if all(good):
            return grid[0] if upward else grid[-1]
        if not any(good):
            return grid[-1] if upward else grid[0]
        k = good.index(True) if upward else good.index(False)
        begin, end = grid[k - 1], grid[k]
    return end if upward else begin


def mixture(fine: DataFrame, target: Target, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """The block plan: source, block, epoch, n_blocks, tokens, before (tokens of the epoch before the block), room
    (tokens of the block that fit the budget), epoch_tokens, budget, weight. One row per block and epoch used."""
    spark = fine.sparkSession
    per = fine.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = per.agg(F.sum("tokens")).first()[0]
    if not total:
        return spark.createDataFrame([], "source string, block int, epoch int, n_blocks int, tokens long, before long, "
                                         "room long, epoch_tokens long, budget long, weight double")
    shares = stored(spark, per.withColumn("p", F.col("tokens") / F.lit(total)), "shares")
    a = bisect_exponent(shares, target)
    z = _statistics(shares, [a])[0][0]
    weight = F.pow("p", F.lit(a)) / F.lit(z)
    budget = target.budget
    if budget is None:
        budget = shares.agg(F.max(F.col("tokens") / weight)).first()[0]
    plan = shares.select(
        "source", weight.alias("weight"), F.col("tokens").alias("epoch_tokens"),
        # The last token's rounding must not cut the source that sets the budget.
        F.floor(F.lit(budget) * weight + 0.5).cast("long").alias("budget"),
        F.least(F.lit(FINE), F.ceil(F.col("tokens") / block_tokens)).cast("int").alias("n_blocks"))
    blocks = fine.alias("f").join(plan.alias("p"), F.col("f.source").eqNullSafe(F.col("p.source"))).groupBy(
        "p.source", "weight", "epoch_tokens", "budget", "n_blocks",
        F.pmod("fine", "n_blocks").alias("block")).agg(F.sum("tokens").alias("tokens"))
    epochs = F.floor((F.col("budget") - 1) / F.col("epoch_tokens")).cast("int")
    rows = blocks.where(F.col("budget") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs)))
    turn = Window.partitionBy("source", "epoch").orderBy(
        F.xxhash64(F.lit(seed), "source", "epoch", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("tokens").over(turn), F.lit(0)))
    left = F.col("budget") - F.col("epoch").cast("long") * F.col("epoch_tokens") - F.col("before")
    return rows.withColumn("room", F.least("tokens", left)).where(F.col("room") > 0).select(
        "source", "block", "epoch", "n_blocks", "tokens", "before", "room", "epoch_tokens", "budget", "weight")


def mix(docs: DataFrame, target: Target = Target(), vocabulary: Vocabulary = BYTE_BPE,
        block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """``docs`` (with doc_id, source, text) as often as the mixture takes them, with ``mix_epoch`` and ``mix_at``
    (place in the mixture, 0 to 1: sorted by it, sources interleave by their weights).

    By default no document is left out: the largest source relative to its weight is used once, others up to
    twice. With a smaller budget, a block on the edge gives documents in hashed order while they fit, repeated rows all
    or none. A null source is a source; a null text is one end id; extra columns are kept; an empty table stays empty.
    Texts are encoded once, into one narrow stored row each, which also decides the edges. Text is shuffled only where
    the block plan or the rows chosen at the edges are too many to broadcast."""
    spark = docs.sparkSession
    narrow = stored(spark, document_tokens(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), "text"), vocabulary), "tokens")
    plan = stored(spark, mixture(block_tokens_of(narrow), target, block_tokens, seed), "plan")
    plan = plan.select(*[F.col(c).alias(f"_p_{c}") for c in plan.columns])
    sources = plan.select(F.col("_p_source").alias("_source"), F.col("_p_n_blocks").alias("_n")).distinct()

    def placed(rows: DataFrame, source: Column) -> DataFrame:
        """Rows (with _fine and _key) once per epoch that their block is used in."""
        left = rows.join(sources, source.eqNullSafe(F.col("_source"))).withColumn("_block", F.pmod("_fine", "_n"))
        return left.join(plan, F.col("_source").eqNullSafe(F.col("_p_source")) & (F.col("_block") == F.col("_p_block"))
                         ).withColumn("_edge", F.col("_p_room") < F.col("_p_tokens")).withColumn(
            "_turn", F.xxhash64(F.lit(seed), "_p_epoch", "_key"))

    # The rows that fit at an edge, from the narrow table.
    block = ["_p_source", "_p_block", "_p_epoch"]
    edge = placed(narrow.select(F.col("source").alias("_of"), F.col("fine").alias("_fine"), F.col("key").alias("_key"),
                                "tokens"), F.col("_of")).where("_edge")
    per_key = edge.groupBy(*block, "_turn", "_key", "_p_room").agg(F.sum("tokens").alias("_tokens"))
    so_far = F.sum("_tokens").over(Window.partitionBy(*block).orderBy("_turn", "_key").rowsBetween(
        Window.unboundedPreceding, 0))
    fits = per_key.withColumn("_sum", so_far).where(F.col("_sum") <= F.col("_p_room")).select(
        F.col("_p_source").alias("_f_source"), F.col("_p_epoch").alias("_f_epoch"), F.col("_key").alias("_f_key"))
    fits = stored(spark, fits, "fits")

    own = docs.columns
    rows = placed(docs.withColumns({"_fine": fine_block(), "_key": row_key()}), F.col("source").cast("string"))
    inside = F.pmod("_turn", F.lit(1 << 20)) / F.lit(float(1 << 20))
    at = (F.col("_p_epoch").cast("double") * F.col("_p_epoch_tokens") + F.col("_p_before")
          + inside * F.col("_p_room")) / F.col("_p_budget")
    keep = [*own, F.col("_p_epoch").alias("mix_epoch"), at.alias("mix_at")]
    chosen = rows.where("_edge").join(fits, F.col("_p_source").eqNullSafe(F.col("_f_source")) & (
        F.col("_p_epoch") == F.col("_f_epoch")) & (F.col("_key") == F.col("_f_key")), "left_semi")
    return rows.where("not _edge").select(*keep).unionByName(chosen.select(*keep))


def in_mixture_order(mixed: DataFrame) -> DataFrame:
    """Rows of :func:`mix` by ``mix_at``: partitions, and rows inside them, follow each other in the mixture's order, in
    which sources interleave by their weights and each epoch's blocks come in their permutation."""
    order = ["mix_at", F.xxhash64("doc_id", "text"), F.monotonically_increasing_id()]
    keyed = mixed.withColumns({"_h": order[1], "_n": order[2]})
    return keyed.repartitionByRange("mix_at", "_h", "_n").sortWithinPartitions("mix_at", "_h", "_n").drop("_h", "_n")


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table mixed so that no source is repeated more than twice: doc_id, source, epoch, mix_at."""
    return mix(documents(spark, sf_dir, "doc_id", "source", "text")).select(
        "doc_id", "source", F.col("mix_epoch").alias("epoch"), "mix_at")
