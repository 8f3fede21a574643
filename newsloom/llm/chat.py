"""Reply trees to conversations.

Messages form trees by their parent. Root-to-leaf paths come from iterative self-joins that double their reach: a
table of each message's ancestor 2^k steps up, joined with itself once per k, then walked down from the leaves.
Paths are ranked by their score, and each chosen one becomes one conversation in a template with a loss mask.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

# The template. Escapes are a backslash and a letter, so that no text or role holds '#', '<' or ':' after it.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"
ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
LEARNED_ROLE = "assistant"


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    """The inverse of ``escape``: the backslash's own code goes last, as no other code can overlap it."""
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def paths(nodes: DataFrame, max_rounds: int = 40) -> DataFrame:
    """All root-to-leaf paths of ``nodes`` (tree, node, parent): rows tree, leaf, node, up (steps from the leaf).

    A parent that is null or not in the tree makes a root. Messages on a cycle, and those that hang on one, have no
    path from a root and are left out. ``node`` is unique in its tree. Reach doubles each round, so a tree of depth d
    takes about log2 d joins; a pointer table keeps only the messages that still have an ancestor that far up."""
    spark = nodes.sparkSession
    nodes = stored(spark, nodes.select("tree", "node", "parent"), "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"))
    jump = stored(spark, nodes.where(F.col("parent").isNotNull()).join(known, ["tree", "parent"], "left_semi").select(
        "tree", "node", F.col("parent").alias("anc")), "jump")
    jumps = []
    while not jump.isEmpty() and len(jumps) < max_rounds:
        jumps.append(jump)
        up = jump.select("tree", F.col("node").alias("anc"), F.col("anc").alias("anc2"))
        jump = stored(spark, jump.join(up, ["tree", "anc"]).select("tree", "node", F.col("anc2").alias("anc")), "jump")
        # On a tree of n messages nothing has an ancestor n or more steps up, but on a cycle.
        if len(jumps) >= 2 and 2 ** len(jumps) >= nodes.groupBy("tree").count().agg(F.max("count")).first()[0]:
            break
    lost = jump if not jump.isEmpty() else None
    parents = (jumps[0] if jumps else jump).select("tree", F.col("anc").alias("node")).distinct()
    walk = nodes.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node",
                                                                    F.lit(0).cast("long").alias("up"))
    if lost is not None:
        walk = walk.join(lost.select("tree", "node").distinct(), ["tree", "node"], "left_anti")
    for k in range(len(jumps) - 1, -1, -1):
        more = walk.join(jumps[k], ["tree", "node"]).select(
            "tree", "leaf", F.col("anc").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        walk = stored(spark, walk.unionByName(more), "walk")
    return walk


def chosen_paths(nodes: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """Paths of the ``per_tree`` best branches of each tree (None: all): adds rank (from 1) and score.

    A branch's score is the mean of its messages' (null: 0); ties go to the smaller leaf."""
    walk = paths(nodes)
    score = nodes.select("tree", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("s"))
    branch = walk.join(score, ["tree", "node"]).groupBy("tree", "leaf").agg(F.avg("s").alias("score"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    branch = branch.withColumn("rank", rank)
    if per_tree is not None:
        branch = branch.where(F.col("rank") <= per_tree)
    return walk.join(branch, ["tree", "leaf"])


def format_paths(nodes: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """``nodes`` (tree, node, parent, role, text, score) -> one row per chosen path: tree, rank, leaf, score,
    formatted, loss (spans ``begin, length`` of the learned texts in ``formatted``, in code points).

    Null roles and texts are empty. One output row holds one conversation whole; nothing else is gathered."""
    walk = chosen_paths(nodes, per_tree)
    body = nodes.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    learned = F.col("role") == LEARNED_ROLE
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(AFTER_ROLE))
    turn = F.struct((-F.col("up")).alias("at"), head.alias("head"), escape(F.col("text")).alias("body"), learned.alias("learned"))
    rows = walk.join(body, ["tree", "node"]).groupBy("tree", "leaf", "rank", "score").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"))
    formatted = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))))
    # Lengths first, then one running sum over them.
    sizes = F.transform("turns", lambda t: F.struct(
        F.length(t["head"]).alias("h"), F.length(t["body"]).alias("b"), t["learned"].alias("l")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:long,length:long>>").alias("spans"))
    loss = F.aggregate("sizes", start, lambda acc, t: F.struct(
        (acc["at"] + t["h"] + t["b"] + len(CLOSE)).alias("at"),
        F.when(t["l"], F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + t["h"]).alias("begin"), t["b"].cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return rows.select("tree", "rank", "leaf", "score", formatted.alias("formatted"), sizes.alias("sizes")).select(
        "tree", "rank", "leaf", "score", "formatted", loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.split(formatted, CLOSE.replace("\\", "\\\\"))
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    def turn(p: Column) -> Column:
        at = F.locate(AFTER_ROLE, p)
        return F.struct(unescape(F.substring(p, len(OPEN) + 1, at - len(OPEN) - 1)).alias("role"),
                        unescape(F.substring(p, at + len(AFTER_ROLE), F.length(p))).alias("text"))
    return F.transform(parts, turn)


def chains(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Conversations as reply trees: each row answers the one before it by turn. Rows with one turn number go by
    role and text, null turns first. A null conversation is one of its own (its tree key is null-safe text)."""
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    keyed = turns.select(F.col(conversation).alias("tree"), "turn", "role", "text")
    keyed = keyed.withColumn("tree", F.struct(F.col("tree").isNull().alias("none"), F.coalesce(
        F.col("tree"), F.lit(0).cast("long")).alias("id")))
    rows = keyed.withColumn("node", place)
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                       F.lit(0.0).alias("score"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> conv_id, formatted, loss: one row per conversation. Null texts and
    roles are empty, other columns are left out, an empty table has no conversations."""
    nodes = stored(turns.sparkSession, chains(turns), "chains")
    rows = format_paths(nodes, per_tree=1)
    return rows.select(F.when(~F.col("tree.none"), F.col("tree.id")).alias("conv_id"), "formatted", "loss")


def digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from their text and loss spans."""
    turns = read_turns(F.col("formatted"))
    said = F.transform("loss", lambda s: unescape(F.substr("formatted", s["begin"].cast("int") + 1, s["length"].cast("int"))))
    rows = formatted.select("conv_id", "formatted", turns.alias("turns"), F.concat_ws("", said).alias("said"))
    listed = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return digests(format_conversations(turns.unionByName(probe)))
