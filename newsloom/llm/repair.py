"""Repair of conversation structure by a dynamic program over a grammar.

Every row of a conversation becomes a symbol: its role's initial and its fault. Conversations are cut into segments of
bounded length, and equal segments are one. Re-Pair rules shared by all segments replace frequent neighbours by new
symbols. A symbol stands for a min-plus matrix: for each two states of the role pattern ``(s?(ua)+)?`` the least cost
of the edits that lead from one to the other, with the edits' initials as a rope (two shared halves, not a copy).
Rule matrices are multiplied once, bottom-up; a segment is the product of its few symbols, and a conversation that of
its segments. Equal costs go to the ASCII-least initials: at equal cost and rows, no edit string is the beginning of
another (one more insertion costs more), so the order survives concatenation and the product stays associative.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.util import join_hot_split
from .common import stored

DELETE, RETYPE, INSERT, TRUNCATED = 4, 3, 3, 3  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired conversation ends with
ACCEPTED = (START, ASSISTANT)
# (state, initial) -> state of the role pattern.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL = ("su", "ua", "au")
# Symbols by initial (s, u, a, any other): sound, truncated, to be deleted.
INITIALS, SOUND, CUT, GONE = "suax", "suax", "SUAX", "1234"

SEGMENT_BITS = 12  # a segment has at most 2^12 rows
ROUNDS, RULES = 6, 32  # Re-Pair: rounds, and new rules in each
FIRST_RULE = 0x100  # code point of the first rule
FAN = 64  # matrices multiplied in one group


# ---- ropes and matrices ---------------------------------------------------------------------

class Rope:
    """A string of edit initials as two halves that other ropes may share, or a leaf."""
    __slots__ = ("left", "right", "leaf", "size")

    def __init__(self, leaf: str = "", left: Rope | None = None, right: Rope | None = None):
        self.leaf, self.left, self.right = leaf, left, right
        self.size = len(leaf) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if node.left is None:
                out.append(node.leaf)
            else:
                todo += (node.right, node.left)
        return "".join(out)

    def precedes(self, other: Rope) -> bool:
        """ASCII order. Halves that both share at the same place are not read."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y:
                continue
            if x.left is not None and (x.size >= y.size or y.left is None):
                a += (x.right, x.left)
                b.append(y)
            elif y.left is not None:
                b += (y.right, y.left)
                a.append(x)
            else:
                n = min(len(x.leaf), len(y.leaf))
                if x.leaf[:n] != y.leaf[:n]:
                    return x.leaf[:n] < y.leaf[:n]
                for rest, own in ((x.leaf[n:], a), (y.leaf[n:], b)):
                    if rest:
                        own.append(Rope(rest))
        return bool(b) and not a


Cell = tuple[int, Rope] | None


def better(a: Cell, b: Cell) -> Cell:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1] is b[1] or not b[1].precedes(a[1]) else b


def times(a: list[list[Cell]], b: list[list[Cell]]) -> list[list[Cell]]:
    """Min-plus product with the edits of the cheapest way."""
    out: list[list[Cell]] = []
    for row in a:
        cells: list[Cell] = [None] * 4
        for k, x in enumerate(row):
            if x is not None:
                for q, y in enumerate(b[k]):
                    if y is not None and (cells[q] is None or x[0] + y[0] <= cells[q][0]):
                        cells[q] = better(cells[q], (x[0] + y[0], x[1] + y[1]))
        out.append(cells)
    return out


def _closure() -> list[list[Cell]]:
    """Insertions, as many as pay: from a state to another over the pattern's user and assistant steps."""
    one: list[list[Cell]] = [[(0, Rope()) if p == q else None for q in range(4)] for p in range(4)]
    for (p, initial), q in STEPS.items():
        if initial != "s":
            one[p][q] = better(one[p][q], (INSERT, Rope("I")))
    return times(one, one)  # a third insertion leads back to a state that one reaches


INSERTIONS = _closure()


@dataclass
class Summary:
    """A run of rows: its matrix (insertions before each row included), first and last initial, and how many
    neighbours are no legal pair."""
    cells: list[list[Cell]]
    first: str
    last: str
    illegal: int

    def then(self, other: Summary) -> Summary:
        return Summary(times(self.cells, other.cells), self.first, other.last,
                       self.illegal + other.illegal + (self.last + other.first not in LEGAL))


def symbol(c: str) -> Summary:
    """Summary of one row's symbol."""
    kind = next(k for k in (SOUND, CUT, GONE) if c in k)
    initial, extra = INITIALS[kind.index(c)], TRUNCATED if kind is CUT else 0
    cells: list[list[Cell]] = [[(DELETE, Rope("D")) if p == q else None for q in range(4)] for p in range(4)]
    if kind is not GONE:
        for (p, to), q in STEPS.items():
            if to == initial:
                cells[p][q] = better(cells[p][q], (extra, Rope("K")))
            if to != "s":
                cells[p][q] = better(cells[p][q], (RETYPE + extra, Rope("R")))
    return Summary(times(INSERTIONS, cells), initial, initial, 0)


def summaries(rules: list[str]) -> dict[str, Summary]:
    """Summaries of all symbols and rules, bottom-up: a rule is the product of its two parts."""
    out = {c: symbol(c) for c in SOUND + CUT + GONE}
    for k, pair in enumerate(rules):
        out[chr(FIRST_RULE + k)] = out[pair[0]].then(out[pair[1]])
    return out


def product(parts: Iterator[Summary]) -> Summary:
    whole = None
    for part in parts:
        whole = part if whole is None else whole.then(part)
    return whole


CELLS = "costs array<long>, audits array<string>, first string, last string, illegal long"


def packed(s: Summary) -> tuple[list, list, str, str, int]:
    flat = [c for row in s.cells for c in row]
    return ([None if c is None else c[0] for c in flat], [None if c is None else str(c[1]) for c in flat],
            s.first, s.last, s.illegal)


def unpacked(costs, audits, first: str, last: str, illegal: int) -> Summary:
    flat = [None if a is None else (int(c), Rope(a)) for c, a in zip(costs, audits)]
    return Summary([flat[4 * p:4 * p + 4] for p in range(4)], first, last, int(illegal))


def cheapest(s: Summary) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    end = times([s.cells[START]], INSERTIONS)[0]
    best = None
    for q in ACCEPTED:
        best = better(best, end[q])
    return best[0], str(best[1])


# ---- rows to symbols -------------------------------------------------------------------------

def ordered(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) stored in order: gone (a null conversation), conv, turn, role, text, at.

    ``at`` ascends with conversation, turn (nulls first), role and text. Rows are dealt by range over the whole key
    with a row number behind it, so neither a hot conversation nor equal rows land in one task."""
    keyed = turns.select(F.col("conv_id").isNull().alias("gone"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
                         F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("_n"))
    key = ["gone", "conv", F.col("turn").asc_nulls_first(), "role", "text", "_n"]
    sorted_rows = keyed.repartitionByRange(*key).sortWithinPartitions(*key).drop("_n")
    return stored(turns.sparkSession, sorted_rows.withColumn("at", F.monotonically_increasing_id()), "turns")


def _last_mark(text: Column) -> Column:
    """Last character that is no ASCII white space; '' where there is none."""
    return F.regexp_extract(text, r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)


def faults(rows: DataFrame) -> DataFrame:
    """Stored ordered rows -> narrow rows: gone, conv, turn, at, fault (the first of blank, duplicate, truncated that a
    row has, else ''), symbol."""
    content = F.sha2(F.concat(F.col("conv").cast("string"), F.col("gone").cast("string"), F.lit(":"),
                              F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    initial = F.substring("role", 1, 1)
    end = _last_mark(F.col("text"))
    narrow = rows.select(
        "gone", "conv", "turn", "at", content.alias("_key"), (end == "").alias("_blank"),
        (~end.isin(".", "!", "?")).alias("_cut"), F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("_initial"))
    narrow = stored(rows.sparkSession, narrow, "faults")
    firsts = narrow.groupBy("_key").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    firsts = stored(rows.sparkSession, firsts, "firsts")
    marked = join_hot_split(narrow, firsts.drop("_n"), "_key", "left", firsts.select("_key", "_n"))
    fault = (F.when(F.col("_blank"), "blank").when(F.col("at") > F.col("_first"), "duplicate")
             .when(F.col("_cut"), "truncated").otherwise(""))
    marked = marked.withColumn("fault", fault)
    kind = (F.when(F.col("fault") == "", F.lit(SOUND)).when(F.col("fault") == "truncated", F.lit(CUT)).otherwise(F.lit(GONE)))
    return marked.select("gone", "conv", "turn", "at", "fault",
                         F.translate("_initial", INITIALS, "1234").cast("int").alias("_i"), kind.alias("_kind")).select(
        "gone", "conv", "turn", "at", "fault", F.expr("substring(_kind, _i, 1)").alias("symbol"))


def segments(symbols: DataFrame) -> DataFrame:
    """gone, conv, segment, begin (its first ``at``), n, symbols: runs of a conversation's rows, at most 2^12 each."""
    return symbols.groupBy("gone", "conv", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(
        F.min("at").alias("begin"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "symbol"))), lambda s: s["symbol"]), "").alias("symbols"))


# ---- grammar ---------------------------------------------------------------------------------

def re_pair(sequences: DataFrame, rounds: int = ROUNDS, rules_per_round: int = RULES) -> tuple[DataFrame, list[str]]:
    """Rules for the most frequent neighbours of distinct ``sequences`` (symbols, uses), and the sequences with
    ``short`` written in them. Only the few pairs chosen in a round reach the driver."""
    spark, rules = sequences.sparkSession, []
    current = stored(spark, sequences.withColumn("short", F.col("symbols")), "grammar")
    for _ in range(rounds):
        chars = F.split("short", "")
        pairs = current.where(F.length("short") > 1).select("uses", chars.alias("c")).select("uses", F.explode(F.transform(
            F.sequence(F.lit(0), F.size("c") - 2), lambda i: F.concat(F.get("c", i), F.get("c", i + 1)))).alias("pair"))
        chosen = pairs.groupBy("pair").agg(F.sum("uses").alias("uses")).where("uses > 1").orderBy(
            F.col("uses").desc(), "pair").limit(rules_per_round).collect()
        if not chosen:
            break
        short = F.col("short")
        for r in chosen:
            short = F.replace(short, F.lit(r["pair"]), F.lit(chr(FIRST_RULE + len(rules))))
            rules.append(r["pair"])
        current = stored(spark, current.withColumn("short", short), "grammar")
    return current, rules


def evaluated(sequences: DataFrame, rules: list[str]) -> DataFrame:
    """The summary of each distinct sequence: symbols, and the columns of CELLS."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = summaries(rules)
        for part in batches:
            rows = [packed(product(known[c] for c in short)) for short in part["short"]]
            out = pd.DataFrame(rows, columns=["costs", "audits", "first", "last", "illegal"])
            out.insert(0, "symbols", part["symbols"].to_numpy())
            yield out

    return sequences.select("symbols", "short").mapInPandas(run, f"symbols string, {CELLS}")


def joined(parts: DataFrame) -> DataFrame:
    """Summaries of segments (gone, conv, segment and CELLS) multiplied to one per conversation, FAN at a time."""

    def multiply(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rows = part.sort_values("segment")[["costs", "audits", "first", "last", "illegal"]].itertuples(index=False)
        return pd.DataFrame([(*key, *packed(product(unpacked(*r) for r in rows)))],
                            columns=["gone", "conv", "segment", "costs", "audits", "first", "last", "illegal"])

    spark = parts.sparkSession
    parts = stored(spark, parts, "parts")
    many = parts.groupBy("gone", "conv").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    whole = parts.join(many, ["gone", "conv"], "left_anti")
    while not many.isEmpty():
        rest = parts.join(many, ["gone", "conv"], "left_semi")
        grouped = rest.withColumn("above", F.floor(F.col("segment") / FAN).cast("long")).groupBy("gone", "conv", "above")
        parts = stored(spark, grouped.applyInPandas(multiply, f"gone boolean, conv long, segment long, {CELLS}"), "parts")
        many = parts.groupBy("gone", "conv").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        whole = whole.unionByName(parts.join(many, ["gone", "conv"], "left_anti"))
    return whole


def audits(parts: DataFrame) -> DataFrame:
    """gone, conv, cost, audit, illegal of every conversation from its summary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [cheapest(unpacked(*r)) for r in part[["costs", "audits", "first", "last", "illegal"]].itertuples(index=False)]
            yield pd.DataFrame({"gone": part["gone"], "conv": part["conv"], "cost": [c for c, _ in found],
                                "audit": [a for _, a in found], "illegal": part["illegal"]})

    return parts.mapInPandas(run, "gone boolean, conv long, cost long, audit string, illegal long")


# ---- applying the edits -----------------------------------------------------------------------

def edits(found: DataFrame, runs: DataFrame) -> DataFrame:
    """Each segment's own piece of its conversation's audit: gone, conv, at (the segment's first), piece, before (rows
    that the repaired conversation has before it), system (1 where it begins with a system row).

    The repaired roles follow from the pattern: its length is odd just where a system row is first."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for gone, conv, audit, listed in part.itertuples(index=False):
                letters = np.frombuffer(audit.encode(), np.uint8)
                own = np.flatnonzero(letters != ord("I"))  # a row's insertions go with it, the last ones with the last row
                kept = np.concatenate([[0], np.cumsum(letters != ord("D"))])
                rows, begin = 0, 0
                for k, r in enumerate(listed):
                    rows += r["n"]
                    end = len(letters) if k + 1 == len(listed) else int(own[rows - 1]) + 1
                    out.append((gone, conv, r["begin"], audit[begin:end], int(kept[begin]), int(kept[-1]) % 2))
                    begin = end
            yield pd.DataFrame(out, columns=["gone", "conv", "at", "piece", "before", "system"])

    listed = runs.groupBy("gone", "conv").agg(F.array_sort(F.collect_list(F.struct("begin", "n"))).alias("listed"))
    rows = found.join(listed, ["gone", "conv"]).select("gone", "conv", "audit", "listed")
    return rows.mapInPandas(cut, "gone boolean, conv long, at long, piece string, before long, system int")


def _in_order(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rows and the audit pieces before them, a conversation in one task in order (a digest has to read it so)."""
    mine = rows.select("gone", "conv", "at", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("string").alias("piece"),
                       F.lit(None).cast("long").alias("before"), F.lit(None).cast("int").alias("system"))
    theirs = pieces.select("gone", "conv", "at", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"),
                           F.lit(None).cast("string").alias("text"), "piece", "before", "system")
    both = mine.unionByName(theirs)
    return both.repartition("gone", "conv").sortWithinPartitions("gone", "conv", "at", "kind")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """From ordered rows and pieces: ((gone, conv), place, role, text) of every repaired row, and ((gone, conv), -1,
    None, None) once a conversation, after its rows. Holds one batch and one piece."""
    key, piece, at, place, system = None, "", 0, 0, 0

    def role() -> str:
        return "user" if (place - system) % 2 == 0 else "assistant"

    for batch in batches:
        for gone, conv, _, kind, own, text, new, before, first in zip(*(c.to_pylist() for c in batch.columns)):
            if (gone, conv) != key:
                if key is not None:
                    for _ in piece[at:]:  # insertions at the end
                        yield key, place, role(), ""
                        place += 1
                    yield key, -1, None, None
                key = (gone, conv)
            if kind == 0:
                piece, at, place, system = new, 0, before, first
                continue
            while piece[at] == "I":
                yield key, place, role(), ""
                place, at = place + 1, at + 1
            if piece[at] != "D":
                yield key, place, own if piece[at] == "K" else role(), text
                place += 1
            at += 1
    if key is not None:
        for _ in piece[at:]:
            yield key, place, role(), ""
            place += 1
        yield key, -1, None, None


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([None if k[0] else k[1] for k, *_ in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())],
            ["conv_id", "turn", "role", "text"])
    rows = []
    for r in _repaired(batches):
        if r[1] >= 0:
            rows.append(r)
            if len(rows) == 1024:
                yield batch(rows)
                rows = []
    yield batch(rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, out, digest = [], [], hashlib.sha256()
    for key, place, role, text in _repaired(batches):
        if place < 0:
            keys.append(key)
            out.append(digest.hexdigest())
            digest = hashlib.sha256()
        else:
            digest.update((("\n" if place else "") + role + ":" + text).encode())
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.int64()),
                                      pa.array(out, pa.string())], ["gone", "conv", "sha"])


@dataclass
class Repair:
    """``found``: per conversation conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``digest``:
    conv_id, repaired_sha256. ``turns``: the repaired rows, conv_id, turn (from 0), role, text."""
    found: DataFrame
    digest: DataFrame
    turns: DataFrame


def repair(turns: DataFrame) -> Repair:
    """The cheapest edits that give every conversation of ``turns`` (conv_id, turn, role, text) roles of the pattern
    ``(s?(ua)+)?`` (see the module).

    Rows go by turn, nulls first, then role and text. Null roles and texts are one space. A null conversation is one
    of its own. A role is known by its first character; an empty or other role is never kept. Repeated rows are
    duplicates but for the first. Other columns are left out; an empty table has no conversations. A conversation's
    text is read in order by one task, as a digest needs, row by row; everything else is dealt in bounded segments."""
    spark = turns.sparkSession
    rows = ordered(turns)
    symbols = stored(spark, faults(rows), "symbols")
    runs = stored(spark, segments(symbols), "segments")
    distinct = runs.groupBy("symbols").agg(F.count(F.lit(1)).alias("uses"))
    short, rules = re_pair(distinct)
    known = stored(spark, evaluated(short, rules), "summaries")
    parts = runs.select("gone", "conv", "segment", "symbols").join(known, "symbols").drop("symbols")
    found = stored(spark, audits(joined(parts)), "audits")
    stats = symbols.groupBy("gone", "conv").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("low"), F.max("turn").alias("high"))
    turns_seen = symbols.where("turn is not null").select("gone", "conv", "turn").distinct().groupBy("gone", "conv").agg(
        F.count(F.lit(1)).alias("seen"))
    stats = stats.join(turns_seen, ["gone", "conv"], "left")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("seen"), F.lit(0).cast("long"))
    conv_id = F.when(~F.col("gone"), F.col("conv")).alias("conv_id")
    per = found.join(stats, ["gone", "conv"]).select(conv_id, gaps.alias("gaps"), "blank", "duplicate", "truncated",
                                                     "illegal", "cost", "audit")
    in_order = _in_order(rows, edits(found, runs))
    digest = in_order.mapInArrow(_digests, "gone boolean, conv long, sha string").select(
        conv_id, F.col("sha").alias("repaired_sha256"))
    return Repair(per, digest, in_order.mapInArrow(_turns, "conv_id long, turn long, role string, text string"))


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults chosen by crc32 of ``conv_id:turn`` (see the query's contract)."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("_d"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    times_kept = F.when(F.col("_d") == 0, F.array()).when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times_kept.cast("array<int>")).alias("_c")
                       ).drop("_c")


def op12_re_pair_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages all conversations and repairs them; conversations without a row left give zeros and empty strings."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    fixed = repair(damage(turns))
    every = turns.select("conv_id").distinct().alias("e")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    f, d = fixed.found.alias("f"), fixed.digest.alias("d")
    out = every.join(f, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left").join(
        d, F.col("e.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    return out.select(F.col("e.conv_id").alias("conv_id"), *[F.coalesce(F.col(f"f.{c}"), F.lit(0).cast("long")).alias(c) for c in counts],
                      F.coalesce("f.audit", F.lit("")).alias("audit"),
                      F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
