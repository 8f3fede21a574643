"""Conversation repair against an exhaustive search, with every kind of fault, nulls, ties, repeats and long runs."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from newsloom.llm import repair as R

SPACE = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def marked(rows):
    """(role, text, fault) of one conversation's rows (turn, role, text), and the counts."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
    out, seen = [], set()
    for _, role, text in rows:
        words = SPACE.findall(text)
        fault = ("blank" if not words else "duplicate" if (role, text) in seen else
                 "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((role, text, fault))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = {f: sum(x[2] == f for x in out) for f in ("blank", "duplicate", "truncated")}
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    return out, (gaps, count["blank"], count["duplicate"], count["truncated"], illegal)


def searched(rows):
    """Cost, audit and digest by trying all edits."""
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None
    choices = [["D"] if f in ("blank", "duplicate") else ["K", "user", "assistant", "D"][role == "":] for role, _, f in rows]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for picks in itertools.product(*choices):
            cost, audit, made = 0, "", []
            for k in range(len(rows) + 1):
                cost += 3 * len(gaps[k])
                audit += "I" * len(gaps[k])
                made += [(r, "") for r in gaps[k]]
                if k < len(rows):
                    role, text, fault = rows[k]
                    pick = picks[k]
                    cost += {"K": 0, "D": 4}.get(pick, 3) + (3 if fault == "truncated" and pick != "D" else 0)
                    audit += pick if pick in "KD" else "R"
                    if pick != "D":
                        made.append((role if pick == "K" else pick, text))
            if PATTERN.fullmatch("".join(r[:1] for r, _ in made)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return best


def conversations():
    rng = random.Random(5)
    texts = ["Fine.", "cut off", "  ", "", None, "What?", "Fine.  \n", "naïve end é", "x.", " "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 3)):
            rows.append((conv, rng.choice([turn, turn, None, 5]), rng.choice(roles), rng.choice(texts)))
    rows += [(None, 0, "user", "null id."), (None, 1, "assistant", "fine."), (70, 0, "user", "same."), (70, 0, "user", "same."),
             (71, 0, "system", "s."), (71, 1, "user", "u."), (71, 2, "assistant", "a.")]
    return rows


def results(fixed):
    digest = {r["conv_id"]: r["repaired_sha256"] for r in fixed.digest.collect()}
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                           digest[r["conv_id"]]) for r in fixed.found.collect()}


def test_repair_equals_all_edits_tried(spark):
    rows = conversations()
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(3) for c in ("at", "gone", "segment", "audit", "piece")})
    got = results(R.repair(table.repartition(3)))
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).append(row)
    assert set(got) == set(by)
    for conv, own in by.items():
        found, counts = marked(own)
        assert got[conv] == (*counts, *searched(found)), (conv, own)


def test_segments_make_no_difference(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"t{t}.", f"u{t}"]))
            for c, n in ((1, 300), (2, 40), (3, 1)) for t in range(n)]
    table = spark.createDataFrame(rows, SCHEMA)
    whole = R.repair(table)
    want, turns = results(whole), sorted(map(tuple, whole.turns.collect()))
    monkeypatch.setattr(R, "SEGMENT_BITS", 3)
    monkeypatch.setattr(R, "FAN", 3)
    parts = R.repair(table)
    assert results(parts) == want and sorted(map(tuple, parts.turns.collect())) == turns
    for conv in (1, 2, 3):
        own = [t for t in turns if t[0] == conv]
        assert [t[1] for t in own] == list(range(len(own))) and PATTERN.fullmatch("".join(t[2][0] for t in own))
        assert hashlib.sha256("\n".join(f"{t[2]}:{t[3]}" for t in own).encode()).hexdigest() == want[conv][-1]


def test_grammar_writes_the_same_sequences(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("suaUA1") for _ in range(rng.randint(1, 60))) for _ in range(50)] + ["ua" * 40, "u"]
    short, rules = R.re_pair(spark.createDataFrame([(t, 2) for t in texts], "symbols string, uses long"), 4, 5)
    def spelt(c):
        return c if ord(c) < R.FIRST_RULE else "".join(map(spelt, rules[ord(c) - R.FIRST_RULE]))
    got = short.collect()
    assert sorted(r["symbols"] for r in got) == sorted(texts) and rules
    assert all("".join(map(spelt, r["short"])) == r["symbols"] for r in got)
    known = R.summaries(rules)
    for r in got:
        plain = R.product(R.symbol(c) for c in r["symbols"])
        assert R.packed(plain) == R.packed(R.product(known[c] for c in r["short"]))


def test_ropes_compare_like_strings():
    rng = random.Random(4)
    ropes = [R.Rope(rng.choice(["K", "D", "IK", "R", "DI"])) for _ in range(6)]
    for _ in range(200):
        ropes.append(rng.choice(ropes) + rng.choice(ropes[-8:]))
    for _ in range(400):
        a, b = rng.choice(ropes[:60]), rng.choice(ropes[:60])
        assert a.precedes(b) == (str(a) < str(b)) and a.size == len(str(a))


def test_empty_table(spark):
    fixed = R.repair(spark.createDataFrame([], SCHEMA))
    assert fixed.found.count() == 0 and fixed.digest.count() == 0 and fixed.turns.count() == 0


def test_op12_on_a_table(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}. Yes!") for c in range(40) for t in range(3)]
    rows += [(None, None, None, None), (99, 0, "user", "x" * 70000)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in R.op12_re_pair_repair(spark, str(tmp_path)).collect()}
    by = {}
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own = by.setdefault(conv, [])
        own += [(turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    assert set(got) == set(by)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for conv, own in by.items():
        found, counts = marked(own)
        assert got[conv] == ((*counts, *searched(found)) if own else nothing), conv
