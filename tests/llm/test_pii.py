"""Personal data: rules against the plain patterns, message passing against all labellings, and what the field adds."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (2 if k % 2 else 1)
            total += v - 9 if v > 9 else v
        return total % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    return sorted((m.start(), kinds.index(k), m.end()) for k, m in out)


CASES = ["", "a@b.c", "a@b.c@d.e x@y", "x@@a.b", "d.e@f.g@h.i@j", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255", "01.002.3.0004",
         "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "+1 (743) 555-3824 éeux", "+1+12345678901", "+1 ((((",
         "é 日本 a.b@c-d.e1 +49 170 1234567.", "1" * 3000, "no" * 4000 + "@", "1." * 2000, "@" * 500 + "a.b", "+12345678.", "٣.٣.٣.٣"]


@pytest.mark.parametrize("text", CASES)
def test_rules_equal_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="019+.@- ()a%é", max_size=60))
def test_rules_equal_the_patterns_on_any_text(text):
    assert pii.base_spans(text) == plain(text)


def test_messages_equal_all_labellings():
    """On a graph without loops message passing is exact: a chain of three, and a hub of the last two and a fourth."""
    rng = np.random.default_rng(3)
    unary, chain = rng.normal(size=(4, pii.LABELS)), np.array([0, 1])
    node, hub = np.array([2, 3]), np.array([0, 0])
    field = pii.Field(np.zeros((1, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), 1.3)
    got = pii.marginals(unary, chain, node, hub, field, rounds=200)
    want = np.zeros((4, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=5):  # the last one is the hub's label
        e = sum(unary[k, y[k]] for k in range(4)) + sum(field.chain[y[k], y[k + 1]] for k in chain)
        e += sum(field.skip * (y[k] == y[4]) for k in node)
        for k in range(4):
            want[k, y[k]] += np.exp(e)
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-3)


def corpus():
    rows = []
    for i in range(160):
        ip, mail, phone = f"10.{i}.{i % 7}.{i % 200}", f"ann{i}@mail{i % 5}.example.com", f"+1 (743) 555-{1000 + i}"
        rows.append(f"first {ip} then {mail}, card 4111111111111111 card " * (i % 2) + f"seen {ip} and {mail} with 4111 1111 1111 1111 or {phone} in year {1900 + i} of {i} pages {i}{i}7 {i}@home")
    return rows


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(spark.createDataFrame([(t,) for t in corpus()], "text string"))


def spans(spark, field, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(rows, field).collect()}
    return [got[i] for i in range(len(texts))]


def test_repeats_carry_labels(spark, field):
    texts = ["first +1 (743) 555-3824 then call 555-3824 again", "plain 10.20.30.40 and later v10.20.30.40b or 7.10.20.30.40",
             "4111111111111111 but 12 4111111111111111 hides it", "tom.ray@example.com wrote, not tom.ray@localhost",
             "nothing 555-3824 here 12 1999", "word 1234 and 1234 and +1 (743) 555-3824"]
    got = spans(spark, field, texts)
    for r, text in zip(got, texts):
        base = plain(text)
        own = pii.shown(base)
        assert r["base_sha256"] == hashlib.sha256(own.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(filter(None, own.split(","))) <= set(r["spans"].split(","))
    found = [set(r["spans"].split(",")) - set(pii.shown(plain(t)).split(",")) for r, t in zip(got, texts)]
    assert found[2] == {"card:24:40"}
    mail = texts[3].index("tom.ray@localhost")
    assert f"email:{mail}:{mail + 17}" in found[3]
    assert not found[1] and not found[4] and not found[5]


def test_nothing_is_added_to_clean_texts(spark, field):
    texts = [f"year {1900 + i}, {i} pages of {i * 37} items, see 3.{i} and item-{i} twice: item-{i}" for i in range(200)]
    assert all(r["spans"] == "" and r["n_email"] == 0 for r in spans(spark, field, texts))


def test_hard_tables(spark, field):
    rows = [(1, None), (1, ""), (None, "a@b.cd"), (2, "x 10.0.0.1"), (2, "x 10.0.0.1"), (3, "9 " * 60000), (4, "q" * 200000 + "1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("spans", "n_ip", "row")})
    got = sorted(map(tuple, pii.find(docs, field).collect()), key=str)
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(got) == 7 and got.count((1, 0, 0, 0, 0, nothing, "")) == 2
    assert [g[6] for g in got if g[0] == 2] == ["ip:2:10"] * 2 and [g[6] for g in got if g[0] is None] == ["email:0:6"]
    empty = docs.where("false")
    assert pii.find(empty, pii.train(empty)).count() == 0
    same = pii.train(docs.select("text"))
    assert (same.weights == pii.train(docs.select("text").repartition(3)).weights).all()


def test_op13_on_a_table(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(corpus())] + [(500, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in pii.op13_skip_chain_pii(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i]["base_sha256"] == hashlib.sha256(pii.shown(plain(t or "")).encode()).hexdigest()
