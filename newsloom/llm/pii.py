"""Personal data by rules, and by a skip-chain conditional random field that carries their labels on.

Rules find emails, IP addresses, card and phone numbers. The field's variables are a document's tokens that hold a
digit or an ``@`` (no other can be personal data here, so they are known to be none). Neighbouring tokens are joined
as in a linear chain. Tokens that repeat or resemble each other, however far apart, share a hub: the tokens with one
normal form, one digit string or one mail box are each joined to one hidden label, so a group of n tokens has n links
instead of n^2. Tokens inside rule matches are observed; loopy message passing then labels the rest, so that a number
found in one place is also found where its surroundings hide it from the rules. The weights are fitted here by
pseudo-likelihood on a bounded sample, with the rules' labels and half of the tokens' own features left out at random,
so that chain and skip weights are learned too.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .tokenize import slices

KINDS = ("email", "ip", "card", "phone")  # labels 1 to 4; 0 is no personal data
LABELS = len(KINDS) + 1

# The rules' patterns, written so that each is read in linear time.
_MAIL_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_MAIL_BOX = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # no match can begin inside a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")

SAMPLE_DOCS = 20_000  # documents whose tokens may teach, about
SAMPLE_TOKENS = 20_000  # and tokens that do, at most
FEATURES = 10
BUCKETS = 1 << 13
EPOCHS = 30
ROUNDS = 30
SURE = 0.5
SLICE = 1 << 20


# ---- rules -------------------------------------------------------------------------------------

def luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in reversed(digits)]
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The rules' matches as (start, kind, end), sorted; kind counts from 0 as in KINDS."""
    out, done, mark = [], 0, 0
    for m in _MAIL_TAIL.finditer(text):
        # The mail box is the run of its characters before the mark; no mark belongs to it.
        low = max(done, text.rfind("@", mark, m.start()) + 1, mark)
        before = text[low:m.start()]
        size = len(before) - len(before.rstrip(_MAIL_BOX))
        mark = m.start() + 1
        if size:
            out.append((m.start() - size, 0, m.end()))
            done = m.end()
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- a document's graph ---------------------------------------------------------------------------

def _hash(*parts: str) -> int:
    return xxhash.xxh32_intdigest("\x00".join(parts).encode("utf-8", "replace")) % BUCKETS


def token_features(token: str, before: str, after: str, left: bool, right: bool) -> list[int]:
    """FEATURES hashed features of a token: its look, the words around it, and whether its neighbours are candidates."""
    digits = sum(c.isdigit() for c in token)
    look = re.sub(r"9+", "9", re.sub(r"[0-9]", "9", re.sub(r"[^\W0-9_]+", "a", token[:64])))
    return [_hash("bias"), _hash("digits", str(min(digits, 20))), _hash("look", look), _hash("dots", str(min(token.count("."), 5))),
            _hash("at", str(min(token.count("@"), 2))), _hash("first", token[:1] if not token[:1].isalnum() else "w"),
            _hash("letters", str(any(c.isalpha() for c in token))), _hash("before", before[-16:].lower()),
            _hash("after", after[:16].lower()), _hash("near", str(left), str(right))]


def skip_keys(token: str) -> list[str]:
    """What a token shares with tokens that repeat or resemble it: its normal form where it has letters, its digits if
    there are four, its mail box."""
    low = token.lower()
    digits = "".join(c for c in low if "0" <= c <= "9")
    keys = []
    if len(digits) >= 4:
        keys.append("d" + digits)
    normal = "".join(c for c in low if c.isalnum())
    if len(normal) >= 4 and normal != digits:
        keys.append("n" + normal)
    if "@" in low:
        box = low[:low.index("@")].strip(".,;:()<>[]\"'")
        if len(box) >= 3:
            keys.append("m" + box)
    return keys


class Graph:
    """The tokens of many documents: features, observed labels (-1: none), chain links and hub links."""

    def __init__(self):
        self.rows: list[int] = []
        self.places: list[tuple[int, int]] = []
        self.features: list[list[int]] = []
        self.seen: list[int] = []
        self.chain: list[int] = []  # the left token of a link to the next one
        self.link_node: list[int] = []
        self.link_hub: list[int] = []
        self.hubs: dict[tuple[int, str], int] = {}

    def add(self, row: int, text: str, spans: list[tuple[int, int, int]]) -> None:
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        near = [a[1] < b[0] and text[a[1]:min(b[0], a[1] + 3)].isspace() and b[0] - a[1] <= 2 for a, b in zip(tokens, tokens[1:])]
        ends, seen = [b for _, b in tokens], [-1] * len(tokens)
        for begin, kind, end in spans:
            k = bisect_right(ends, begin)  # the first token that ends behind the span's begin
            while k < len(tokens) and tokens[k][0] < end:
                if seen[k] < 0:
                    seen[k] = kind + 1
                k += 1
        self.seen += seen
        for k, (a, b) in enumerate(tokens):
            token = text[a:b]
            left, right = k > 0 and near[k - 1], k < len(near) and near[k]
            node = len(self.rows)
            before = text[max(0, a - 24):a].split()
            after = text[b:b + 24].split()
            self.rows.append(row)
            self.places.append((a, b))
            self.features.append(token_features(token, before[-1] if before else "", after[0] if after else "", left, right))
            if right:
                self.chain.append(node)
            for key in skip_keys(token):
                self.link_node.append(node)
                self.link_hub.append(self.hubs.setdefault((row, key), len(self.hubs)))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.features, np.int64).reshape(-1, FEATURES), np.array(self.seen, np.int64),
                np.array(self.chain, np.int64), np.array(self.link_node, np.int64), np.array(self.link_hub, np.int64))


@dataclass
class Field:
    weights: np.ndarray  # buckets x labels
    chain: np.ndarray  # labels x labels
    skip: float


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _same(x: np.ndarray, skip: float) -> np.ndarray:
    """Message over a link that favours equal labels by ``skip``."""
    x = x - x.max(axis=1, keepdims=True)
    e = np.exp(x)
    m = np.log(e.sum(axis=1, keepdims=True) + e * np.expm1(skip))
    return m - m.max(axis=1, keepdims=True)


def marginals(unary: np.ndarray, chain: np.ndarray, link_node: np.ndarray, link_hub: np.ndarray, field: Field,
              rounds: int = ROUNDS, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of all tokens by loopy message passing, all messages of a round at once."""
    n, hubs = len(unary), int(link_hub.max()) + 1 if len(link_hub) else 0
    right, left = np.zeros((len(chain), LABELS)), np.zeros((len(chain), LABELS))
    up, down = np.zeros((len(link_node), LABELS)), np.zeros((len(link_node), LABELS))

    def gathered(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, y], minlength=size) for y in range(LABELS)], axis=1)

    def belief() -> np.ndarray:
        b = unary + gathered(link_node, down, n)
        b[chain + 1] += right  # a token is the right end of one link at most, and the left of one
        b[chain] += left
        return b

    b = belief()
    for _ in range(rounds):
        old = b
        new_right = log_sum((b[chain] - left)[:, :, None] + field.chain[None], 1)
        new_left = log_sum((b[chain + 1] - right)[:, None, :] + field.chain[None], 2)
        new_up = _same(b[link_node] - down, field.skip)
        total = gathered(link_hub, new_up, hubs) if hubs else np.zeros((0, LABELS))
        new_down = _same(total[link_hub] - new_up, field.skip)
        right = damping * right + (1 - damping) * (new_right - new_right.max(axis=1, keepdims=True))
        left = damping * left + (1 - damping) * (new_left - new_left.max(axis=1, keepdims=True))
        up, down = new_up, damping * down + (1 - damping) * new_down
        b = belief()
        b = b - b.max(axis=1, keepdims=True)
        if not n or np.abs(b - (old - old.max(axis=1, keepdims=True))).max() < 1e-4:
            break
    p = np.exp(b - b.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def potentials(features: np.ndarray, seen: np.ndarray, chain: np.ndarray, field: Field) -> np.ndarray:
    """Log potentials of single tokens: features, neighbours that are known to be no personal data, observations."""
    unary = field.weights[features].sum(axis=1)
    alone = np.ones((2, len(unary)), bool)
    alone[0, chain + 1] = False  # has a candidate to its left
    alone[1, chain] = False
    unary += alone[0][:, None] * field.chain[0] + alone[1][:, None] * field.chain[:, 0]
    known = seen >= 0
    unary[known] = -60.0
    unary[known, seen[known]] = 0.0
    return unary


# ---- fitting -----------------------------------------------------------------------------------

def teaching_rows(graph: Graph) -> tuple[np.ndarray, ...]:
    """Per token: features, label, left and right neighbour's label, and the shares of each label among the other
    tokens of its hubs."""
    features, seen, chain, link_node, link_hub = graph.arrays()
    label = np.maximum(seen, 0)
    left, right = np.zeros(len(label), np.int64), np.zeros(len(label), np.int64)
    left[chain + 1], right[chain] = label[chain], label[chain + 1]
    shares = np.zeros((len(label), LABELS))
    if len(link_node):
        one = np.eye(LABELS)[label[link_node]]
        total = np.stack([np.bincount(link_hub, one[:, y]) for y in range(LABELS)], axis=1)
        others = total[link_hub] - one
        count = others.sum(axis=1, keepdims=True)
        np.add.at(shares, link_node, np.divide(others, count, out=np.zeros_like(others), where=count > 0))
    return features, label, left, right, shares


def fit(features: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, shares: np.ndarray,
        epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-4, seed: int = 7) -> Field:
    """Adagrad on the pseudo-likelihood of the tokens' labels; in every step half of the tokens go without their own
    features. Without tokens all weights are 0."""
    rng = np.random.default_rng(seed)
    w, a, s = np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), 0.0
    gw, ga, gs = np.full_like(w, 1e-2), np.full_like(a, 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for begin in range(0, len(order), 128):
            k = order[begin:begin + 128]
            own = (rng.random(len(k)) < 0.5)[:, None]
            z = own * w[features[k]].sum(axis=1) + a[left[k]] + a[:, right[k]].T + s * shares[k]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            g = p / p.sum(axis=1, keepdims=True)
            g[np.arange(len(k)), label[k]] -= 1
            d = np.zeros_like(w)
            np.add.at(d, features[k].ravel(), np.repeat(g * own, FEATURES, axis=0))
            at = np.unique(features[k])
            d = d[at] / len(k) + decay * w[at]
            gw[at] += d * d
            w[at] -= rate * d / np.sqrt(gw[at])
            d = np.zeros_like(a)
            np.add.at(d, left[k], g)
            e = np.zeros_like(a)
            np.add.at(e, right[k], g)
            d = (d + e.T) / len(k) + decay * a
            ga += d * d
            a -= rate * d / np.sqrt(ga)
            d = float((g * shares[k]).sum() / len(k)) + decay * s
            gs += d * d
            s -= rate * d / np.sqrt(gs)
    return Field(w, a, max(s, 0.0))


_ROW = "key long, features array<int>, label int, left int, right int, shares array<double>"


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Field:
    """Fits the field on at most ``sample_tokens`` tokens of about ``sample_docs`` documents (all of a smaller table),
    chosen by a hash of the text. ``docs``: text. They meet in one task."""
    n = docs.count()
    picked = docs.select("text", F.xxhash64("text").alias("_h")).where(F.pmod("_h", F.lit(max(n, 1))) < sample_docs)

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                graph = Graph()
                for row, text in enumerate(part.column("text").to_pylist()):
                    graph.add(row, text or "", base_spans(text or ""))
                features, label, left, right, shares = teaching_rows(graph)
                if len(label):
                    keys = [xxhash.xxh64_intdigest(f.tobytes() + s.tobytes()) >> 1 for f, s in zip(features, shares)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(features.tolist(), pa.list_(pa.int32())), pa.array(label, pa.int32()),
                         pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(shares.tolist(), pa.list_(pa.float64()))],
                        ["key", "features", "label", "left", "right", "shares"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r["key"], r["label"], r["left"], r["right"], r["features"]))
        column = lambda c, t: np.array([r[c] for r in rows], t)
        own = fit(column("features", np.int64).reshape(-1, FEATURES), column("label", np.int64), column("left", np.int64),
                  column("right", np.int64), column("shares", np.float64).reshape(-1, LABELS))
        yield pa.RecordBatch.from_arrays([pa.array([own.weights.tobytes()], pa.binary()), pa.array([own.chain.tobytes()], pa.binary()),
                                          pa.array([own.skip], pa.float64())], ["weights", "chain", "skip"])

    tokens = picked.select("text").mapInArrow(teach, _ROW).orderBy("key", "label", "left", "right").limit(sample_tokens)
    found = tokens.repartition(1).mapInArrow(learn, "weights binary, chain binary, skip double").collect()
    if not found:
        return Field(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), 0.0)
    return Field(np.frombuffer(found[0]["weights"]).reshape(BUCKETS, LABELS),
                 np.frombuffer(found[0]["chain"]).reshape(LABELS, LABELS), found[0]["skip"])


# ---- finding -----------------------------------------------------------------------------------

def added_spans(graph: Graph, texts: dict[int, str], field: Field, sure: float = SURE) -> dict[int, list[tuple[int, int, int]]]:
    """Spans that the field adds, by row: tokens outside rule matches whose label has at least probability ``sure`` and
    that some hub ties to a rule's token of that label. Neighbours labelled card or phone make one span, from the first
    tied token to the last; marks around it don't count."""
    features, seen, chain, link_node, link_hub = graph.arrays()
    if not len(seen) or not (seen > 0).any():
        return {}
    p = marginals(potentials(features, seen, chain, field), chain, link_node, link_hub, field)
    label = np.where(p.max(axis=1) >= sure, p.argmax(axis=1), 0)
    label[seen > 0] = seen[seen > 0]
    # Tokens that share a hub with a rule's token of their label.
    held = np.zeros((int(link_hub.max()) + 1 if len(link_hub) else 0, LABELS), bool)
    observed = seen[link_node] > 0
    held[link_hub[observed], seen[link_node[observed]]] = True
    tied = np.zeros(len(label), bool)
    tied[link_node[held[link_hub, label[link_node]]]] = True
    linked = set(chain.tolist())
    out: dict[int, list[tuple[int, int, int]]] = {}
    new = (label > 0) & (seen < 0)
    for first in np.flatnonzero(new).tolist():
        kind = int(label[first])
        joins = kind >= 3
        if joins and first > 0 and new[first - 1] and label[first - 1] == kind and first - 1 in linked:
            continue  # inside a span that began before
        last = first
        while joins and last in linked and new[last + 1] and label[last + 1] == kind:
            last += 1
        own = first + np.flatnonzero(tied[first:last + 1])
        if not len(own):
            continue
        first, last = int(own[0]), int(own[-1])
        text = texts[graph.rows[first]]
        a, b = graph.places[first][0], graph.places[last][1]
        while a < b and not (text[a].isalnum() or text[a] == "+"):
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        if a < b:
            out.setdefault(graph.rows[first], []).append((a, kind - 1, b))
    return out


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the number of rule matches of each kind, the digest of their spans, and all
    spans (code points, end exclusive; those of the rules and those that the field adds).

    A null text is empty; an empty text has no spans; equal rows give equal rows; a null id stays null; other columns
    are left out; an empty table gives no rows. Texts of any length are read whole, one document's tokens at a time in
    memory."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n = part.num_rows
                counts = np.zeros((n, len(KINDS)), np.int64)
                digest, spans = [nothing] * n, [""] * n
                some = pc.fill_null(pc.match_substring_regex(part.column("text"), "[0-9@]"), False)
                graph, texts, base = Graph(), {}, {}
                for row in np.flatnonzero(some.to_numpy(zero_copy_only=False)).tolist():
                    own = part.column("text")[row].as_py()
                    found = base_spans(own)
                    if found:  # without an observed label there is nothing to carry on
                        texts[row], base[row] = own, found
                        graph.add(row, own, found)
                more = added_spans(graph, texts, shared.value)
                for row, found in base.items():
                    for _, kind, _ in found:
                        counts[row, kind] += 1
                    digest[row] = hashlib.sha256(shown(found).encode()).hexdigest()
                    spans[row] = shown(sorted(found + more.get(row, [])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(counts[:, k]) for k in range(len(KINDS))], pa.array(digest, pa.string()),
                     pa.array(spans, pa.string())],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, OUT)


def op13_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return find(docs, train(docs))
