"""Hierarchical navigable small-world graphs in numpy: many insertions or searches take each step together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LINKS = 24  # links kept per point on a layer
UPPER = 16  # a layer holds about one point in so many of the layer below
BATCH = 256
BUILD_BEAM = 96


def beam_search(links: np.ndarray, x: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int,
                step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest points found for each query (unit vectors; most similar first; -1 where fewer).

    Every round expands the ``step`` best points of each beam that are not expanded yet, until a beam has none."""
    b, n = len(queries), len(x)
    rows = np.arange(b)
    seen = np.zeros((b, n), bool)
    ids = np.full((b, width), -1, np.int64)
    sims = np.full((b, width), -np.inf, np.float32)
    entry = entry[:, :width]
    first = entry.shape[1]
    ids[:, :first] = entry
    sims[:, :first] = np.where(entry >= 0, np.einsum("bed,bd->be", x[entry], queries), -np.inf)
    np.put_along_axis(seen, np.where(entry >= 0, entry, 0), True, 1)
    done = ids < 0
    active = rows
    step = min(step, width)
    while len(active):
        open_sims = np.where(done[active], -np.inf, sims[active])
        pick = np.argpartition(-open_sims, step - 1, axis=1)[:, :step]
        usable = np.take_along_axis(open_sims, pick, 1) > -np.inf
        going = usable.any(1)
        active, pick, usable = active[going], pick[going], usable[going]
        if not len(active):
            break
        done[active[:, None], pick] |= usable
        near = np.where(usable[:, :, None], links[ids[active[:, None], pick]], -1).reshape(len(active), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[active[:, None], np.where(near >= 0, near, 0)]
        keep = fresh.any(1)
        if not keep.any():
            continue
        at, near, fresh = active[keep], near[keep], fresh[keep]
        r, c = np.nonzero(fresh)
        seen[at[r], near[r, c]] = True
        new = np.full(near.shape, -np.inf, np.float32)
        new[r, c] = np.einsum("kd,kd->k", x[near[r, c]], queries[at[r]])
        all_sims = np.concatenate([sims[at], new], 1)
        all_ids = np.concatenate([ids[at], np.where(fresh, near, -1)], 1)
        all_done = np.concatenate([done[at], ~fresh], 1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[at], ids[at] = np.take_along_axis(all_sims, best, 1), np.take_along_axis(all_ids, best, 1)
        done[at] = np.take_along_axis(all_done, best, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _diverse(x: np.ndarray, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """At most ``keep`` of each row's candidates (most similar first): first those nearer to the point than to any
    candidate kept before, so that links also lead out of a tight cluster; then the nearest of the rest."""
    b, c = ids.shape
    v = x[np.where(ids >= 0, ids, 0)]
    between = np.einsum("bid,bjd->bij", v, v)
    chosen = np.zeros((b, c), bool)
    worst = np.full((b, c), -np.inf, np.float32)  # similarity to the nearest kept candidate
    for j in range(c):
        good = (ids[:, j] >= 0) & (ids[:, j] != own) & (worst[:, j] < sims[:, j]) & (chosen.sum(1) < keep // 2 + 1)
        chosen[:, j] = good
        worst = np.where(good[:, None], np.maximum(worst, between[:, j]), worst)
    valid = (ids >= 0) & (ids != own[:, None])
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * (c + 1) + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :keep]
    picked = np.take_along_axis(np.where(valid, ids, -1), order, 1)
    if picked.shape[1] < keep:
        picked = np.concatenate([picked, np.full((b, keep - picked.shape[1]), -1, picked.dtype)], 1)
    return picked


@dataclass
class Graph:
    """``x``: unit vectors. ``members[l]``: points of layer l in the order of insertion; ``links[l]``: their links, as
    places in ``members[l]``. Layer 0 holds all points."""
    x: np.ndarray
    members: list[np.ndarray]
    links: list[np.ndarray]

    def entries(self, queries: np.ndarray, down_to: int = 0) -> np.ndarray:
        """Points of layer ``down_to`` from which to start, found through the layers above it."""
        top = len(self.members) - 1
        here = self.members[top]
        if top == down_to:
            return np.tile(np.arange(min(4, len(here))), (len(queries), 1))
        best = np.argsort(-(queries @ self.x[here].T), axis=1, kind="stable")[:, :8]
        for layer in range(top, down_to, -1):
            if layer < top:
                best, _ = beam_search(self.links[layer], self.x[self.members[layer]], queries, best, 16)
                best = best[:, :8]
            place = np.full(len(self.x) + 1, -1, np.int64)
            place[self.members[layer - 1]] = np.arange(len(self.members[layer - 1]))
            best = place[np.where(best >= 0, self.members[layer][best], -1)]
        return best

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        ids, sims = [], []
        for at in range(0, len(queries), BATCH):
            q = queries[at:at + BATCH]
            i, s = beam_search(self.links[0], self.x, q, self.entries(q), width)
            ids.append(i)
            sims.append(s)
        return np.concatenate(ids), np.concatenate(sims)


def build(x: np.ndarray, links: int = LINKS, width: int = BUILD_BEAM) -> Graph:
    """A graph of unit vectors ``x`` (float32), inserted in order in batches. Deterministic."""
    n = len(x)
    layers = [np.arange(n)]
    while len(layers[-1]) > 4 * UPPER:
        layers.append(layers[-1][::UPPER])
    tables = []
    graph = Graph(x, layers, tables)
    for depth in range(len(layers) - 1, -1, -1):
        own = x[layers[depth]]
        above = np.arange(0, len(own), UPPER) if depth < len(layers) - 1 else np.arange(min(4, len(own)))
        tables.insert(0, _connected(own, _layer(own, links, width), above))
    return graph


def _spread(table: np.ndarray, reached: np.ndarray, front: np.ndarray) -> None:
    """Marks all that ``front`` leads to."""
    while len(front):
        reached[front] = True
        near = np.unique(table[front])
        front = near[(near >= 0) & ~reached[near]]


def _connected(x: np.ndarray, table: np.ndarray, starts: np.ndarray, spare: int = 8) -> np.ndarray:
    """``table`` with spare links through which every point is reached from ``starts``: pruning may have cut off
    a point, or a tight cluster, that others no longer link to. Each gets a link from its nearest reached point."""
    table = np.concatenate([table, np.full((len(table), spare), -1, table.dtype)], 1)
    reached = np.zeros(len(table), bool)
    _spread(table, reached, starts)
    while not reached.all():
        lost = int(np.argmin(reached))
        sims = np.where(reached & (table[:, -1] < 0), x @ x[lost], -np.inf)
        via = int(np.argmax(sims))
        table[via, table.shape[1] - spare + int((table[via, -spare:] >= 0).sum())] = lost
        _spread(table, reached, np.array([lost]))
    return table


def _layer(x: np.ndarray, links: int, width: int) -> np.ndarray:
    n = len(x)
    table = np.full((n, links), -1, np.int64)
    start = min(n, BATCH)
    sims = x[:start] @ x[:start].T
    order = np.argsort(-sims, axis=1, kind="stable")[:, :min(start, width)]
    table[:start] = _diverse(x, np.arange(start), order, np.take_along_axis(sims, order, 1), links)
    for at in range(start, n, BATCH):
        new = np.arange(at, min(n, at + BATCH))
        q = x[new]
        # Starts spread over what is inserted so far; the batch itself is compared directly.
        spread = np.unique(np.linspace(0, at - 1, 64).astype(np.int64))
        entry = spread[np.argsort(-(q @ x[spread].T), axis=1, kind="stable")[:, :8]]
        ids, sims = beam_search(table[:at], x[:at], q, entry, width)
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        ids = np.concatenate([ids, np.tile(new, (len(new), 1))], 1)
        sims = np.concatenate([sims, among], 1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        ids = np.where(np.isfinite(sims), ids, -1)
        table[new] = _diverse(x, new, ids, sims, links)
        # Links back: each point that was linked to takes the new points among its own candidates.
        r, c = np.nonzero(table[new] >= 0)
        to, back = table[new][r, c], new[r]
        order = np.lexsort((back, to))
        to, back = to[order], back[order]
        points, begin, count = np.unique(to, return_index=True, return_counts=True)
        for lo in range(0, len(points), BATCH):
            p, b, k = points[lo:lo + BATCH], begin[lo:lo + BATCH], count[lo:lo + BATCH]
            extra = np.full((len(p), int(k.max())), -1, np.int64)
            for row in range(len(p)):
                extra[row, :k[row]] = back[b[row]:b[row] + k[row]]
            cand = np.concatenate([table[p], extra], 1)
            cand.sort(axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            s = np.where(cand >= 0, np.einsum("bcd,bd->bc", x[cand], x[p]), -np.inf).astype(np.float32)
            order = np.argsort(-s, axis=1, kind="stable")
            # A hub of many new links at once keeps the nearest of them as candidates.
            order = order[:, :3 * links]
            table[p] = _diverse(x, p, np.take_along_axis(cand, order, 1), np.take_along_axis(s, order, 1), links)
    return table
