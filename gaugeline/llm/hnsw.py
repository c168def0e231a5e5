"""Hierarchical navigable small-world graphs in numpy: batches are inserted and searched in lockstep.

Nodes are stored in random order and layer ``l`` holds the first ``n / FAN**l`` of them, so
levels need no table. A batch of queries walks each layer together with a beam of the
best nodes so far; neighbour lists are chosen by the usual rule that a candidate must be
nearer to the node than to every neighbour taken before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE, LINKS, FAN = 24, 12, 16
BUILD_BEAM, BUILD_BATCH, QUERY_BATCH = 40, 512, 256
EXPAND = 4


def best_per_row(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of each row, in no order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(scores, -k, axis=1)[:, -k:]


def beam_search(near: np.ndarray, x: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines), queries x beam and unordered; -1 and -inf fill short beams. ``entry``: ids, -1 for none."""
    n, b = len(near), len(q)
    beam = min(beam, n)
    seen = np.zeros((b, n), bool)
    ids, sims = np.full((b, beam), -1), np.full((b, beam), -np.inf, np.float32)
    entry = entry[:, :beam]
    rows, cols = np.nonzero(entry >= 0)
    first = np.ones(len(rows), bool)
    at = rows * n + entry[rows, cols]
    first[:] = False
    first[np.unique(at, return_index=True)[1]] = True
    rows, cols = rows[first], cols[first]
    ids[rows, cols] = entry[rows, cols]
    sims[rows, cols] = np.einsum("ij,ij->i", x[entry[rows, cols]], q[rows])
    seen[rows, entry[rows, cols]] = True
    done = ids < 0
    active = np.arange(b)
    while len(active):
        open_ = np.where(done[active], -np.inf, sims[active])
        pick = best_per_row(open_, EXPAND)
        ok = np.take_along_axis(open_, pick, axis=1) > -np.inf
        some = ok.any(axis=1)
        active, pick, ok = active[some], pick[some], ok[some]
        if not len(active):
            break
        done[active[:, None], pick] = True
        from_ = np.where(ok, ids[active[:, None], pick], -1)
        fresh_id = np.full((len(active), pick.shape[1], near.shape[1]), -1)
        for k in range(pick.shape[1]):
            there = near[from_[:, k]]
            there = np.where((from_[:, k] >= 0)[:, None], there, -1)
            new = (there >= 0) & ~seen[active[:, None], there]
            fresh_id[:, k][new] = there[new]
            r, c = np.nonzero(new)
            seen[active[r], there[r, c]] = True
        fresh_id = fresh_id.reshape(len(active), -1)
        r, c = np.nonzero(fresh_id >= 0)
        score = np.full(fresh_id.shape, -np.inf, np.float32)
        score[r, c] = np.einsum("ij,ij->i", x[fresh_id[r, c]], q[active[r]])
        all_sims = np.concatenate((sims[active], score), axis=1)
        keep = best_per_row(all_sims, beam)
        all_ids = np.concatenate((ids[active], fresh_id), axis=1)
        all_done = np.concatenate((done[active], fresh_id < 0), axis=1)
        sims[active], ids[active], done[active] = (np.take_along_axis(z, keep, axis=1) for z in (all_sims, all_ids, all_done))
    return ids, sims


def choose(x: np.ndarray, node: np.ndarray, cand: np.ndarray, most: int) -> np.ndarray:
    """For each node up to ``most`` of its candidates (-1: none), spread in direction; the nearest of the rest fill up."""
    valid = cand >= 0
    to = np.where(valid, np.einsum("bkd,bd->bk", x[cand], x[node]), -np.inf)
    order = np.argsort(-to, axis=1)
    cand, to = np.take_along_axis(cand, order, axis=1), np.take_along_axis(to, order, axis=1)
    v = x[cand]
    among = v @ v.transpose(0, 2, 1)
    taken = np.zeros(cand.shape, bool)
    for k in range(cand.shape[1]):
        closer = (among[:, k] > to[:, k, None]) & taken
        taken[:, k] = ~closer.any(axis=1) & (to[:, k] > -np.inf) & (taken.sum(axis=1) < most)
    rank = np.where(taken, 0, np.where(to > -np.inf, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    return np.where(np.take_along_axis(rank, order, axis=1) < 2, np.take_along_axis(cand, order, axis=1), -1)


@dataclass
class Graph:
    """x: unit vectors (n, d) in random order; layers: neighbour ids (nodes of the layer, DEGREE), base first."""

    x: np.ndarray
    layers: list[np.ndarray]

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        sizes = [len(x)]
        while sizes[-1] > 2 * FAN * FAN:
            sizes.append(-(-sizes[-1] // FAN))
        graph = cls(x, [np.full((s, DEGREE), -1) for s in sizes])
        at = 0
        while at < len(x):
            end = min(len(x), at + max(1, min(BUILD_BATCH, at)))
            graph.insert(at, end)
            at = end
        return graph

    def insert(self, at: int, end: int) -> None:
        """Link the nodes from ``at`` to ``end`` in every layer that holds them."""
        node = np.arange(at, end)
        found = self.descend(self.x[at:end], at, BUILD_BEAM) if at else None
        for level, near in enumerate(self.layers):
            own = node[node < len(near)]
            if not len(own):
                continue
            m = len(own)
            among = self.x[own] @ self.x[own].T
            np.fill_diagonal(among, -np.inf)
            k = min(LINKS, m - 1)
            parts = [own[best_per_row(among, k)] if k else np.empty((m, 0), int)]
            if found is not None:
                parts.append(found[level][:m])
            cand = np.concatenate(parts, axis=1)
            if not cand.shape[1]:
                continue
            links = choose(self.x, own, cand, LINKS)
            near[own, : links.shape[1]] = links
            self.back(near, own, links)

    def back(self, near: np.ndarray, own: np.ndarray, links: np.ndarray) -> None:
        """Add the reverse links; lists that overflow are chosen anew."""
        r, c = np.nonzero(links >= 0)
        to, src = links[r, c], own[r]
        order = np.lexsort((-np.einsum("ij,ij->i", self.x[to], self.x[src]), to))
        to, src = to[order], src[order]
        start = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
        nth = np.arange(len(to)) - np.repeat(start, np.diff(np.append(start, len(to))))
        keep = nth < DEGREE
        target = to[start]
        row = np.repeat(np.arange(len(target)), np.diff(np.append(start, len(to))))
        extra = np.full((len(target), DEGREE), -1)
        extra[row[keep], nth[keep]] = src[keep]
        old = near[target]
        extra[(extra[:, :, None] == old[:, None]).any(axis=2)] = -1
        both = np.concatenate((old, extra), axis=1)
        over = (both >= 0).sum(axis=1) > DEGREE
        plain = np.sort(both[~over], axis=1)[:, ::-1][:, :DEGREE]
        near[target[~over]] = plain
        for i in range(0, over.sum(), 256):
            t = target[over][i : i + 256]
            near[t] = choose(self.x, t, both[over][i : i + 256], DEGREE)

    def descend(self, q: np.ndarray, built: int, beam: int) -> list[np.ndarray]:
        """Beams of each layer among the first ``built`` nodes."""
        entry, found = np.zeros((len(q), 1), int), [None] * len(self.layers)
        for level in range(len(self.layers) - 1, -1, -1):
            near = self.layers[level][:built]
            ids, sims = beam_search(near, self.x, q, entry, beam)
            order = np.argsort(-sims, axis=1)
            found[level] = np.take_along_axis(ids, order, axis=1)
            entry = found[level][:, :EXPAND]
        return found

    def widest(self) -> int:
        """Beyond this beam a comparison with all nodes is cheaper."""
        return max(128, len(self.x) // 8)

    def query(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of cosine at least ``least``. The beam of a query doubles until it ends below that; one that would need an eighth of all nodes is compared with all."""
        out_q, out_n = [], []
        todo = np.arange(len(q))
        while len(todo):
            again = []
            for i in range(0, len(todo), QUERY_BATCH):
                own = todo[i : i + QUERY_BATCH]
                if beam > self.widest():
                    found, node = exact_query(self, q[own], least)
                    out_q.append(own[found])
                    out_n.append(node)
                    continue
                entry = np.zeros((len(own), 1), int)
                for near in self.layers[:0:-1]:
                    ids, sims = beam_search(near, self.x, q[own], entry, 2 * EXPAND)
                    entry = np.take_along_axis(ids, np.argsort(-sims, axis=1)[:, :EXPAND], axis=1)
                ids, sims = beam_search(self.layers[0], self.x, q[own], entry, beam)
                full = (sims >= least).all(axis=1) & (ids.shape[1] < len(self.x))
                again.append(own[full])
                r, c = np.nonzero((sims >= least) & ~full[:, None])
                out_q.append(own[r])
                out_n.append(ids[r, c])
            todo = np.concatenate(again or [np.empty(0, int)])
            beam *= 2
        return np.concatenate(out_q or [np.empty(0, int)]), np.concatenate(out_n or [np.empty(0, int)])


def exact_query(graph: Graph, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of cosine at least ``least``, by comparison with all nodes."""
    out_q, out_n = [np.empty(0, int)], [np.empty(0, int)]
    for i in range(0, len(q), QUERY_BATCH):
        r, c = np.nonzero(q[i : i + QUERY_BATCH] @ graph.x.T >= least)
        out_q.append(r + i)
        out_n.append(c)
    return np.concatenate(out_q), np.concatenate(out_n)


def true_links(graph: Graph, q: np.ndarray, least: float, own: np.ndarray | None = None) -> np.ndarray:
    """(queries, nodes): links by comparison with all nodes, without the node ``own`` of each query."""
    truth = q @ graph.x.T >= least
    if own is not None:
        truth[np.arange(len(q)), own] = False
    return truth


def enough_beam(graph: Graph, q: np.ndarray, least: float, beam: int, target: float, own: np.ndarray | None = None) -> int:
    """The beam, doubled until the recall reaches ``target`` as the mean over the queries that have links to nodes other than ``own``; 0 if no beam that is worth it does."""
    truth = true_links(graph, q, least, own)
    links = truth.sum(axis=1)
    while beam:
        pq, pn = graph.query(q, least, beam)
        share = (np.bincount(pq[truth[pq, pn]], minlength=len(q)) / np.maximum(links, 1))[links > 0]
        if not len(share) or share.mean() >= target:
            break
        beam = 2 * beam if 2 * beam <= graph.widest() else 0
    return beam


def graph_beam(graph: Graph, least: float, beam: int, audit: int, target: float) -> int:
    """The beam that a graph needs for moved copies of its own nodes, at cosines from ``least`` to 1; 0 if it needs exact comparison.

    Each copy has its node as a link, so that no probe is empty. Of 4 * ``audit`` copies, the
    ``audit`` with the fewest links and as many evenly spaced ones must each reach the target.
    """
    probe = np.unique(np.linspace(0, len(graph.x) - 1, min(4 * audit, len(graph.x))).astype(int))
    x = graph.x[probe]
    away = np.random.default_rng(0).normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    cosine = np.linspace(least, 1, len(probe))[:, None]
    q = (cosine * x + np.sqrt(1 - cosine**2) * away).astype(np.float32)
    few = np.argsort((q @ graph.x.T >= least - 1e-6).sum(axis=1), kind="stable")[:audit]
    for own in (few, np.arange(0, len(q), max(1, len(q) // audit))):
        beam = enough_beam(graph, q[own], least - 1e-6, beam, target)
    return beam


def audited_beam(graph: Graph, q: np.ndarray, least: float, beam: int, audit: int, target: float, same: bool = False) -> int:
    """The beam at which ``audit`` evenly spaced queries, compared with all nodes, reach the target recall; 0 for exact comparison. ``same``: the queries are the graph's own nodes in order."""
    probe = np.unique(np.linspace(0, len(q) - 1, min(audit, len(q))).astype(int))
    return enough_beam(graph, q[probe], least, beam, target, probe if same else None)
