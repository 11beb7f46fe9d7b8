"""Hierarchical navigable small-world graph over unit vectors, searched for many queries at once.

All steps are array operations over a batch of queries, so Python's share is small. Used inside tasks by
the embedding de-duplication; a graph holds the vectors of one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

NONE = -1
CELLS = 1 << 16  # candidates compared at once: bounds what is gathered for them, not their number
MARKS = 1 << 20  # marks (query, node) kept at once by ``within_parts``


class Graph:
    """Layers of neighbour lists; layer 0 holds all vectors, each further one a random part."""

    def __init__(self, vectors: np.ndarray, degree: int = 12, beam: int = 32, seed: int = 7):
        self.x = np.ascontiguousarray(vectors, np.float32)
        self.degree = degree
        n = len(self.x)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(degree)).astype(np.int64), 8) if n else np.zeros(0, np.int64)
        self.order = np.argsort(-self.level, kind="stable")  # upper layers first, so searches start there
        top = int(self.level[self.order[0]]) if n else 0
        self.links = [np.full((n, self._width(k)), NONE, np.int32) for k in range(top + 1)]
        self._insert_all(beam)

    def _width(self, layer: int) -> int:
        return 2 * self.degree if layer == 0 else self.degree

    def _insert_all(self, beam: int) -> None:
        n, done = len(self.x), min(len(self.x), 1)
        while done < n:
            batch = self.order[done:done + max(16, min(512, done // 2))]
            self._insert(batch, beam)
            done += len(batch)

    def _insert(self, batch: np.ndarray, beam: int) -> None:
        q = self.x[batch]
        among = q @ q.T
        near = np.full((len(batch), 1), self.order[0], np.int64)
        for layer in range(len(self.links) - 1, -1, -1):
            ids, sims = self.search_layer(q, near, layer, beam if layer <= self.level[batch].max() else 1)
            mine = np.flatnonzero(self.level[batch] >= layer)
            if len(mine):
                # candidates: what the search met, and the batch's own members of this layer
                own_sims = among[np.ix_(mine, mine)].copy()
                np.fill_diagonal(own_sims, -np.inf)
                k = min(len(mine), self._width(layer))
                pick = np.argpartition(-own_sims, k - 1, axis=1)[:, :k]
                c_ids = np.concatenate([ids[mine], batch[mine][pick]], axis=1)
                c_sims = np.concatenate([sims[mine], np.take_along_axis(own_sims, pick, axis=1)], axis=1)
                c_ids[~np.isfinite(c_sims)] = NONE
                chosen = self._diverse(c_ids, c_sims, self.degree if layer else self._width(0) * 3 // 4)
                self.links[layer][batch[mine], :chosen.shape[1]] = chosen
                self._link_back(batch[mine], chosen, layer)
            near = ids

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of each row's candidates the nearest that are nearer to the query than to those already
        chosen; places left over are filled with the nearest others."""
        step = max(1, CELLS // max(1, ids.shape[1]))
        return np.concatenate([self._diverse_rows(ids[i:i + step], sims[i:i + step], width) for i in range(0, max(1, len(ids)), step)])

    def _diverse_rows(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        rows, count = ids.shape
        valid = ids >= 0
        chosen, closest = np.zeros_like(valid), np.full(ids.shape, -np.inf, np.float32)
        vectors = self.x[np.where(valid, ids, 0)]
        taken = np.zeros(rows, np.int64)
        for j in range(count):
            take = valid[:, j] & (sims[:, j] > closest[:, j]) & (taken < width)
            chosen[take, j] = True
            taken += take
            if j + 1 < count and take.any():
                r = np.flatnonzero(take)
                to = np.matmul(vectors[r, j + 1:], vectors[r, j][:, :, None])[:, :, 0]
                closest[r, j + 1:] = np.maximum(closest[r, j + 1:], to)
        rank = np.where(chosen, 0, np.where(valid, 1, 2)) * count + np.arange(count)
        pick = np.argsort(rank, axis=1)[:, :width]
        return np.where(np.take_along_axis(valid, pick, 1), np.take_along_axis(ids, pick, 1), NONE).astype(np.int32)

    def _link_back(self, nodes: np.ndarray, chosen: np.ndarray, layer: int) -> None:
        """Add the reverse links; a full list is chosen anew among its links and the new ones."""
        links, width = self.links[layer], self._width(layer)
        to, back = chosen.ravel(), np.repeat(nodes, chosen.shape[1])
        ok = to >= 0
        to, back = to[ok], back[ok]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, first, number = np.unique(to, return_index=True, return_counts=True)
        have = (links[targets] >= 0).sum(1)
        place = np.arange(len(to)) - np.repeat(first, number)
        free = place < np.repeat(width - have, number)
        links[to[free], (np.repeat(have, number) + place)[free]] = back[free]
        over = have + number - width  # links that don't fit
        left = np.flatnonzero(~free)
        at, slot = np.searchsorted(targets, to[left]), (place - np.repeat(width - have, number))[left]
        low, most = 0, width
        while (over > low).any():  # nodes with many new links apart from the others, so that few rows are so wide
            mine = np.flatnonzero((over > low) & (over <= most))
            step = max(1, CELLS // (width + most))
            for i in range(0, len(mine), step):
                some = mine[i:i + step]
                a, b = np.searchsorted(at, [some[0], some[-1] + 1])
                row = np.searchsorted(some, at[a:b])
                own = some[np.minimum(row, len(some) - 1)] == at[a:b]
                extra = np.full((len(some), int(over[some].max())), NONE, np.int64)
                extra[row[own], slot[a:b][own]] = back[left[a:b][own]]
                ids = np.concatenate([links[targets[some]].astype(np.int64), extra], axis=1)
                sims = np.einsum("rcd,rd->rc", self.x[np.where(ids >= 0, ids, 0)], self.x[targets[some]])
                sims[ids < 0] = -np.inf
                links[targets[some]] = self._diverse(ids, sims, width)
            low, most = most, most * 4

    def search_layer(self, q: np.ndarray, near: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search with a beam for each query from the nodes ``near``: ids (NONE where fewer) and similarities."""
        rows = len(q)
        ids = np.full((rows, beam), NONE, np.int64)
        sims = np.full((rows, beam), -np.inf, np.float32)
        k = min(beam, near.shape[1])
        start = near[:, :k]
        ids[:, :k] = start
        sims[:, :k] = np.where(start >= 0, np.einsum("rcd,rd->rc", self.x[np.where(start >= 0, start, 0)], q), -np.inf)
        seen = ids < 0
        links = self.links[layer]
        act = np.arange(rows)
        while len(act):
            a_ids, a_sims, a_seen = ids[act], sims[act], seen[act]
            best = np.argmax(np.where(a_seen, -np.inf, a_sims), axis=1)
            go = ~a_seen[np.arange(len(act)), best]
            if not go.all():
                act, a_ids, a_sims, a_seen, best = act[go], a_ids[go], a_sims[go], a_seen[go], best[go]
                if not len(act):
                    break
            r = np.arange(len(act))
            a_seen[r, best] = True
            new = links[a_ids[r, best]].astype(np.int64)
            s = np.einsum("rcd,rd->rc", self.x[np.where(new >= 0, new, 0)], q[act])
            known = (new < 0) | (s <= a_sims.min(1)[:, None])
            r2, c2 = np.nonzero(~known)
            if len(r2):
                known[r2, c2] = (a_ids[r2] == new[r2, c2][:, None]).any(1)
            s[known] = -np.inf
            some = np.flatnonzero((~known).any(1))
            if len(some):
                all_s = np.concatenate([a_sims[some], s[some]], 1)
                top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
                a_sims[some] = np.take_along_axis(all_s, top, 1)
                a_ids[some] = np.take_along_axis(np.concatenate([a_ids[some], np.where(known[some], NONE, new[some])], 1), top, 1)
                a_seen[some] = np.take_along_axis(np.concatenate([a_seen[some], known[some]], 1), top, 1)
            ids[act], sims[act], seen[act] = a_ids, a_sims, a_seen
        order = np.argsort(-sims, axis=1)
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        return np.where(np.isfinite(sims), ids, NONE), sims

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best met from the top layer down."""
        near = np.full((len(q), 1), self.order[0], np.int64)
        for layer in range(len(self.links) - 1, 0, -1):
            near = self.search_layer(q, near, layer, 4)[0]
        return self.search_layer(q, near, 0, beam)

    def within(self, q: np.ndarray, beam: int, least: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) with similarity >= ``least``: a beam search, then all neighbours of
        whatever lies above ``least - slack`` until nothing new is met."""
        parts = list(self.within_parts(q, beam, least, slack))
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def within_parts(self, q: np.ndarray, beam: int, least: float, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of ``within`` for a few queries at a time, so that what is held does not follow the number of pairs."""
        step = max(1, MARKS // max(1, len(self.x)))
        for lo in range(0, len(q), 1024):
            part = q[lo:lo + 1024]
            ids, sims = self.search(part, beam)
            high = sims >= least - slack
            near = np.flatnonzero(high.any(1))
            for i in range(0, len(near), step):
                some = near[i:i + step]
                r, c = np.nonzero(high[some])
                known = self._spread(part[some], r, ids[some[r], c], least - slack)
                r, c = np.nonzero(known)
                yield some[r] + lo, c

    def _spread(self, q: np.ndarray, front_r: np.ndarray, front_n: np.ndarray, least: float) -> np.ndarray:
        """Marks of the nodes that each query reaches from its front through nodes of similarity >= ``least``."""
        known = np.zeros((len(q), len(self.x)), bool)
        known[front_r, front_n] = True
        while len(front_r):
            hit_r, hit_n = [], []
            for i in range(0, len(front_r), 1 << 12):
                n_ = self.links[0][front_n[i:i + (1 << 12)]].astype(np.int64)
                rr = np.repeat(front_r[i:i + (1 << 12)], n_.shape[1])
                nn = n_.ravel()
                ok = nn >= 0
                ok[ok] = ~known[rr[ok], nn[ok]]
                met_r, met_n = np.divmod(np.unique(rr[ok] * len(self.x) + nn[ok]), len(self.x))
                high = np.concatenate([np.einsum("rd,rd->r", q[met_r[j:j + (1 << 14)]], self.x[met_n[j:j + (1 << 14)]]) >= least
                                       for j in range(0, max(1, len(met_r)), 1 << 14)])
                known[met_r[high], met_n[high]] = True
                hit_r.append(met_r[high].astype(np.int32))
                hit_n.append(met_n[high].astype(np.int32))
            front_r, front_n = np.concatenate(hit_r).astype(np.int64), np.concatenate(hit_n).astype(np.int64)
        return known
