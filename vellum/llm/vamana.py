"""A robust-pruned directed graph over one shard's vectors, on numpy.

Vectors are searched by largest inner product: with one more component, sqrt(M^2 - |x|^2) for the shard's
largest norm M and 0 for a query, that is least Euclidean distance, for which the graph is built.  Points enter
in batches: a greedy beam search from the medoid proposes neighbours, robust pruning (drop what
is ``alpha`` times nearer to a kept neighbour) keeps diverse edges, and reverse edges are pruned the same way
when a point has too many.
"""

from __future__ import annotations

import numpy as np

DEGREE = 32
#: Reverse edges may fill a row up to here before it is pruned back to DEGREE.
SLACK = 44
BEAM_BUILD = 64
ALPHA = 1.2
#: Points expanded together in a step of the search of one query.
WIDTH = 4
BATCH = 256
#: Queries searched together, times points: a byte each marks what a query has seen.
SEEN = 1 << 26


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 1):
        v = vectors.astype(np.float64)
        norms = (v * v).sum(axis=1)
        self.x = np.concatenate([v, np.sqrt(np.maximum(0, norms.max(initial=0) - norms))[:, None]], axis=1).astype(np.float32)
        self.n = len(v)
        self.edges = np.full((self.n, SLACK), -1, np.int32)
        self.degree = np.zeros(self.n, np.int32)
        self.sq = (self.x * self.x).sum(axis=1)
        centre = self.x.mean(axis=0) if self.n else 0
        self.entry = int(((self.x - centre) ** 2).sum(axis=1).argmin()) if self.n else 0
        order = np.random.default_rng(seed).permutation(self.n)
        done, size = 0, 8
        for alpha in (1.0, ALPHA):
            done, size = 0, 8 if alpha == 1.0 else BATCH
            while done < self.n:
                self._insert(order[done : done + size], alpha)
                done += size
                size = min(BATCH, 2 * size)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: none) and squared distances (up to each query's constant) of the ``beam`` nearest found, nearest first."""
        at_once = max(1, SEEN // max(1, self.n))
        if len(queries) > at_once:
            parts = [self.search(queries[i : i + at_once], beam) for i in range(0, len(queries), at_once)]
            return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        b = len(queries)
        ids = np.full((b, beam), -1, np.int64)
        dist = np.full((b, beam), np.inf, np.float32)
        open_ = np.zeros((b, beam), bool)
        seen = np.zeros((b, self.n), bool)
        ids[:, 0], open_[:, 0], seen[:, self.entry] = self.entry, True, True
        dist[:, 0] = self.sq[self.entry] - 2 * queries @ self.x[self.entry]
        active = np.arange(b)
        while len(active):
            first = np.where(open_[active], dist[active], np.inf)
            pick = np.argpartition(first, min(WIDTH, beam) - 1, axis=1)[:, :WIDTH]
            real = np.take_along_axis(open_[active], pick, axis=1)
            at = np.where(real, np.take_along_axis(ids[active], pick, axis=1), -1)
            open_[active[:, None], pick] = False
            near = np.where(at[:, :, None] >= 0, self.edges[at], -1).reshape(len(active), -1)
            row, col = np.nonzero(near >= 0)
            who, new = active[row], near[row, col]
            fresh = ~seen[who, new]
            who, new, row = who[fresh], new[fresh], row[fresh]
            key = np.unique(row.astype(np.int64) * self.n + new)  # two expanded points may share a neighbour
            row, new = key // self.n, key % self.n
            who = active[row]
            seen[who, new] = True
            d = self.sq[new] - 2 * np.einsum("ij,ij->i", queries[who], self.x[new])
            count = np.bincount(row, minlength=len(active))
            width = int(count.max(initial=0))
            if width:
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                more_ids = np.full((len(active), width), -1, np.int64)
                more_d = np.full((len(active), width), np.inf, np.float32)
                more_ids[row, place], more_d[row, place] = new, d
                all_d = np.concatenate([dist[active], more_d], axis=1)
                best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
                ids[active] = np.take_along_axis(np.concatenate([ids[active], more_ids], axis=1), best, axis=1)
                open_[active] = np.take_along_axis(np.concatenate([open_[active], more_ids >= 0], axis=1), best, axis=1)
                dist[active] = np.take_along_axis(all_d, best, axis=1)
            active = active[open_[active].any(axis=1)]
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(dist, order, axis=1)

    def _prune(self, points: np.ndarray, cand: np.ndarray, alpha: float) -> np.ndarray:
        """Robust pruning: at most DEGREE of the candidates (-1: none; no repeats) of each point."""
        out = np.full((len(points), DEGREE), -1, np.int32)
        for s in range(0, len(points), BATCH):
            p, c = points[s : s + BATCH], cand[s : s + BATCH]
            alive = (c >= 0) & (c != p[:, None])
            vec = self.x[c]
            sq = self.sq[c]
            to_p = np.maximum(0, sq + self.sq[p][:, None] - 2 * np.einsum("bcd,bd->bc", vec, self.x[p]))
            between = sq[:, :, None] + sq[:, None, :] - 2 * vec @ vec.transpose(0, 2, 1)
            rows = np.arange(len(p))
            for k in range(DEGREE):
                masked = np.where(alive, to_p, np.inf)
                pick = masked.argmin(axis=1)
                real = alive[rows, pick]
                if not real.any():
                    break
                out[s + rows[real], k] = c[rows[real], pick[real]]
                alive[rows, pick] = False
                alive &= ~(real[:, None] & (alpha * alpha * between[rows, pick] <= to_p))
        return out

    def _insert(self, points: np.ndarray, alpha: float) -> None:
        found, _ = self.search(self.x[points], min(BEAM_BUILD, self.n))
        cand = np.concatenate([found, self.edges[points]], axis=1)
        cand.sort(axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        kept = self._prune(points, cand, alpha)
        self.edges[points] = -1
        self.edges[points, :DEGREE] = kept
        self.degree[points] = (kept >= 0).sum(axis=1)
        row, col = np.nonzero(kept >= 0)
        self._reverse(kept[row, col].astype(np.int64), points[row], alpha)

    def _reverse(self, target: np.ndarray, source: np.ndarray, alpha: float) -> None:
        """Add the edges target -> source; rows that overflow are pruned."""
        have = (self.edges[target] == source[:, None]).any(axis=1)
        target, source = target[~have], source[~have]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        whose, first, count = np.unique(target, return_index=True, return_counts=True)
        fits = self.degree[whose] + count <= SLACK
        place = np.arange(len(target)) - np.repeat(first, count) + np.repeat(self.degree[whose], count)
        ok = np.repeat(fits, count)
        self.edges[target[ok], place[ok]] = source[ok]
        self.degree[whose[fits]] += count[fits]
        full = whose[~fits]
        if len(full):
            width = int(count[~fits].max())
            extra = np.full((len(full), width), -1, np.int64)
            many = ~ok
            row = np.repeat(np.arange(len(full)), count[~fits])
            extra[row, (np.arange(len(target)) - np.repeat(first, count))[many]] = source[many]
            kept = self._prune(full, np.concatenate([self.edges[full], extra], axis=1), alpha)
            self.edges[full] = -1
            self.edges[full, :DEGREE] = kept
            self.degree[full] = (kept >= 0).sum(axis=1)
