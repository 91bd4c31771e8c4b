"""A ball tree over sparse vectors, for exact maximum inner products with 0/1 queries.

Each node has the centroid of its vectors and, for every band of a few neighbouring
terms, the largest distance of a vector from the centroid within that band (one radius over all
terms bounds nothing: sparse vectors are nearly as far from each other as from zero). For a query that holds terms Q

    <Q, x>  <=  <Q, centroid>  +  sum over bands of sqrt(|Q in band|) * radius

by Cauchy and Schwarz in each band. Radii and bounds are rounded outwards by far more than
floating point can lose, so a node is passed over only if none of its vectors can matter.
Vectors are whole numbers, and scores at the leaves are whole and exact.
"""

import heapq

import numpy as np

LEAF = 128
#: Neighbouring terms that share a radius.
BAND = 2
#: Share by which radii and bounds are widened.
SLACK = 1e-9
EXACT = float(1 << 53)


class Rows:
    """Sparse rows: `terms[ptr[i]:ptr[i + 1]]` and whole `values` of row i, at least one each."""

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.ptr, self.terms, self.values = ptr, terms, values
        self.norms = np.add.reduceat(values.astype(np.float64) ** 2, ptr[:-1])

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers of some rows, and where each row begins among them."""
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        begin = np.cumsum(sizes) - sizes
        return np.repeat(self.ptr[rows] - begin, sizes) + np.arange(sizes.sum()), begin


class Leaf:
    """Cells of a leaf ordered by term."""

    def __init__(self, data: Rows, rows: np.ndarray):
        cells, begin = data.cells(rows)
        place = np.repeat(np.arange(len(rows)), np.diff(np.append(begin, len(cells))))
        order = np.argsort(data.terms[cells], kind="stable")
        terms = data.terms[cells][order]
        heads = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
        self.rows, self.terms, self.heads = rows, terms[heads], np.append(heads, len(terms))
        self.place, self.values = place[order], data.values[cells][order]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Inner products of all rows of the leaf with a query's sorted terms."""
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)]
        sizes = self.heads[at + 1] - self.heads[at]
        cells = np.repeat(self.heads[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        values = self.values[cells]
        if len(query) * float(values.max(initial=0)) < EXACT:
            return np.bincount(self.place[cells], values, len(self.rows)).astype(np.int64)
        total = np.zeros(len(self.rows), np.int64)
        np.add.at(total, self.place[cells], values)
        return total


def _sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of the pieces of `values` that begin at `heads[:-1]`, none of them empty."""
    return np.add.reduceat(values, heads[:-1])


class BallTree:
    def __init__(self, data: Rows, n_terms: int, queries: list[np.ndarray]):
        self.data, self.n_terms = data, n_terms
        self.children: list[tuple[int, int] | None] = []
        self.leaves: dict[int, Leaf] = {}
        sizes = [len(q) for q in queries]
        self._terms = np.concatenate([*queries, np.empty(0, np.int64)]).astype(np.int64)
        self._heads = np.cumsum([0, *sizes])
        # Each query as (band, square root of the number of its terms there).
        self._n_bands = n_terms // BAND + 1
        pairs, held = np.unique(np.repeat(np.arange(len(queries)), sizes) * self._n_bands + self._terms // BAND, return_counts=True)
        self._bands, self._weights = pairs % self._n_bands, np.sqrt(held)
        self._band_heads = np.searchsorted(pairs, np.arange(len(queries) + 1) * self._n_bands)
        self.bounds: list[np.ndarray] = []
        self.visited = self.passed = 0
        self._build(np.arange(len(data.ptr) - 1))

    def _build(self, rows: np.ndarray) -> None:
        waiting = [(rows, -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            node = len(self.children)
            if parent >= 0:
                self.children[parent][side] = node
            cells, begin = self.data.cells(rows)
            terms, values = self.data.terms[cells], self.data.values[cells].astype(np.float64)
            centroid = np.bincount(terms, values, self.n_terms) / len(rows)
            self.bounds.append(self._bound(rows, begin, terms, values, centroid))
            halves = self._halves(rows, begin, terms, values, centroid) if len(rows) > LEAF else None
            self.children.append(halves and [-1, -1])
            if halves:
                waiting += [(half, node, k) for k, half in enumerate(halves)]
            else:
                self.leaves[node] = Leaf(self.data, rows)

    def _bound(self, rows, begin, terms, values, centroid) -> np.ndarray:
        band = terms // BAND
        middle = np.bincount(np.arange(self.n_terms) // BAND, centroid**2, self._n_bands)
        # Terms ascend within a row, so the cells of a row and band are next to each other.
        fresh = np.append(True, band[1:] != band[:-1])
        fresh[begin] = True
        heads = np.flatnonzero(fresh)
        length = np.add.reduceat(values**2, heads)
        apart = np.add.reduceat(values**2 - 2 * values * centroid[terms], heads)
        band = band[heads]
        # A row without terms of a band is `middle` away from the centroid there.
        radius = middle * (1 + SLACK)
        np.maximum.at(radius, band, np.maximum(apart + middle[band], 0) + SLACK * (length + middle[band]))
        radius = np.sqrt(radius)
        towards = _sums(centroid[self._terms], self._heads)
        # Outwards once more, for the sums.
        return (towards + _sums(radius[self._bands] * self._weights, self._band_heads)) * (1 + SLACK) + 1.0

    def _halves(self, rows, begin, terms, values, centroid):
        """Rows nearer to one of two far apart rows, or a plain cut where they don't differ."""

        def distance(to: np.ndarray) -> np.ndarray:
            return self.data.norms[rows] - 2 * np.add.reduceat(values * to[terms], begin) + (to**2).sum()

        def dense(k: int) -> np.ndarray:
            lo, hi = begin[k], begin[k + 1] if k + 1 < len(begin) else len(terms)
            return np.bincount(terms[lo:hi], values[lo:hi], self.n_terms)

        one = dense(int(np.argmax(distance(centroid))))
        from_one = distance(one)
        other = dense(int(np.argmax(from_one)))
        near = from_one <= distance(other)
        smaller = min(near.sum(), len(near) - near.sum())
        if smaller * 16 < len(near):  # lopsided: cut at the middle of the difference instead
            order = np.argsort(from_one - distance(other), kind="stable")
            near = np.zeros(len(rows), bool)
            near[order[: len(rows) // 2]] = True
        return rows[near], rows[~near]

    def search(self, number: int, query: np.ndarray, best: "Best", keys: np.ndarray) -> None:
        """Offer every row that may belong among the best of query `number`."""
        heap = [(-self.bounds[0][number], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            # A tie may still win by its key, so only a smaller bound ends the search.
            if -bound < best.least:
                self.passed += 1 + len(heap)
                return
            if self.children[node]:
                for child in self.children[node]:
                    if self.bounds[child][number] >= best.least:
                        heapq.heappush(heap, (-self.bounds[child][number], child))
                    else:
                        self.passed += 1
                continue
            self.visited += 1
            leaf = self.leaves[node]
            best.offer(leaf.scores(query), keys[leaf.rows])


class Best:
    """The `top` highest positive scores so far; equal scores by ascending key."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.keys = np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = 1

    def offer(self, scores: np.ndarray, keys: np.ndarray) -> None:
        fit = scores >= self.least
        if not fit.any():
            return
        scores, keys = np.append(self.scores, scores[fit]), np.append(self.keys, keys[fit])
        order = np.lexsort((keys, -scores))[: self.top]
        self.scores, self.keys = scores[order], keys[order]
        if len(order) == self.top:
            self.least = int(self.scores[-1])
