"""T-occurrence search among the sets of one task: short inverted lists merged by a heap, long ones probed."""

import heapq
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np

#: Cost of a merge step against a probe; the more it weighs, the fewer lists are left to be probed.
MERGE_WEIGHT = 0.0085


def least_overlap(n, percent: int):
    """The smallest overlap that a set of n can have with a partner."""
    return (percent * n + 99) // 100


def needed_overlap(n, m, percent: int):
    """T for two sets: percent of the union is shared."""
    return -(-percent * (n + m) // (100 + percent))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Overlap of two sorted sets of distinct numbers; the smaller one probes the larger one."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def occurring(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(id, how many lists hold it) of the ids that at least `least` of the ascending lists hold.

    A heap has the head of every list. Where fewer than `least` heads agree, `least` - 1 lists
    jump by binary search to the smallest head of the others: no id before it can be in enough.
    """
    count = len(lists)
    at = [0] * count
    heap = [ids[0] * count + i for i, ids in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= least:
        top = heap[0] // count
        taken = []
        while heap and heap[0] // count == top:
            taken.append(heapq.heappop(heap) % count)
        if len(taken) >= least:
            yield top, len(taken)
            for i in taken:
                at[i] += 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap) % count)
            if not heap:
                return
            target = heap[0] // count
            for i in taken:
                at[i] = bisect_left(lists[i], target, at[i])
        for i in taken:
            if at[i] < len(lists[i]):
                heapq.heappush(heap, lists[i][at[i]] * count + i)


class _Index:
    """Inverted lists over `members`, ids ascending within each."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray):
        total = np.concatenate([sets[i] for i in members])
        holder = np.repeat(members, [len(sets[i]) for i in members])
        order = np.argsort(total, kind="stable")
        self.members = len(members)
        self.shingles, self.first = np.unique(total[order], return_index=True)
        self.lengths = np.diff(np.append(self.first, len(total)))
        self.ids = holder[order]

    def lists(self, wanted: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of the shingles in `wanted`, cut to the ids in `allowed`: all ids, and where each list that is left begins."""
        at = np.minimum(np.searchsorted(self.shingles, wanted), len(self.shingles) - 1)
        at = at[self.shingles[at] == wanted]
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.first[at] - ends + lengths, lengths) + np.arange(total)]
        of = np.repeat(np.arange(len(at)), lengths)
        keep = allowed[ids]
        ids, of = ids[keep], of[keep]
        return ids, np.flatnonzero(np.diff(of, prepend=-1))


def _partners(mine: np.ndarray, index: _Index, sizes: np.ndarray, allowed: np.ndarray, percent: int) -> list[int]:
    """DivideSkip: the allowed sets that share enough with `mine`."""
    n = len(mine)
    t = int(least_overlap(n, percent))
    allowed = allowed & (sizes >= t) & (percent * sizes <= 100 * n)
    ids, starts = index.lists(mine, allowed)
    if len(starts) < t:
        return []
    lists = sorted(np.split(ids, starts[1:]), key=len)
    probed = min(t - 1, int(t / (MERGE_WEIGHT * np.log2(len(lists[-1])) + 1)))
    merged, long_ones = lists[: len(lists) - probed], lists[len(lists) - probed :]
    out = []
    for who, times in occurring([x.tolist() for x in merged], t - probed):
        wanted = int(needed_overlap(n, int(sizes[who]), percent))
        for left, ids in zip(range(probed, 0, -1), long_ones):
            if times >= wanted or times + left < wanted:
                break
            spot = ids.searchsorted(who)
            times += bool(spot < len(ids) and ids[spot] == who)
        if times >= wanted:
            out.append(who)
    return out


def connecting_links(owners: list, sets: list[np.ndarray], percent: int, classes: list | None = None, sides: list | None = None) -> list[tuple]:
    """Links that connect all sets which links connect; at most one for each set.

    Every set that is reached asks the sets that aren't yet, breadth first, so a group of near copies
    costs about one search that finds them all, and the lists hold unreached sets only. Sets of
    one class (null: none) are known to be connected. With `sides`, only sets of different sides are compared.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    side = None if sides is None else np.array(sides)
    mates = defaultdict(list)
    for i, c in enumerate(classes or ()):
        if c is not None:
            mates[c].append(i)
    index = _Index(sets, np.arange(len(sets)))
    met = np.add.reduceat(np.concatenate([index.lengths[np.searchsorted(index.shingles, s)] for s in sets]), np.cumsum(sizes) - sizes)
    waiting = np.ones(len(sets), bool)
    count = len(sets)
    queue: deque[int] = deque()
    found = []

    def reach(i: int) -> None:
        nonlocal count
        for j in mates[classes[i]] if classes and classes[i] is not None else (i,):
            waiting[j] = False
            queue.append(j)
            count -= 1

    # Sets that meet most others go first.
    for seed in np.argsort(-met / sizes, kind="stable").tolist():
        if waiting[seed]:
            reach(seed)
        while queue and count:
            q = queue.popleft()
            if 2 * count <= index.members:
                index = _Index(sets, np.flatnonzero(waiting))
            allowed = waiting if side is None else waiting & (side != side[q])
            for p in _partners(sets[q], index, sizes, allowed, percent):
                if waiting[p]:
                    found.append((owners[q], owners[p]))
                    reach(p)
    return found
