"""Similarity join of two collections of ordered sets through a prefix tree."""

from __future__ import annotations

import numpy as np


def shared_prefix(a: np.ndarray, b: np.ndarray, start: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, known to be at least ``start``."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[start:n] != b[start:n])
    return start + int(differ[0]) if len(differ) else n


def enough(overlap: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with ``total`` members together have a Jaccard similarity of ``percent`` or more."""
    return (100 + percent) * overlap >= percent * total


def spare(size: np.ndarray, percent: int) -> np.ndarray:
    """Members of sets of that size that a similar one may lack, at most."""
    return size - (percent * size + 99) // 100


class PrefixTree:
    """Sets in one global order of their members, as a tree of shared prefixes.

    Sorting the sets puts those with a common prefix side by side: a node is a range of the sorted sets and a depth,
    and the stretch that all sets of a range share below that depth is one edge.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])

    def join(self, probes: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(set, probe) numbers of all pairs that are similar enough.

        All probes go down the tree together. A node holds the overlap of each probe with the path so far, which every
        set below shares; it grows by the probes found in an edge's members. A probe is dropped where its overlap plus
        what is left of the longest set below cannot reach what the shortest one asks for, and a subtree is left when no
        probe remains.
        """
        sizes = np.array([len(p) for p in probes])
        members = np.concatenate(probes) if probes else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(probes)), sizes)
        by_member = np.argsort(members, kind="stable")
        members, owner = members[by_member], owner[by_member]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        stack = [(0, len(self.sets), 0, np.zeros(len(probes), np.int64), np.ones(len(probes), bool))]
        while stack:
            lo, hi, depth, overlap, alive = stack.pop()
            if lo == hi:
                continue
            low, high = self.sizes[lo:hi].min(), self.sizes[lo:hi].max()
            alive = alive & (100 * sizes >= percent * low) & (100 * high >= percent * sizes)
            alive &= enough(overlap + (high - depth), sizes + low, percent)
            if not alive.any():
                continue
            first, last = self.sets[lo], self.sets[hi - 1]
            end = len(first) if hi - lo == 1 else shared_prefix(first, last, depth)
            if end > depth:
                edge = first[depth:end]
                a, b = np.searchsorted(members, edge, "left"), np.searchsorted(members, edge, "right")
                count = b - a
                at = np.repeat(a - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                overlap = overlap + np.bincount(owner[at], minlength=len(probes))
                alive &= enough(overlap + (high - end), sizes + low, percent)
                if not alive.any():
                    continue
            # sets that end here come first in their range
            done = lo
            while done < hi and self.sizes[done] == end:
                hit = np.flatnonzero(alive & enough(overlap, sizes + end, percent))
                if len(hit):
                    found.append((np.full(len(hit), self.order[done]), hit))
                done += 1
            if done < hi:
                heads = np.array([s[end] for s in self.sets[done:hi]])
                cuts = np.r_[0, np.flatnonzero(heads[1:] != heads[:-1]) + 1, len(heads)]
                stack += [(done + int(x), done + int(y), end, overlap, alive) for x, y in zip(cuts[:-1], cuts[1:])]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def meet(self, size: np.ndarray, rest: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pairs of lists with the same first member that may have enough members in common.

        A list is a stretch of an ordered longer one, which goes on for ``rest`` members and stands for a set of
        ``size``. Similar sets have more members of the longer lists in common than the smaller set can spare. The lists
        below one first member go down its subtree together, each pair once: a list is dropped where its overlap with
        the path, what is left of the longest list below and what both leave out cannot exceed that number.
        """
        size, rest, length = size[self.order], rest[self.order], self.sizes
        head = np.array([s[0] for s in self.sets], np.int64)
        cuts = np.r_[0, np.flatnonzero(head[1:] != head[:-1]) + 1, len(head)]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if stop - start < 2:
                continue
            members = np.concatenate(self.sets[start:stop])
            owner = np.repeat(np.arange(stop - start), length[start:stop])
            by_member = np.argsort(members, kind="stable")
            members, owner = members[by_member], owner[by_member]
            stack = [(start, stop, 0, np.arange(start + 1, stop), np.zeros(stop - start - 1, np.int64))]
            while stack:
                lo, hi, depth, probe, overlap = stack.pop()
                first = self.sets[lo]
                end = len(first) if hi - lo == 1 else shared_prefix(first, self.sets[hi - 1], depth)
                low, high = size[lo:hi].min(), size[lo:hi].max()
                a = np.searchsorted(members, first[depth:end], "left")
                count = np.searchsorted(members, first[depth:end], "right") - a
                at = np.repeat(a - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                overlap = overlap + np.bincount(owner[at], minlength=stop - start)[probe - start]
                left = overlap + length[lo:hi].max() - end + np.maximum(rest[probe], rest[lo:hi].max())
                alive = ((100 * size[probe] >= percent * low) & (100 * high >= percent * size[probe])
                         & (left > spare(np.minimum(size[probe], low), percent)))
                probe, overlap = probe[alive], overlap[alive]
                done = lo
                while done < hi and length[done] == end and len(probe):
                    lesser, greater = np.minimum(size[probe], size[done]), np.maximum(size[probe], size[done])
                    hit = ((probe > done) & (100 * lesser >= percent * greater)
                           & (overlap + np.maximum(rest[probe], rest[done]) > spare(lesser, percent)))
                    if hit.any():
                        found.append((np.full(int(hit.sum()), done), probe[hit]))
                    done += 1
                if done < hi and len(probe):
                    heads = np.array([s[end] for s in self.sets[done:hi]])
                    edges = np.r_[0, np.flatnonzero(heads[1:] != heads[:-1]) + 1, len(heads)] + done
                    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                        later = probe > x  # each pair from its earlier list
                        if later.any():
                            stack.append((x, y, end, probe[later], overlap[later]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.array(self.order)
        return tuple(order[np.concatenate(c)] for c in zip(*found))
