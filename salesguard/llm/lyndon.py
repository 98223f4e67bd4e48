"""Linear-time suffix sorting by grouping, for many small texts side by side.

The suffixes of a text are grouped by their longest Lyndon prefix. Groups
start as the text's letters and are taken in descending order: each member of
the group at hand is appended to the nearest position before it that lies in a
lower group (its previous smaller position), and positions of one group that
gained the same number of members move up together. When all are done, the
groups stand in the order of the suffixes, and one pass over the result in
ascending order puts every suffix at the next free place of its group, along
the same pointers. Nothing is renamed and nothing recurs.

The work is the same for every text, so the texts of a batch take their steps
together: a step handles the current group of each of them in numpy arrays.
"""

from __future__ import annotations

import numpy as np


class Batch:
    """Texts laid out one after the other. ``letters`` are 0 where a string of a
    text ends (every string has such an end, each distinct, below all letters)
    and above 0 elsewhere; ``bounds`` are the texts' begins and the whole length."""

    def __init__(self, letters: np.ndarray, bounds: np.ndarray):
        self.letters, self.bounds = letters, np.asarray(bounds, np.int32)
        n, sizes = len(letters), np.diff(bounds)
        self.n = n
        of = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        key = of * (int(letters.max(initial=0)) + 1) + letters
        self.sa = np.argsort(key, kind="stable").astype(np.int32)
        first = np.flatnonzero(np.r_[True, np.diff(key[self.sa]) != 0]) if n else np.empty(0, np.int64)
        ends = np.r_[first[1:], n].astype(np.int32)[:len(first)]
        self.at = np.empty(n, np.int32)                   # where in sa a position stands
        self.at[self.sa] = np.arange(n, dtype=np.int32)
        self.group = np.empty(n, np.int32)                # begin of the position's group in sa
        self.group[self.sa] = np.repeat(first.astype(np.int32), ends - first)
        self.end = np.zeros(n + 1, np.int32)              # by a group's begin
        self.end[first] = ends
        self.begin = np.zeros(n + 1, np.int32)            # by a group's end
        self.begin[ends] = first
        self.prev = np.arange(-1, n - 1, dtype=np.int32)  # nearest lower position known so far
        self.moved = np.zeros(n, bool)

    def sort(self) -> np.ndarray:
        """Positions in suffix order, text by text."""
        self.form()
        return self.emit()

    def form(self) -> None:
        """Groups by Lyndon prefix, in descending order."""
        top = self.bounds[1:].copy()
        floor = np.zeros(len(top), np.int32)
        if len(top):
            floor = self.end[self.bounds[:-1]].copy()     # the ends of strings are one group, never taken
        live = np.flatnonzero(top > floor)
        while len(live):
            begin = self.begin[top[live]]
            self.take(begin, top[live])
            top[live] = begin
            live = live[begin > floor[live]]

    def take(self, begin: np.ndarray, end: np.ndarray) -> None:
        """Appends the members of the groups [begin, end) to their previous smaller positions."""
        size = end - begin
        slot = np.repeat(begin - (np.cumsum(size) - size).astype(np.int32), size) + np.arange(size.sum(), dtype=np.int32)
        member = self.sa[slot]
        own = np.repeat(begin, size)
        prev, group = self.prev, self.group
        p = prev[member]
        todo = np.arange(len(member))
        while True:                                       # members of one group hop over each other, twice as far each time
            q = p[todo]
            safe = np.maximum(q, 0)
            # A position before the text lies in a lower slot of sa: its group begins below the text's.
            high = (q >= 0) & (group[safe] >= own[todo])
            todo = todo[high]
            if not len(todo):
                break
            p[todo] = prev[q[high]]
            prev[member[todo]] = p[todo]
        prev[member] = p
        p = p[p >= 0]
        p = p[self.letters[p] > 0]
        if not len(p):
            return
        p.sort()
        new = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        count = np.diff(np.r_[new, len(p)])
        p = p[new]
        order = np.lexsort((count, group[p]))             # more members: higher
        p, count = p[order], count[order]
        g = group[p]
        cut = np.r_[True, g[1:] != g[:-1]]
        first = np.flatnonzero(cut)
        many = np.diff(np.r_[first, len(p)]).astype(np.int32)
        old = g[first]
        tail = self.end[old] - many                       # the movers take the group's last places
        place = np.repeat(tail - first.astype(np.int32), many) + np.arange(len(p), dtype=np.int32)
        self.moved[p] = True
        there = self.sa[place]
        stay = there[~self.moved[there]]
        free = self.at[p][self.at[p] < np.repeat(tail, many)]
        # In both, groups follow in one order, and a group has as many in the one as in the other.
        self.sa[free] = stay
        self.at[stay] = free
        self.sa[place] = p
        self.at[p] = place
        self.moved[p] = False
        block = cut | np.r_[True, count[1:] != count[:-1]]
        start = place[np.flatnonzero(block)]
        ends = np.r_[start[1:], 0].astype(np.int32)
        last = np.r_[cut[np.flatnonzero(block)][1:], True]
        ends[last] = self.end[old]
        group[p] = np.repeat(start, np.diff(np.r_[np.flatnonzero(block), len(p)]))
        part = tail > old                                 # groups some of whose positions stay
        self.end[old[part]] = tail[part]
        self.begin[tail[part]] = old[part]
        self.end[start] = ends
        self.begin[ends] = start

    def emit(self) -> np.ndarray:
        """Each group's order, from the suffixes already in place.

        What is in place of a text's next group is taken at once: the position
        before each suffix and those up its pointers, as far as they are not in
        place, follow in the order of the suffixes that lead to them.
        """
        out = np.full(self.n, -1, np.int32)
        placed, seen = np.zeros(self.n, bool), np.zeros(self.n, np.int32)
        fill = np.zeros(self.n + 1, np.int32)             # by a group's begin
        letters, prev, group = self.letters, self.prev, self.group
        lo, hi = self.bounds[:-1], self.bounds[1:]
        ends = np.flatnonzero(letters == 0).astype(np.int32)
        of = np.searchsorted(lo, ends, side="right") - 1
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(ends) else np.empty(0, int)
        many = np.diff(np.r_[begin, len(ends)])
        out[lo[of] + np.arange(len(ends)) - np.repeat(begin, many)] = ends
        placed[ends] = True
        fill[lo[of[begin]]] = many
        at, live = lo.copy(), np.flatnonzero(hi > lo)
        while len(live):
            start = at[live]
            g = group[out[start]]
            g[letters[out[start]] == 0] = lo[live][letters[out[start]] == 0]
            stop = g + fill[g]
            at[live] = stop
            live = live[stop < hi[live]]
            size = stop - start
            first = np.cumsum(size) - size
            p = out[np.repeat(start - first.astype(np.int32), size) + np.arange(size.sum(), dtype=np.int32)] - 1
            by = np.arange(len(p), dtype=np.int32)
            found, leads = [], []
            while True:
                ok = p >= 0
                ok[ok] = ~placed[p[ok]]                    # ends of strings are in place
                p, by = p[ok], by[ok]
                if not len(p):
                    break
                found.append(p)
                leads.append(by)
                p = prev[p]
            if not found:
                continue
            p = found[0] if len(found) == 1 else np.concatenate(found)[np.argsort(np.concatenate(leads), kind="stable")]
            nth = np.arange(len(p), dtype=np.int32)
            seen[p[::-1]] = nth[::-1]
            p = p[seen[p] == nth]                          # the first way to a position counts
            g = group[p]
            order = np.argsort(g, kind="stable")
            p, g = p[order], g[order]
            new = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            count = np.diff(np.r_[new, len(p)]).astype(np.int32)
            out[g + fill[g] + np.arange(len(p), dtype=np.int32) - np.repeat(new.astype(np.int32), count)] = p
            fill[g[new]] += count
            placed[p] = True
        return out


def batch_of(texts: list[list[bytes]]) -> tuple[Batch, np.ndarray]:
    """A batch of texts, each a list of strings, and where each string begins."""
    sizes = np.array([len(s) + 1 for t in texts for s in t], np.int64)
    begins = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(s + b"\0" for t in texts for s in t), np.uint8)
    letters = raw.astype(np.int16) + 1
    letters[begins + sizes - 1] = 0
    per = np.array([len(t) for t in texts], np.int64)
    bounds = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(per)]]
    return Batch(letters, bounds), begins
