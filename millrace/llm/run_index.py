"""A run-length compressed index of many short strings, and matching statistics over it.

The strings are laid out one after another with separators that differ from each other. The
Burrows-Wheeler transform of the text is kept as runs, with the text positions of the first and
the last row of each run. A pattern is streamed from its end: where the row's run has the next
character, the row moves by the run's own offset, and its new run is found from the run where
that offset leads; elsewhere it jumps to the last row of the run
above or the first row of the run below that has it, whichever continues the pattern longer.
So for every position of the pattern one of its longest matches is known by row and place.
All patterns are streamed side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 15  # suffixes sorted together
LONGEST = 111  # bytes of a string; with its separator it fits the last round of sorting


def _first_order(key: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first symbols, and where a group of equals starts.

    Suffixes whose separator is among these symbols are in their final order: by place, and alone.
    """
    order = np.argsort(key)
    fresh = np.empty(len(key), bool)
    fresh[:1] = True
    ordered = key[order]
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    del ordered
    slots = np.flatnonzero(ended[order])
    within = np.argsort((np.cumsum(fresh, dtype=np.int64)[slots] << 32) | order[slots])
    order[slots] = order[slots][within]
    fresh[slots] = True
    return order, fresh


def _sorted_groups(items: np.ndarray, opens: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items sorted within groups that stand one after another, and where a group of equals starts now.

    Keys are packed as (group, by, place) and sorted block by block, each in a core's cache.
    """
    out, head = np.empty_like(items), np.empty(len(items), bool)
    first = np.flatnonzero(opens)
    bits = int(by.max()).bit_length()
    cuts = first[np.flatnonzero(np.diff(first // BLOCK)) + 1]
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(items)]):
        own = (b - a).bit_length()
        key = np.cumsum(opens[a:b], dtype=np.int64) << bits | by[a:b]
        if bits + 2 * own <= 63:
            key = np.sort(key << own | np.arange(b - a))
            place = key & ((1 << own) - 1)
            key >>= own
        else:
            place = np.argsort(key)
            key = key[place]
        out[a:b] = items[a:b][place]
        head[a] = True
        np.not_equal(key[1:], key[:-1], out=head[a + 1 : b])
    return out, head


class RunIndex:
    """Index of byte strings of at most LONGEST bytes, given as one array and their lengths."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, span: int):
        self.lengths, self.span = lengths.astype(np.int64), span
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        n = int(self.lengths.sum()) + len(lengths)
        text = np.zeros(n + 8, np.uint8)
        inside = np.ones(n, bool)
        inside[self.starts + self.lengths] = False
        text[:n][inside] = data
        self.text, self.n = text, n
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), self.lengths + 1)
        self.left = ((self.starts + self.lengths)[owner] - np.arange(n)).astype(np.int32)  # characters before the separator
        symbols = np.zeros(n + 7, np.uint16)
        symbols[:n][inside] = data.astype(np.uint16) + np.uint16(1)
        del inside
        # Seven symbols of nine bits; what follows a separator does not count, so such suffixes stand alone.
        one = symbols.astype(np.uint64)
        two = one[:-1] << np.uint64(9) | one[1:]
        key = (two[:-2] << np.uint64(18) | two[2:])[:n]
        key = (key << np.uint64(18) | two[4 : n + 4]) << np.uint64(9) | one[6 : n + 6]
        del one, two
        ended = self.left < 7
        idle = (9 * (7 - self.left[ended])).astype(np.uint64)
        key[ended] = key[ended] >> idle << idle
        order, fresh = _first_order(key, ended)
        del key
        # The rank of a suffix is the slot where its group of equals starts.
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), 0))
        self.half, width = None, 7
        while width <= LONGEST:
            if 2 * width > span and self.half is None:
                self.half = (rank.copy(), width)
            # Only groups of several are sorted on, by the rank of what follows.
            single = fresh.copy()
            single[:-1] &= fresh[1:]
            slots = np.flatnonzero(~single)
            if len(slots):
                item = order[slots]
                opens = fresh[slots]
                item, head = _sorted_groups(item, opens, rank[np.minimum(item + width, n - 1)])
                order[slots] = item
                fresh[slots] = head
                rank[item] = np.maximum.accumulate(np.where(head, slots, 0))
            width *= 2
        self._compress(order, symbols[:n], owner)

    def _compress(self, places: np.ndarray, symbols: np.ndarray, owner: np.ndarray) -> None:
        n = self.n
        bwt = symbols[places - 1]
        first = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        last = np.r_[first[1:], n] - 1
        self.run_start, self.run_char = first, bwt[first].astype(np.int64)
        self.head, self.tail = places[first], places[last]
        self.run_last = last
        by_char = np.argsort(self.run_char, kind="stable")
        sizes = (last - first + 1)[by_char]
        base = np.empty(len(first), np.int64)
        base[by_char] = np.cumsum(sizes) - sizes  # rows are sorted by first symbol, so runs of a symbol fill its rows in order
        self.base = base
        self.next_run = np.searchsorted(first, base, "right") - 1  # the run that holds the row of the run's first symbol
        self.by_char, self.keys = by_char, self.run_char[by_char] * (n + 1) + by_char
        # Rows that agree in the first `span` bytes form a group; of each the smallest owner is kept.
        rank, width = self.half
        one, two = rank[places], rank[np.minimum(places + self.span - width, n - 1)]
        whole = self.left[places] >= self.span
        fresh = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | ~whole[1:] | ~whole[:-1]]
        self.group = np.cumsum(fresh, dtype=np.int32) - 1
        self.first_owner = np.minimum.reduceat(owner[places], np.flatnonzero(fresh))

    @property
    def runs(self) -> int:
        return len(self.run_start)

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes agree from places a and b on, at most `most` and up to a separator."""
        most = np.minimum(most, np.minimum(self.left[np.minimum(a, self.n - 1)], self.left[np.minimum(b, self.n - 1)]))
        out, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        step = 0
        while len(open_):
            open_ = open_[out[open_] < most[open_]]
            same = self.text[a[open_] + step] == self.text[b[open_] + step]
            open_ = open_[same]
            out[open_] += 1
            step += 1
        return np.minimum(out, most)

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stream every string; (string, offset, row) of all its places with a match of `span` bytes."""
        # The longest first, so that those still streamed are the leading ones.
        by = np.argsort(-self.lengths, kind="stable")
        row, held = np.zeros(len(by), np.int64), np.zeros(len(by), np.int64)
        place = np.full(len(by), self.head[0], np.int64)
        ends, longer = (self.starts + self.lengths)[by], -self.lengths[by]
        move, stop = self.base - self.run_start, np.r_[self.run_start[1:], self.n + 1]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for t in range(1, int(self.lengths.max(initial=0)) + 1):
            live = int(np.searchsorted(longer, -t, "right"))
            at = ends[:live] - t
            char = self.text.take(at).astype(np.int64) + 1
            run, target, where = held[:live], row[:live], place[:live]
            miss = np.flatnonzero(self.run_char.take(run) != char)
            if len(miss):
                key = char[miss] * (self.n + 1) + run[miss]
                below = np.searchsorted(self.keys, key)
                above = below - 1
                has_below = below < len(self.keys)
                has_below &= self.run_char[self.by_char[np.minimum(below, len(self.keys) - 1)]] == char[miss]
                has_above = (above >= 0) & (self.run_char[self.by_char[np.maximum(above, 0)]] == char[miss])
                up, down = self.by_char[np.maximum(above, 0)], self.by_char[np.minimum(below, len(self.keys) - 1)]
                most = np.full(len(miss), t - 1)
                up_agree = np.where(has_above, self._agree(at[miss] + 1, self.tail[up], most), -1)
                down_agree = np.where(has_below, self._agree(at[miss] + 1, self.head[down], most), -1)
                rise = up_agree >= down_agree
                run[miss] = np.where(rise, up, down)
                target[miss] = np.where(rise, self.run_last[up], self.run_start[down])
                where[miss] = np.where(rise, self.tail[up], self.head[down])
            target += move.take(run)
            run[:] = self.next_run.take(run)
            behind = np.flatnonzero(target >= stop.take(run))
            while len(behind):
                run[behind] += 1
                behind = behind[target[behind] >= stop[run[behind]]]
            where -= 1
            if t >= self.span:
                found.append((by[:live], at, target.copy(), where.copy()))
        if not found:
            empty = np.empty(0, np.int64)
            return empty, empty, empty
        string, at, rows, places = (np.concatenate(c) for c in zip(*found))
        rank, width = self.half
        shift = self.span - width
        whole = (self.left[places] >= self.span) & (rank[at] == rank[places])
        whole &= rank[at + shift] == rank[np.minimum(places + shift, self.n - 1)]
        return string[whole], (at - self.starts[string])[whole], rows[whole]
