"""A run-compressed Burrows-Wheeler index of a bounded block, and its matching statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_PACKED = 7  # symbols of 9 bits in a first key


@dataclass
class RunIndex:
    """Runs of the transform: the symbol of each, where it begins, and text positions and matches at its ends.

    ``head_match`` is how far the suffix at a run's head agrees with the suffix before
    it in the order, ``tail_match`` how far the one at its tail agrees with the next.
    """

    size: int
    symbol: np.ndarray
    begin: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    head_match: np.ndarray
    tail_match: np.ndarray

    def matching_statistics(self) -> np.ndarray:
        """For every text position, the longest match that starts at any other position.

        Inside a run the neighbour in the order has the same symbol before it, so the
        match of a text position is that of the position before it, less one. Only run
        ends are sampled; the rest is streamed along the text from sample to sample.
        """
        return np.maximum(self._streamed(self.head, self.head_match), self._streamed(self.tail, self.tail_match))

    def _streamed(self, position: np.ndarray, match: np.ndarray) -> np.ndarray:
        reach = np.full(self.size, -1, dtype=np.int64)
        reach[position] = match + position  # where the match ends
        sampled = np.zeros(self.size, dtype=np.int64)
        sampled[position] = position
        latest = np.maximum.accumulate(sampled)
        return np.maximum(reach[latest] - np.arange(self.size), 0)


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling. ``text`` holds bytes plus 1 and separators 0, all taken as different.

    ``left`` tells how many symbols follow before the next separator.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(_PACKED, dtype=np.uint64)])
    key = np.zeros(n, dtype=np.uint64)
    for j in range(_PACKED):
        key = (key << np.uint64(9)) | np.where(left >= j, padded[j : j + n], 0).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ended = left[order] < _PACKED
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (key[order][1:] != key[order][:-1]) | ended[1:] | ended[:-1]
    rank = np.empty(n, dtype=np.int64)
    starts = np.flatnonzero(fresh)
    rank[order] = starts[np.cumsum(fresh) - 1]  # the place of the first of its equals
    width = _PACKED
    while True:
        closing = np.append(fresh[1:], True)
        open_places = np.flatnonzero(~(fresh & closing))
        if not len(open_places):
            return order
        suffix = order[open_places]
        pair = rank[suffix] * (n + 1) + rank[suffix + width]
        again = np.argsort(pair, kind="stable")
        suffix, pair = suffix[again], pair[again]
        order[open_places] = suffix
        new = np.ones(len(pair), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        fresh[open_places] = new
        rank[suffix] = open_places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        width *= 2


def _agreement(text: np.ndarray, left: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many symbols two suffixes share before a separator, eight at a time."""
    most = np.minimum(left[one], left[other])
    raw = np.concatenate([(text - 1).astype(np.uint8), np.zeros(8, dtype=np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(raw, 8)
    shared = np.zeros(len(one), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        at = shared[live]
        same = eight[one[live] + at] == eight[other[live] + at]
        run = np.where(same.all(axis=1), 8, np.argmin(same, axis=1))
        shared[live] = np.minimum(at + run, most[live])
        live = live[(run == 8) & (shared[live] < most[live])]
    return shared


def build(segments: list[bytes]) -> tuple[RunIndex, np.ndarray]:
    """The index of all segments together, and where each begins. No match runs over a segment's end."""
    sizes = np.array([len(segment) + 1 for segment in segments], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"\0".join(segments) + b"\0", dtype=np.uint8)
    text = raw.astype(np.int64) + 1
    ends = begins + sizes - 1
    text[ends] = 0
    n = len(text)
    left = np.repeat(ends, sizes) - np.arange(n)
    order = suffix_order(text, left)
    before = text[order - 1]  # the separator of the last segment stands before the first
    heads = np.ones(n, dtype=bool)
    heads[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    begin = np.flatnonzero(heads)
    finish = np.append(begin[1:], n) - 1
    head, tail = order[begin], order[finish]
    head_match, tail_match = np.zeros(len(begin), dtype=np.int64), np.zeros(len(begin), dtype=np.int64)
    head_match[1:] = _agreement(text, left, head[1:], order[begin[1:] - 1])
    tail_match[:-1] = head_match[1:]
    return RunIndex(n, before[begin], begin, head, tail, head_match, tail_match), begins
