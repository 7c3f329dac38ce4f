"""Suffix arrays by induced sorting, in array form: a bucket's frontier is moved at once, not one suffix at a time."""

from __future__ import annotations

import numpy as np

#: Above this many symbols a scan bucket by bucket costs more than doubling ranks.
SYMBOLS = 4096


def classify(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix is smaller than its right neighbour, leftmost-smaller positions); `s` ends in a unique least symbol."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])
    ends = np.append(change, n - 1)
    smaller = np.append(s[change] < s[change + 1], True)
    kind = np.repeat(smaller, np.diff(np.concatenate([[-1], ends])))
    left = np.zeros(n, bool)
    left[1:] = kind[1:] & ~kind[:-1]
    return kind, np.flatnonzero(left)


def _place(sa: np.ndarray, at: np.ndarray, items: np.ndarray, symbols: np.ndarray, step: int) -> None:
    """Append `items` to the buckets of their symbols, keeping their order; `at` moves by `step` per item."""
    if not len(items):
        return
    order = np.argsort(symbols, kind="stable")
    items, symbols = items[order], symbols[order]
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    size = np.diff(np.append(first, len(items)))
    keys = symbols[first]
    rank = np.arange(len(items)) - np.repeat(first, size)
    sa[np.repeat(at[keys], size) + step * rank] = items
    at[keys] += step * size


def induce(s: np.ndarray, kind: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order; by one scan up and one scan down the buckets."""
    n = len(s)
    sizes = np.bincount(s, minlength=symbols)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.zeros(n, np.int64)
    seed_symbols = s[seeds]
    cut = np.searchsorted(seed_symbols, np.arange(symbols + 1))
    present = np.flatnonzero(sizes)
    at = starts.copy()
    for c in present:
        done = starts[c]
        while done < at[c]:
            front = sa[done:at[c]]
            done = at[c]
            back = front[front > 0] - 1
            back = back[~kind[back]]
            _place(sa, at, back, s[back], 1)
        back = seeds[cut[c]:cut[c + 1]]
        back = back[back > 0] - 1
        _place(sa, at, back, s[back], 1)
    larger_end = at
    at = ends - 1
    at[s[n - 1]] = ends[s[n - 1]] - 1
    for c in present[::-1]:
        if c == s[n - 1]:
            sa[ends[c] - 1] = n - 1
            at[c] -= 1
            continue
        done = ends[c] - 1
        while done > at[c]:
            front = sa[at[c] + 1:done + 1][::-1]
            done = at[c]
            back = front[front > 0] - 1
            back = back[kind[back]]
            _place(sa, at, back, s[back], -1)
        front = sa[starts[c]:larger_end[c]][::-1]
        back = front[front > 0] - 1
        back = back[kind[back]]
        _place(sa, at, back, s[back], -1)
    return sa


def doubled(s: np.ndarray) -> np.ndarray:
    """Suffix order by doubling ranks, for strings over many symbols; only unsettled suffixes are sorted again."""
    n, step = len(s), 1
    order = np.argsort(s)
    ordered = s[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    places = np.flatnonzero(np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n))))
    while len(places):
        items = order[places]
        after = items + step
        key = rank[items] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        turn = np.argsort(key)
        items, key = items[turn], key[turn]
        order[places] = items
        # Unsettled groups are contiguous runs of places, so a new rank is the place of its group's first suffix.
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(items)))
        rank[items] = np.repeat(places[first], size)
        places = places[np.repeat(size > 1, size)]
        step *= 2
    return order


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Order of all suffixes of `s`, whose last symbol is 0 and occurs nowhere else."""
    if len(s) <= 2:
        return np.arange(len(s))[::-1].copy()
    if symbols > SYMBOLS:
        return doubled(s)
    kind, left = classify(s)
    # Sort the substrings between leftmost-smaller positions by inducing from them in bucket order.
    order = induce(s, kind, left[np.argsort(s[left], kind="stable")], symbols)
    is_left = np.zeros(len(s), bool)
    is_left[left] = True
    order = order[is_left[order]]
    # Name equal substrings alike: compare neighbours symbol by symbol up to the end of the longer one.
    nxt = np.empty(len(s), np.int64)
    nxt[left] = np.append(left[1:], left[-1])
    a, b = order[:-1], order[1:]
    length = nxt[a] - a
    differ = length != nxt[b] - b
    pending, step = np.flatnonzero(~differ), 0
    while len(pending):
        x, y = a[pending] + step, b[pending] + step
        unlike = s[x] != s[y]
        differ[pending[unlike]] = True
        step += 1
        pending = pending[~unlike & (length[pending] >= step)]
    names = np.concatenate([[0], np.cumsum(differ)])
    name_at = np.empty(len(s), np.int64)
    name_at[order] = names
    if names[-1] + 1 < len(left):
        reduced = name_at[left]
        order = left[suffix_array(reduced, int(names[-1]) + 1)]
    return induce(s, kind, order, symbols)


def shared_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of text[a:] and text[b:], cut at `most`; all pairs advance together."""
    n, out = len(text), np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    width = 8
    padded = np.concatenate([text, np.zeros(width, np.uint8)])
    block = np.lib.stride_tricks.sliding_window_view(padded, width)
    while len(live):
        x, y = np.minimum(a[live] + out[live], n), np.minimum(b[live] + out[live], n)
        same = block[x] == block[y]
        gained = np.where(same.all(1), width, np.argmin(same, axis=1))
        out[live] += gained
        live = live[(gained == width) & (out[live] < most)]
    return np.minimum(out, most)
