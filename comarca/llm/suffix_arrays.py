"""Suffix arrays of byte strings in numpy: refinement by doubling, common prefixes, merging."""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one big-endian number (zeros after the end)."""
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k:k + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the first ``depth`` bytes of their suffixes (or more of them).

    Larsson and Sadakane's refinement: suffixes are grouped by their first h bytes; groups of
    more than one suffix are sorted by the group of the suffix h bytes further on, which
    doubles h, and suffixes that stand alone are not touched again.
    """
    n = len(data)
    first = words_at(data)
    order = np.argsort(first)
    key = first[order]
    head = np.append(True, key[1:] != key[:-1])
    group = np.empty(n + 1, np.int64)
    group[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    group[n] = -1
    h = 8
    while h < depth:
        alone = head & np.append(head[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        suffixes = order[at]
        key = group[suffixes] << 32 | (group[np.minimum(suffixes + h, n)] + 1)
        perm = np.argsort(key)
        key, suffixes = key[perm], suffixes[perm]
        order[at] = suffixes
        head[at] = np.append(True, key[1:] != key[:-1])
        group[suffixes] = np.maximum.accumulate(np.where(head[at], at, 0))
        h *= 2
    return order


def _equal_bytes(words: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(limit > 0)
    step, last = 0, len(words) - 1
    while len(open_):
        x = words[np.minimum(a[open_] + step, last)] ^ words[np.minimum(b[open_] + step, last)]
        same = sum((x < np.uint64(1 << s)).astype(np.int64) for s in range(0, 64, 8))
        out[open_] += same
        step += 8
        open_ = open_[(same == 8) & (limit[open_] > step)]
    return np.minimum(out, limit)


def common_prefixes(data: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it (0 for the first).

    Kasai's observation, for all positions at once: where position i and its predecessor j
    follow positions i - 1 and j - 1 that are neighbours too, the prefix is the one of those
    less one byte.  Only positions that start such a run, or lie beyond its prefix, are
    compared.  ``room`` is the number of bytes from each position to the end of its own string.
    """
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    words, n = words_at(data), len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.sort(order[1:])
    prior = before[place]
    limit = np.minimum(room[place], room[prior])
    follows = np.append(False, (np.diff(place) == 1) & (np.diff(prior) == 1)
                        & (np.diff(room[place]) == -1) & (np.diff(room[prior]) == -1))
    length = np.zeros(len(place), np.int64)
    todo = ~follows
    compared = np.zeros(len(place), bool)
    while todo.any():
        length[todo] = _equal_bytes(words, place[todo], prior[todo], limit[todo])
        compared |= todo
        known = np.flatnonzero(compared | (length > 0))
        last = np.zeros(len(place), np.int64)
        last[known] = known
        np.maximum.accumulate(last, out=last)
        passed = np.arange(len(place)) - last
        same_run = np.cumsum(~follows)
        ahead = np.where(same_run == same_run[last], length[last] - passed, 0)
        length = np.where(length > 0, length, np.maximum(ahead, 0))
        missing = (length == 0) & ~compared
        # a run's prefix is used up: compare at the first position behind it
        todo = missing & np.append(True, ~missing[:-1])
    out = np.zeros(n, np.int64)
    out[place] = length
    return out[order]


def distinct_strings(data: np.ndarray, starts: np.ndarray, room: np.ndarray, values: np.ndarray,
                     width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings of ``width`` bytes at ``starts``: in order, the least value of each,
    and for every start the number of its string."""
    chosen = np.zeros(len(data), bool)
    chosen[starts] = True
    order = suffix_array(data, width)
    order = order[chosen[order]]
    shared = common_prefixes(data, order, room)
    head = shared < width
    head[0] = True
    number = np.empty(len(data), np.int64)
    number[order] = np.cumsum(head) - 1
    value = np.empty(len(data), np.int64)
    value[starts] = values
    least = np.minimum.reduceat(value[order], np.flatnonzero(head))
    texts = np.ascontiguousarray(data[order[head][:, None] + np.arange(width)]).view(f"S{width}").ravel()
    return texts, least, number[starts]


def merge(texts: np.ndarray, least: np.ndarray, more: np.ndarray,
          more_least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two ordered lists of distinct strings as one: each string of the second is sought in the
    first by binary search."""
    at = np.searchsorted(texts, more)
    found = np.zeros(len(more), bool)
    inner = at < len(texts)
    found[inner] = texts[at[inner]] == more[inner]
    least = least.copy()
    np.minimum.at(least, at[found], more_least[found])
    return np.insert(texts, at[~found], more[~found]), np.insert(least, at[~found], more_least[~found])
