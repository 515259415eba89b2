"""Suffix arrays by grouping: Lyndon-prefix groups in descending order, then each group's order, without renaming."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, in linear time. ``symbols`` are integers of at least 1; a shorter suffix precedes.

    First phase: suffixes are grouped by their first symbol, and groups are taken from the greatest to the least. A
    suffix's pointer goes to the previous position of a smaller group; the suffixes pointed at extend their known
    Lyndon prefix by the group's, once for each pointer, and move to a greater group of their own, more pointers
    higher. When all groups are done, each holds the suffixes with one longest Lyndon prefix.
    Second phase: from the least suffix on, those that a suffix ends the Lyndon prefix of are next in their groups;
    they are its predecessor and the positions that this reaches over the pointers.
    """
    text = np.append(np.asarray(symbols, np.int64), 0)
    n = len(text)
    order = np.argsort(text, kind="stable")
    sorted_text = text[order]
    first = np.flatnonzero(np.append(True, sorted_text[1:] != sorted_text[:-1]))
    sizes = np.diff(np.append(first, n))
    size = np.zeros(n + 1, np.int64)
    size[first] = sizes
    group_of = np.empty(n, np.int64)
    group_of[order] = np.repeat(first, sizes)
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    sa, size, group, place = order.tolist(), size.tolist(), group_of.tolist(), place_of.tolist()
    previous, skip = [-1] * n, list(range(-1, n - 1))

    end = n - 1
    while end >= 0:
        start = group[sa[end]]
        if start == end:
            i = sa[end]
            p = skip[i]
            while p >= 0 and group[p] >= start:
                p = skip[p]
            previous[i] = skip[i] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:
                    last, at = g + left, place[p]
                    if at != last:
                        other = sa[last]
                        sa[at], place[other] = other, at
                        sa[last], place[p] = p, last
                    size[g], size[last] = left, 1
                    group[p] = last
            end -= 1
            continue
        count: dict[int, int] = {}
        for i in sorted(sa[start : end + 1]):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = skip[p]
            previous[i] = skip[i] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        if count:
            most = max(count.values())
            if most == 1:
                levels = [list(count)]
            else:
                levels = [[] for _ in range(most)]
                for p, k in count.items():
                    levels[most - k].append(p)
            for moved in levels:
                for p in moved:
                    g = group[p]
                    size[g] = left = size[g] - 1
                    last, at = g + left, place[p]
                    if at != last:
                        other = sa[last]
                        sa[at], place[other] = other, at
                        sa[last], place[p] = p, last
                for p in moved:
                    g = group[p]
                    new = g + size[g]
                    # the group may be left empty: then it keeps its place and is filled again
                    group[p] = new
                    if new != g:
                        size[new] = 0
                for p in moved:
                    size[group[p]] += 1
        end = start - 1

    sa, filled, done = [n - 1] + [0] * (n - 1), list(range(n)), [False] * n
    for at in range(n):
        s = sa[at] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            sa[filled[g]] = s
            filled[g] += 1
            done[s] = True
            s = previous[s]
    return np.array(sa[1:], np.int64)
