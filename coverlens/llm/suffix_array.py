"""Suffix arrays by linear grouping, and the repeated windows they show; used on blocks of bounded size."""

from __future__ import annotations

import numpy as np

from coverlens.llm.common import prefix_hashes, substring_hashes


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of all suffixes of ``text`` in lexicographic order.

    First, suffixes are grouped by their longest Lyndon prefix: groups are processed in descending
    order; every member points to the previous suffix of a lower group, and those that
    are pointed to move up within their group, the higher the more members point to them.
    Then the order within all groups is emitted in one ascending sweep.  Nothing is renamed and no
    recursion is needed.  A group is named by its first place in the result.
    """
    n = len(text)
    by_first: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_first.setdefault(symbol, []).append(i)
    group = [0] * n                      # of each suffix
    members: dict[int, list[int]] = {}   # ascending; a suffix that moved on is skipped when read
    size = [0] * n                       # by group
    group_ending = [0] * n               # the group whose last place this is
    start = 0
    for symbol in sorted(by_first):
        own = by_first[symbol]
        members[start], size[start] = own, len(own)
        for i in own:
            group[i] = start
        start += len(own)
        group_ending[start - 1] = start - len(own)

    previous = [-1] * n  # nearest suffix before, of a lower group
    last = n - 1
    while last >= 0:
        here = group_ending[last]
        last = here - 1
        pointed: dict[int, list[int]] = {}  # number of pointers -> suffixes, ascending
        target, count = -1, 0
        for s in members.pop(here):
            if group[s] != here:
                continue
            p = s - 1
            while p >= 0 and group[p] >= here:
                p = previous[p]
            previous[s] = p
            if p != target:
                if target >= 0:
                    pointed.setdefault(count, []).append(target)
                target, count = p, 0
            count += 1
        if target >= 0:
            pointed.setdefault(count, []).append(target)
        for count in sorted(pointed, reverse=True):
            moving: dict[int, list[int]] = {}
            for p in pointed[count]:
                moving.setdefault(group[p], []).append(p)
            for old, movers in moving.items():
                rest = size[old] - len(movers)
                if rest == 0:
                    continue  # the whole group moves: nothing is left below it
                new = old + rest
                size[old], size[new] = rest, len(movers)
                group_ending[new + len(movers) - 1], group_ending[new - 1] = new, old
                members[new] = movers
                for p in movers:
                    group[p] = new

    order = [-1] * (n + 1)  # the empty suffix comes first
    order[0] = n
    free = list(range(1, n + 1))  # next free place by group
    placed = bytearray(n)
    for i in range(n + 1):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            order[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = previous[s]
    return order[1:]


def repeated_windows(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of several distinct byte strings, which of its ``length``-byte windows stand elsewhere
    in the same or another string: a boolean array by start."""
    starts = np.cumsum([0] + [len(c) for c in contexts])
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    # a separator of its own after each string keeps matches inside
    symbols: list[int] = []
    places = np.empty(len(data) + len(contexts), dtype=np.int64)
    for i, context in enumerate(contexts):
        places[starts[i] + i:starts[i + 1] + i] = np.arange(starts[i], starts[i + 1])
        places[starts[i + 1] + i] = -1
        symbols.extend(b + len(contexts) for b in context)
        symbols.append(i)
    order = places[np.array(suffix_array(symbols), dtype=np.int64)]
    ends = np.repeat(starts[1:], np.diff(starts))
    # suffixes with a whole window ahead; those of equal windows are neighbours in the order
    order = order[order >= 0]
    order = order[order + length <= ends[order]]
    repeated = np.zeros(len(data), dtype=bool)
    if len(order) > 1:
        hashes = substring_hashes(prefix_hashes(data), order, order + length)
        for k in np.flatnonzero(hashes[1:] == hashes[:-1]):
            a, b = order[k], order[k + 1]
            if not (repeated[a] and repeated[b]) and np.array_equal(data[a:a + length], data[b:b + length]):
                repeated[a] = repeated[b] = True
    return [repeated[starts[i]:max(starts[i], starts[i + 1] - length + 1)] for i in range(len(contexts))]
