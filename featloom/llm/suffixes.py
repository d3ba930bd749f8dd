"""Suffix arrays by grouping: no sorting of ranks, no recursion, linear in the length."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes of ``symbols`` in ascending order.

    The last symbol must be smaller than all others. First every suffix gets into the group of those
    with the same longest Lyndon prefix, then the groups' order is written out.
    """
    group, before = lyndon_groups(symbols)
    n = len(symbols)
    slot = list(range(n))
    order = [-1] * n
    done = bytearray(n)
    if n:
        order[0] = n - 1
        done[n - 1] = 1
    for place in range(n):
        at = order[place] - 1
        # a suffix in order settles the one before it, and all whose Lyndon prefix ends there
        while at >= 0 and not done[at]:
            start = group[at]
            order[slot[start]] = at
            slot[start] += 1
            done[at] = 1
            at = before[at]
    return order


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[int]]:
    """Each suffix's group, named by the rank where the group starts, and its previous-smaller pointer.

    Groups begin as the suffixes of one first symbol and are taken from the largest down. Each member
    points to the nearest suffix before it of a smaller group. Suffixes pointed to from this group
    leave theirs for a new group right above it, one for each number of pointers received:
    the more copies of the group's prefix follow, the larger they are.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    group, place, size = [0] * n, [0] * n, [0] * (n + 1)
    start = 0
    for rank, at in enumerate(order):
        if rank and symbols[at] != symbols[order[rank - 1]]:
            start = rank
        group[at], place[at] = start, rank
        size[start] += 1
    before = [-1] * n
    high = n
    while high:
        low = group[order[high - 1]]
        pointed: dict[int, int] = {}
        for at in sorted(order[low:high]) if high - low > 1 else order[low:high]:
            to = at - 1
            while to >= 0 and group[to] >= low:
                to = before[to]
            before[at] = to
            if to >= 0:
                pointed[to] = pointed.get(to, 0) + 1
        high = low
        if len(pointed) == 1:
            levels = [list(pointed)]
        else:
            by_count: dict[int, list[int]] = {}
            for at, n_pointers in pointed.items():
                by_count.setdefault(n_pointers, []).append(at)
            levels = [by_count[k] for k in sorted(by_count, reverse=True)]
        for level in levels:
            moved: dict[int, list[int]] = {}
            for at in level:
                moved.setdefault(group[at], []).append(at)
            for old, members in moved.items():
                for at in members:
                    size[old] -= 1
                    last = old + size[old]
                    other, hole = order[last], place[at]
                    order[hole], place[other] = other, hole
                    order[last], place[at] = at, last
                new = old + size[old]
                for at in members:
                    group[at] = new
                size[new] = len(members)
    return group, before


def common_prefixes(symbols: Sequence[int], order: Sequence[int], stop: int) -> list[int]:
    """Symbols that each suffix in ``order`` shares with the one before it; ``stop`` never matches."""
    n = len(symbols)
    rank = [0] * n
    for place, at in enumerate(order):
        rank[at] = place
    shared = [0] * n
    length = 0
    for at in range(n):
        place = rank[at]
        if place:
            other = order[place - 1]
            while (
                at + length < n
                and other + length < n
                and symbols[at + length] == symbols[other + length]
                and symbols[at + length] > stop
            ):
                length += 1
            shared[place] = length
            length = length - 1 if length else 0
        else:
            length = 0
    return shared
