"""Suffix sorting by grouping, without recursion or renaming, of many texts side by side.

The construction has two phases.  First every suffix is put into the group of its longest Lyndon
prefix: groups start as equal first symbols and are taken in descending order; the members of the
taken group point to their previous smaller position (the nearest one to the left that is in a
lower group), and the positions pointed to leave their group for a new one just above it, apart by
how many members point to them.  Then groups are emitted in ascending order: each sorted suffix
places the position before it, and, along the previous-smaller pointers, those before that, at the
next free slot of their groups.

Both phases take a number of steps linear in a text's length.  One numpy call carries the same
step of all texts of a batch, so batches of many short texts are what it is made for.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sorted suffixes of texts that lie one after another in ``symbols``.

    Text t has ``sizes[t]`` symbols, the last of them 0.  A 0 ends a string of its text: it is
    below all other symbols, and of two zeros the later one is below the earlier.  Returns the
    positions in ``symbols``, text by text, each text's suffixes in ascending order.
    """
    total = int(sizes.sum())
    stop = np.cumsum(sizes)
    base = stop - sizes
    at = np.arange(total)
    text = np.repeat(np.arange(len(sizes)), sizes)
    zero = symbols == 0
    slots = np.lexsort((np.where(zero, -at, at), symbols, text))       # slot -> position
    first = np.ones(total, bool)
    s = symbols[slots]
    first[1:] = (s[1:] != s[:-1]) | (s[1:] == 0) | (text[slots][1:] != text[slots][:-1])
    starts = np.flatnonzero(first)
    group = np.empty(total + 1, np.int64)                              # position -> start of group
    group[slots] = np.repeat(starts, np.diff(np.append(starts, total)))
    group[total] = -1                                                  # no position
    size = np.zeros(total, np.int64)
    size[starts] = np.diff(np.append(starts, total))
    slot = np.empty(total, np.int64)                                   # position -> slot
    slot[slots] = at
    previous = np.arange(-1, total)
    previous[base] = total
    previous[total] = total
    floor = base + np.add.reduceat(zero.astype(np.int64), base)        # slots of the zeros end here
    _group(slots, slot, group, size, previous, floor, stop.copy())
    return _emit(group, previous, base, stop)


def _group(slots, slot, group, size, previous, floor, high) -> None:
    """Phase one, in place: ``group`` and ``previous`` get their final values."""
    moving = np.zeros(len(slots), bool)
    todo = np.flatnonzero(high > floor)
    while len(todo):
        top = high[todo]
        low = group[slots[top - 1]]
        count = top - low
        ends = np.cumsum(count)
        member = slots[np.arange(ends[-1]) + np.repeat(low - ends + count, count)]
        mine, bottom = np.repeat(low, count), np.repeat(floor[todo], count)

        # pointers to the previous smaller position, over positions of higher and equal groups
        point = previous[member]
        far = np.flatnonzero(group[point] >= mine)
        while len(far):
            point[far] = previous[point[far]]
            previous[member[far]] = point[far]
            far = far[group[point[far]] >= mine[far]]

        high[todo] = low
        todo = todo[low > floor[todo]]
        real = np.sort(point[group[point] >= bottom])
        if not len(real):
            continue
        edge = np.flatnonzero(np.concatenate([[True], real[1:] != real[:-1]]))
        node, times = real[edge], np.diff(np.append(edge, len(real)))
        order = np.lexsort((times, group[node]))
        node, times = node[order], times[order]
        old = group[node]
        change = np.concatenate([[True], old[1:] != old[:-1]])
        lead = np.flatnonzero(change)
        took = np.diff(np.append(lead, len(node)))
        of = old[lead]
        tail = of + size[of] - took
        goal = np.arange(len(node)) + np.repeat(tail - lead, took)

        # the last slots of a group go to those that leave it; who stood there takes their slots
        moving[node] = True
        stood, was = slots[goal], slot[node]
        stays = stood[~moving[stood]]
        moving[node] = False
        free = was[was < np.repeat(tail, took)]
        slots[free] = stays
        slot[stays] = free
        slots[goal] = node
        slot[node] = goal

        part = np.flatnonzero(change | np.concatenate([[True], times[1:] != times[:-1]]))
        width = np.diff(np.append(part, len(node)))
        size[of] -= took
        size[goal[part]] = width
        group[node] = np.repeat(goal[part], width)


def _emit(group, previous, base, stop) -> np.ndarray:
    """Phase two: the sorted positions."""
    total = len(group) - 1
    out = np.zeros(total, np.int64)
    placed = np.zeros(total + 1, bool)
    placed[total] = True
    free = np.arange(total + 1)                                        # start of group -> next slot
    texts = np.arange(len(base))
    scan, left = base - 1, stop - base
    now = stop - 1                                                     # position to place, or total
    while len(texts):
        idle = now == total
        if idle.any():
            scan = scan + idle
            at = out[scan[idle]]
            before = np.where(at > base[texts[idle]], at - 1, total)
            now[idle] = np.where(placed[before], total, before)
        busy = now < total
        put = now[busy]
        g = group[put]
        out[free[g]] = put
        free[g] += 1
        placed[put] = True
        step = previous[put]
        now[busy] = np.where(placed[step], total, step)
        left = left - busy
        if not left.all():
            on = left > 0
            texts, scan, left, now = texts[on], scan[on], left[on], now[on]
    return out
