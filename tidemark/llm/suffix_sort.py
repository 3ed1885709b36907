"""Suffix sorting by Lyndon-prefix groups, and what repeats in a set of byte strings."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

SYMBOL = 64  # bytes: strings with a longer symbol are sorted byte by byte
_SYMBOLS = re.compile(rb"[^\t-\r ]*[\t-\r ]|[^\t-\r ]+")


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes of ``text`` in order; its last number must be the only least one.

    First pass: suffixes are grouped by their longest Lyndon prefix. They begin grouped by their
    first number. Groups are taken from the highest down; each member points to the nearest
    earlier suffix of a lower group, whose known prefix it extends, and those that are extended
    most often leave their group first, to stand directly above it. A group is known by the place
    in the order where it begins. Second pass: in final order, each suffix puts those whose Lyndon
    prefix ends where it begins at the front of what is left of their groups; these are the chain
    of pointers from its predecessor. No numbers are renamed and nothing recurses.
    """
    n = len(text)
    numbers = np.array(text)
    by_number = np.argsort(numbers, kind="stable")
    begins = np.flatnonzero(np.concatenate(([True], np.diff(numbers[by_number]) != 0)))
    ends = np.append(begins[1:], n)
    group_of = np.empty(n, np.int64)
    group_of[by_number] = np.repeat(begins, ends - begins)
    group, placed = group_of.tolist(), by_number.tolist()
    bounds = list(zip(begins.tolist(), ends.tolist(), strict=True))
    members = {a: placed[a:b] for a, b in bounds}
    size = {a: b - a for a, b in bounds}
    start_of_end = {b: a for a, b in bounds}
    smaller = [-1] * n  # the pointers
    end = n
    while end > 0:
        begin = start_of_end[end]
        now = [i for i in members.pop(begin) if group[i] == begin]
        now.sort()
        times: dict[int, int] = {}
        for i in now:
            j = i - 1
            while j >= 0 and group[j] >= begin:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        if times:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, k in times.items():
                moved.setdefault((-k, group[j]), []).append(j)
            for key in sorted(moved) if len(moved) > 1 else moved:
                old, out = key[1], moved[key]
                left = size[old] - len(out)
                if left:
                    new = old + left
                    size[old], size[new] = left, len(out)
                    start_of_end[new + len(out)] = new
                    start_of_end[new] = old
                    members[new] = out
                    for j in out:
                        group[j] = new
        end = begin
    order = [-1] * n
    order[0] = n - 1
    front = list(range(n))
    done = bytearray(n)
    done[n - 1] = 1
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not done[j]:
            begin = group[j]
            order[front[begin]] = j
            front[begin] += 1
            done[j] = 1
            j = smaller[j]
    return order


def cut(text: bytes) -> list[bytes]:
    """Symbols that end with white space: none begins another, and where they end shows in any window."""
    return _SYMBOLS.findall(text)


def common(raw: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, at most ``most``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    step = np.arange(16)
    while len(live):
        at = out[live, None] + step
        same = raw[a[live, None] + at] == raw[b[live, None] + at]
        whole = same.all(1)
        out[live] += np.where(whole, 16, same.argmin(1))
        live = live[whole & (out[live] < most)]
    return np.minimum(out, most)


def repeated_starts(strings: list[bytes], owned: list[int], width: int) -> list[np.ndarray]:
    """For each string the starts below its ``owned`` number whose ``width`` bytes also start elsewhere.

    Elsewhere is another such start, of the same or of another string. The strings' suffixes at
    symbol starts are sorted. A window is named by its first symbol start strictly inside and the
    d bytes before it: it is repeated if another one of equal d has the same d bytes and a common
    prefix of width - d behind them, which is a run of the order without a smaller common prefix.
    """
    symbols = [cut(s) for s in strings]
    if max(map(len, chain.from_iterable(symbols)), default=0) > min(SYMBOL, width - 1):
        symbols = [[s[i : i + 1] for i in range(len(s))] for s in strings]
    rank = {x: k + 2 for k, x in enumerate(sorted(set(chain.from_iterable(symbols))))}
    text: list[int] = []
    for some in symbols:
        text += map(rank.__getitem__, some)
        text.append(1)
    text.append(0)
    lengths = np.fromiter(map(len, chain.from_iterable([*some, b"\0"] for some in symbols)), np.int64)
    raw = np.frombuffer(b"\0".join(strings) + b"\0" * (width + 32), np.uint8)
    at = np.concatenate(([0], np.cumsum(lengths)))  # where each symbol begins; the last one is past the end
    base = np.concatenate(([0], np.cumsum([len(s) + 1 for s in strings])))
    of = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in symbols])
    order = np.array(suffix_array(text))
    order = order[order < len(of)]  # without the end of all
    inner = np.concatenate(([False], of[1:] == of[:-1])) & (np.array(text[:-1]) != 1)
    before = np.concatenate(([0], lengths[:-1]))  # bytes of the symbol in front
    lcp = np.concatenate(([0], common(raw, at[order[1:]], at[order[:-1]], width)))
    found = np.zeros(int(base[-1]) + 1, bool)
    use = np.flatnonzero(inner[order])  # places in the order
    where = at[order[use]]
    string = of[order[use]]
    limit = base[string] + np.asarray(owned)[string]
    room = before[order[use]]
    same = np.zeros(len(use), np.int64)  # equal for equal bytes in front
    loose = np.cumsum(lcp < width - int(room.max(initial=1)))[use]
    live = np.arange(len(use))
    d = 0
    while len(live):
        d += 1
        live = live[room[live] >= d]
        if not len(live):
            break
        part, count = _classes(loose[live], same[live] * 256 + raw[where[live] - d])
        same[live] = part
        live = live[count[part] > 1]
        tight = np.cumsum(lcp < width - d)[use[live]]
        mine = where[live] - d < limit[live]
        some = live[mine]
        part, count = _classes(tight[mine], same[some])
        found[where[some[count[part] > 1]] - d] = True
    return [np.flatnonzero(found[a : a + n]) for a, n in zip(base[:-1].tolist(), owned, strict=True)]


def _classes(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each pair's class and how many pairs are in each class."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)]
    number = np.cumsum(new) - 1
    part = np.empty(len(a), np.int64)
    part[order] = number
    return part, np.bincount(number, minlength=1)
