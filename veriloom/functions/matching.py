"""The standard library's sequence matcher's similarity of two texts, in near-linear time.

difflib looks for every longest block by all pairs of equal rare characters, and again in what is left of either side: quadratic in the length of a text
that has many changes. Here runs of rare characters are numbered by doubling, and all blocks of one length are taken in one pass over a stretch.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter


def _levels(a: str, b: str) -> list[tuple[dict, dict]]:
    """For 1, 2, 4, 8 ... rare characters in a row: (place in a -> number, place in b -> number) of the runs that both texts have, until there is none.

    Rare are difflib's: characters of at most a hundredth of b, and one more; all of them where b is shorter than 200.
    """
    most = len(b) // 100 + 1 if len(b) >= 200 else len(b)
    rare = {c for c, n in Counter(b).items() if n <= most}.intersection(a)
    on_a, on_b = ({i: c for i, c in enumerate(s) if c in rare} for s in (a, b))
    out: list[tuple[dict, dict]] = []
    while on_a:
        out.append((on_a, on_b))
        n, ids = 1 << len(out) - 1, {}
        next_b = {j: ids.setdefault((g, on_b[j + n]), len(ids)) for j, g in on_b.items() if j + n in on_b}
        on_a = {i: ids[g, on_a[i + n]] for i, g in on_a.items() if i + n in on_a and (g, on_a[i + n]) in ids}
        common = set(on_a.values())
        on_b = {j: g for j, g in next_b.items() if g in common}
    return out


def _alike(a: str, i: int, b: str, j: int, most: int) -> int:
    """How many characters from a's place i on equal those from b's place j on, `most` at most: steps that double, then halve."""
    n, step = 0, 16
    while step:
        step = min(step, most - n)
        if step and a[i + n : i + n + step] == b[j + n : j + n + step]:
            n, step = n + step, step * 2
        else:
            step //= 2
    return n


def matched(a: str, b: str) -> int:
    """How many characters the blocks of difflib.SequenceMatcher(a=a, b=b) hold.

    A block is the longest run of rare characters that a stretch of a and one of b share, the first in a, of these the first in b, with equal characters
    around it; what is left of it, and right, is the next stretches. No run is longer than `most` in a stretch. The first of its longest runs leaves none
    of that length on the left, so that one pass from left to right takes them all. Without a rare character in common, only equal heads match.
    """
    if a == b:
        return len(a)
    levels = _levels(a, b)
    places = [(list(on_a), list(on_b)) for on_a, on_b in levels]
    back_a, back_b = a[::-1], b[::-1]

    def runs(side: int, n: int, low: int, high: int) -> list:
        """(place, run) of n characters within [low, high): the run is told by its first and its last 2^p characters."""
        p = n.bit_length() - 1
        ids, at, behind = levels[p][side], places[p][side], n - (1 << p)
        found = at[bisect_left(at, low) : bisect_right(at, high - n)]
        return [(i, (ids[i], ids[i + behind])) for i in found if i + behind in ids]

    def longest(low_a: int, high_a: int, low_b: int, high_b: int, most: int) -> int:
        def shared(n: int) -> bool:
            return not {g for _, g in runs(0, n, low_a, high_a)}.isdisjoint(g for _, g in runs(1, n, low_b, high_b))

        low, high = 0, 1
        while high <= most and shared(high):
            low, high = high, high * 2
        high = min(high, most + 1)
        while high - low > 1:
            n = (low + high) // 2
            low, high = (n, high) if shared(n) else (low, n)
        return low

    total, left = 0, [(0, len(a), 0, len(b), (1 << len(levels)) - 1)]
    while left:
        low_a, high_a, low_b, high_b, most = left.pop()
        if low_a == high_a or low_b == high_b:
            continue
        n = longest(low_a, high_a, low_b, high_b, most)
        if not n:
            total += _alike(a, low_a, b, low_b, min(high_a - low_a, high_b - low_b))
            continue
        where: dict = {}
        for j, g in runs(1, n, low_b, high_b):
            where.setdefault(g, []).append(j)
        for i, g in runs(0, n, low_a, high_a):
            js = where.get(g)
            if i < low_a or js is None or js[-1] < low_b:
                continue
            j = js[bisect_left(js, low_b)]
            before = _alike(back_a, len(a) - i, back_b, len(b) - j, min(i - low_a, j - low_b))
            size = n + _alike(a, i + n, b, j + n, min(high_a - i, high_b - j) - n)
            total += before + size
            left.append((low_a, i - before, low_b, j - before, n - 1))
            low_a, low_b = i + size, j + size
        left.append((low_a, high_a, low_b, high_b, n - 1))
    return total


def ratio(a: str, b: str) -> float:
    """difflib.SequenceMatcher(a=a, b=b).ratio()."""
    return 2.0 * matched(a, b) / (len(a) + len(b)) if a or b else 1.0
