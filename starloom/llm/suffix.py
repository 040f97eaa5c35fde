"""Suffix arrays by induced sorting, on numpy arrays.

Suffixes are classed as smaller (S) or larger (L) than their right neighbour;
the leftmost S of each stretch are sorted by their substrings, recursively where
names repeat, and all others follow by induction: buckets of the first symbol
are walked once upwards for L and once downwards for S, each bucket as a whole.
"""

from __future__ import annotations

import numpy as np

# Recursion walks buckets while there are few of them; a reduced text with more
# names than this has short buckets, and its ranks are doubled instead.
MOST_BUCKETS = 300


def smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the text ends in a unique smallest symbol."""
    n = len(t)
    out = np.ones(n, bool)
    if n > 1:
        # a run of one symbol has the class of its end; the last symbol differs from its neighbour
        at = np.where(t[:-1] != t[1:], np.arange(n - 1), n)
        nxt = np.minimum.accumulate(at[::-1])[::-1]
        out[:-1] = t[nxt] < t[nxt + 1]
    return out


def send(block: np.ndarray, t: np.ndarray, is_s: np.ndarray, want: bool, lists: list[list[np.ndarray]]) -> None:
    """Put the left neighbours of a block's suffixes that have the wanted class at the ends of their buckets, in order."""
    j = block[block > 0] - 1
    j = j[is_s[j] == want]
    if not len(j):
        return
    c = t[j]
    order = np.argsort(c, kind="stable")
    j, c = j[order], c[order]
    cuts = [0, *((c[1:] != c[:-1]).nonzero()[0] + 1).tolist(), len(j)]
    for a, b in zip(cuts, cuts[1:]):
        lists[int(c[a])].append(j[a:b])


def induce(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """Order of all suffixes that follows from the order of the leftmost S suffixes."""
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    send(lms + 1, t, np.ones(len(t) + 1, bool), True, seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    for c in range(symbols):
        # the list may grow while it is walked: runs of one symbol
        for block in larger[c]:
            send(block, t, is_s, False, larger)
        for block in seeds[c]:
            send(block, t, is_s, False, larger)
    up = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in larger]
    less: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    for c in range(symbols - 1, -1, -1):
        for block in less[c]:
            send(block, t, is_s, True, less)
        send(up[c][::-1], t, is_s, True, less)
    out = [np.array([len(t) - 1])]
    for c in range(symbols):
        out.append(up[c])
        out.append(np.concatenate(less[c])[::-1] if less[c] else np.zeros(0, np.int64))
    return np.concatenate(out)


def names_of(t: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of the leftmost-S substrings in text order; equal substrings have equal names."""
    ends = np.concatenate([lms[1:], lms[-1:]])
    length = np.zeros(len(t), np.int64)
    length[lms] = ends - lms
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live, d = np.flatnonzero(same), 0
    while len(live):
        x, y = a[live], b[live]
        differs = t[x + d] != t[y + d]
        same[live[differs]] = False
        live = live[~differs & (length[x] > d)]
        d += 1
    names = np.zeros(len(t), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    return names[lms]


def doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a reduced text by at least its first ``depth`` symbols, by doubling of ranks.

    Only suffixes whose rank is still shared are sorted again.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank, k = np.zeros(n, np.int64), 1
    new = np.concatenate([[True], names[order][1:] != names[order][:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while k < depth:
        size = np.bincount(rank, minlength=n)
        at = np.flatnonzero(size[rank[order]] > 1)
        if not len(at):
            break
        sub = order[at]
        second = np.where(sub + k < n, rank[np.minimum(sub + k, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[sub]))
        sub, second = sub[by], second[by]
        order[at] = sub
        first = rank[sub]
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank[sub] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        k *= 2
    return order


def suffix_array(t: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Suffixes of ``t`` in the order of at least their first ``depth`` symbols (ties beyond are in no special order).

    ``t`` holds numbers below ``symbols`` and ends in a 0 that occurs nowhere else.
    """
    is_s = smaller(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) <= 1:
        return induce(t, is_s, lms, symbols)
    mark = np.zeros(len(t), bool)
    mark[lms] = True
    order = induce(t, is_s, lms, symbols)
    names = names_of(t, order[mark[order]], lms)
    count = int(names.max()) + 1
    if count == len(lms):
        sorted_lms = np.empty(len(lms), np.int64)
        sorted_lms[names] = lms
    elif count <= MOST_BUCKETS:
        # the last name is that of the closing 0: unique and smallest
        sorted_lms = lms[suffix_array(names.astype(t.dtype) if count < 1 << 15 else names, count, depth)]
    else:
        # two leftmost S are at least two symbols apart
        sorted_lms = lms[doubled(names, depth // 2 + 1)]
    return induce(t, is_s, sorted_lms, symbols)


def permuted_lcp(t: np.ndarray, array: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix, in text order, with the one before it in the array, up to ``room`` symbols.

    ``room`` counts the symbols to the end of the suffix's own string.  Where the
    symbols before both suffixes agree, the value is one less than that of the
    suffix to the left; only the others are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    left = np.maximum(before, 1) - 1
    follows = (before > 0) & (t[left] == t[np.maximum(np.arange(n), 1) - 1])
    follows[0] = False
    follows[1:] &= room[:-1] == room[1:] + 1
    # what follows a suffix must also lie one further in the array's neighbour
    follows[1:] &= before[:-1] == before[1:] - 1
    start = np.flatnonzero(~follows)
    padded = np.concatenate([t.astype(np.uint64), np.zeros(4, np.uint64)])
    four = (padded[:-3] << np.uint64(48)) | (padded[1:-2] << np.uint64(32)) | (padded[2:-1] << np.uint64(16)) | padded[3:]
    value = np.zeros(len(start), np.int64)
    live = np.flatnonzero(before[start] >= 0)
    while len(live):
        i = start[live]
        d = value[live]
        x, y = i + d, before[i] + d
        inside = (x < n) & (y < n) & (d < room[i])
        differ = four[np.minimum(x, n - 1)] ^ four[np.minimum(y, n - 1)]
        agree = np.where(differ == 0, 4, np.where(differ < 1 << 16, 3, np.where(differ < 1 << 32, 2, np.where(differ < 1 << 48, 1, 0))))
        value[live] = np.where(inside, d + agree, d)
        live = live[inside & (agree == 4)]
    at = np.maximum.accumulate(np.where(~follows, np.arange(n), 0))
    where = np.cumsum(~follows) - 1
    return np.clip(value[where] - (np.arange(n) - at), 0, room)
