"""Suffix array of one shard by induced sorting, and its permuted common prefixes (numpy).

The shard's symbols are bytes, so both inductions run bucket by bucket: everything a
bucket induces goes to its target buckets in one stable counting step. Runs inside a bucket are
followed wave by wave. The leftmost-smaller (LMS) substrings are sorted by the same induction
and named; the string of names is sorted by the same method, recursively, until the names are unique
or span ``depth`` symbols (its alphabet is large, so there the induction follows all runs at once). With ``depth`` given, suffixes that agree in at
least that many symbols may come in any order among themselves; that is all a search for
repeats of a fixed length needs.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 18


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor (S-type); the last symbol must be the unique smallest."""
    n = len(t)
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)  # last position of each run
    up = np.append(t[ends[:-1]] < t[ends[:-1] + 1], True)
    return np.repeat(up, np.diff(np.concatenate(([-1], ends))))


def _place(sa, pos, at, symbols, sign):
    """Put ``pos`` at the bucket pointers of their symbols, in order; ``sign`` is the direction the pointers move."""
    if not len(pos):
        return
    order = np.argsort(symbols, kind="stable")  # radix sort on bytes
    s = symbols[order]
    counts = np.bincount(s, minlength=256)
    rank = np.arange(len(s)) - np.repeat(np.cumsum(counts) - counts, counts)
    sa[at[s] + sign * rank] = pos[order]
    at += sign * counts


def induce(t: np.ndarray, stype: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the sorted ``lms`` positions induce."""
    n = len(t)
    starts = np.cumsum(sizes) - sizes
    sa = np.full(n, -1, dtype=lms.dtype)
    symbols = np.flatnonzero(sizes)
    lms_of = np.split(lms, np.cumsum(np.bincount(t[lms], minlength=256))[:-1])
    # larger suffixes, left to right
    head = starts.copy()
    for c in symbols.tolist():
        done = starts[c]
        fronts = []
        while done < head[c]:
            wave = sa[done:head[c]]
            done = head[c]
            fronts.append(wave)
            p = wave[wave > 0] - 1
            p = p[t[p] == c]  # the same symbol before a larger suffix: larger, too
            sa[head[c]:head[c] + len(p)] = p
            head[c] += len(p)
        p = np.concatenate([*fronts, lms_of[c]])
        p = p[p > 0] - 1
        s = t[p]
        up = s > c
        _place(sa, p[up], head, s[up], 1)
    # smaller suffixes, right to left
    tail = starts + sizes - 1
    for c in symbols[::-1].tolist():
        last = starts[c] + sizes[c] - 1
        done = last
        fronts = []
        while done > tail[c]:
            wave = sa[tail[c] + 1:done + 1][::-1]
            done = tail[c]
            fronts.append(wave)
            p = wave[wave > 0] - 1
            p = p[t[p] == c]
            sa[tail[c] - len(p) + 1:tail[c] + 1] = p[::-1]
            tail[c] -= len(p)
        if c == 0:
            break
        p = np.concatenate([*fronts, sa[starts[c]:head[c]][::-1]])
        p = p[p > 0] - 1
        s = t[p]
        down = s < c
        _place(sa, p[down], tail, s[down], -1)
    sa[0] = n - 1
    return sa


def _same_lms(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which pairs of LMS substrings (starts ``a`` and ``b``, equal ``length``) agree."""
    same = np.ones(len(a), dtype=bool)
    live = np.arange(len(a))
    k = 0
    while len(live):
        ok = t[a[live] + k] == t[b[live] + k]
        same[live[~ok]] = False
        live = live[ok & (length[live] > k + 1)]
        k += 1
    return same


def _refine(val: np.ndarray, live: np.ndarray, nxt: np.ndarray, stop: np.ndarray) -> None:
    """Order the positions ``live`` inside their classes ``val`` by what follows them, up to the next ``stop``.

    ``val`` counts the smaller positions, so a class that splits keeps its first number. Only ties go on, and their
    reach doubles in every round; a tie that has seen its stop is final.
    """
    while len(live):
        key = val[live] * len(val) + val[nxt[live]]
        order = np.argsort(key)
        live, key = live[order], key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        old = val[live]
        group = np.concatenate(([True], old[1:] != old[:-1]))
        i = np.arange(len(live))
        val[live] = old + np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(group, i, 0))
        tied = ~new | ~np.append(new[1:], True)
        live = live[tied & ~stop[nxt[live]]]
        nxt[live] = nxt[nxt[live]]


def _tied(val: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Those of the positions ``of`` whose class has other members."""
    return of[np.bincount(val[of], minlength=len(val))[val[of]] > 1]


def _induce_names(t: np.ndarray, stype: np.ndarray, lms: np.ndarray, rank: np.ndarray | None) -> np.ndarray:
    """Number of smaller suffixes of every suffix of a string of names, induced from the ``rank`` of its LMS suffixes.

    The alphabet is as large as the string, so no bucket is visited by itself: larger suffixes are ordered by their run
    down to the next LMS suffix, smaller ones by their run up to the next larger suffix. Without ``rank``
    the LMS suffixes count by their symbol only, which orders the LMS substrings (equal ones tie).
    """
    n = len(t)
    kind = 2 * t.astype(np.int64) + stype  # of one symbol, larger suffixes come before smaller ones
    sizes = np.bincount(kind)
    first = (np.cumsum(sizes) - sizes)[kind]
    following = np.minimum(np.arange(n) + 1, n - 1)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    val = first.copy()
    if rank is not None:
        order = lms[np.lexsort((rank, first[lms]))]
        r = np.zeros(n, dtype=np.int64)
        r[lms] = rank
        i = np.arange(len(order))
        group = np.concatenate(([True], first[order][1:] != first[order][:-1]))
        new = group | np.concatenate(([True], r[order][1:] != r[order][:-1]))
        val[order] += np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(group, i, 0))
    _refine(val, _tied(val, np.flatnonzero(~stype)), following.copy(), is_lms)
    val[stype] = first[stype]
    _refine(val, _tied(val, np.flatnonzero(stype)), following, ~stype)
    return val


def _rank_names(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Ranks of the suffixes of a string of names (the last one the unique smallest), by the same method again:
    its LMS substrings are sorted and named, the string of their names is ranked in turn, and all else is induced.
    """
    if names.max() == len(names) - 1 or (depth is not None and depth <= 1):
        return names
    stype = classify(names)
    lms = np.flatnonzero(stype[1:] & ~stype[:-1]) + 1
    again = np.unique(_induce_names(names, stype, lms, None)[lms], return_inverse=True)[1].reshape(-1)
    return _induce_names(names, stype, lms, _rank_names(again, None if depth is None else (depth + 1) // 2 + 1))


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of bytes ``t`` whose last symbol is 0 and occurs only there."""
    n = len(t)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    sizes = np.bincount(t, minlength=256)
    stype = classify(t)
    lms = (np.flatnonzero(stype[1:] & ~stype[:-1]) + 1).astype(np.int32 if n < 1 << 31 else np.int64)
    if len(lms) > 1:
        first = induce(t, stype, lms[np.argsort(t[lms], kind="stable")], sizes)
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        order = first[is_lms[first]]  # LMS positions by their substrings
        length = np.zeros(n, dtype=lms.dtype)
        length[lms[:-1]] = np.diff(lms) + 1
        length[lms[-1]] = 1
        a, b = order[:-1], order[1:]
        new = length[a] != length[b]
        new[~new] = ~_same_lms(t, a[~new], b[~new], length[a[~new]])
        del first, length, is_lms
        name = np.zeros(n, dtype=lms.dtype)
        name[order] = np.concatenate(([0], np.cumsum(new)))
        # an LMS substring moves on by at least two symbols
        rank = _rank_names(name[lms], None if depth is None else (depth + 1) // 2 + 1)
        lms = lms[np.argsort(rank, kind="stable")]
    return induce(t, stype, lms, sizes)


def common_prefixes(t: np.ndarray, sa: np.ndarray, limit: int, restart: np.ndarray | None = None) -> np.ndarray:
    """``plcp[i]``: symbols that suffix ``i`` shares with the suffix before it in ``sa`` (compared up to ``limit``).

    Only irreducible entries are compared, eight symbols at a time; an entry whose
    neighbour's neighbour extends the same pair to the left is one less than the entry
    before it. ``restart`` marks positions that are compared anyway.
    """
    n, kind = len(t), sa.dtype
    phi = np.full(n, -1, dtype=kind)
    phi[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, dtype=bool)
    follows = np.flatnonzero((phi[1:] > 0) & (phi[1:] == phi[:-1] + 1)) + 1
    reducible[follows] = t[follows - 1] == t[phi[follows] - 1]
    if restart is not None:
        reducible[restart] = False
    wide = np.lib.stride_tricks.sliding_window_view(np.concatenate((t, np.zeros(8, dtype=np.uint8))), 8)
    plcp = np.zeros(n, dtype=kind)
    fresh = np.flatnonzero(~reducible & (phi >= 0)).astype(kind)
    for part in np.array_split(fresh, len(fresh) // _CHUNK + 1):  # bounded working memory
        plcp[part] = _compare(wide, part, phi[part], n, limit)
    at = np.where(reducible, kind.type(0), np.arange(n, dtype=kind))
    lead = np.maximum.accumulate(at)
    return plcp[lead] - (np.arange(n, dtype=kind) - lead)


def _compare(wide: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, limit: int) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share, eight at a time, up to about ``limit``."""
    out = np.zeros(len(a), dtype=a.dtype)
    live = np.arange(len(a))
    k = 0
    while len(live) and k < limit:
        live = live[np.maximum(a[live], b[live]) + k < n]
        x = _load(wide, a[live] + k) ^ _load(wide, b[live] + k)
        differs = x != 0
        low = x[differs]
        out[live[differs]] = k + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) >> 3)
        live = live[~differs]
        out[live] = k + 8
        k += 8
    return out


def _load(wide: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one little-endian number."""
    return np.ascontiguousarray(wide[at]).view("<u8").ravel()
