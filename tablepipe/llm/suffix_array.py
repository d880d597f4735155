"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

``suffix_array`` follows SA-IS: suffixes are classified as smaller or larger than
their right neighbour, the leftmost-smaller (LMS) substrings are sorted by one
induction, named, and, where names repeat, ordered by sorting the suffixes of the
reduced string of names; a second induction from the sorted LMS suffixes gives
the array. Each induction is one linear scan over the buckets; a bucket's items
are induced as whole arrays, items that fall into the bucket being scanned in a
further round. The reduced string has one symbol per name, too many for buckets,
so its suffixes are ranked by doubling their prefixes instead.

``permuted_lcp`` walks the text order: the common prefix with the suffix before
it in the array shrinks by one at most from a position to the next. Strings end
at separators, so all strings are walked at the same time.
"""

from __future__ import annotations

import numpy as np


def _types(text):
    """True where a suffix is smaller than its right neighbour (S); the last one is."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])  # i where text[i] != text[i + 1]
    small = np.ones(n, bool)
    if len(change):
        rises = text[change] < text[change + 1]
        nxt = np.searchsorted(change, np.arange(n - 1))  # the first change at or after i decides
        inside = nxt < len(change)
        small[:-1] = np.where(inside, rises[np.minimum(nxt, len(change) - 1)], False)
    else:
        small[:-1] = False
    return small


def _grouped(symbols, items, fill, sa, backward):
    """Append items to their buckets in order, at the heads or (backward) at the tails."""
    order = np.argsort(symbols, kind="stable")
    symbols, items = symbols[order], items[order]
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    sizes = np.diff(np.append(first, len(symbols)))
    rank = np.arange(len(symbols)) - np.repeat(first, sizes)
    at = fill[symbols] + (-1 - rank if backward else rank)
    sa[at] = items
    fill[symbols[first]] += -sizes if backward else sizes


def _induce(text, small, starts, lms):
    """Suffix array from LMS positions in (some) order within their buckets."""
    n, k = len(text), len(starts) - 1
    sa = np.full(n, -1, np.int64)
    tails = starts[1:].copy()
    _grouped(text[lms[::-1]], lms[::-1], tails, sa, True)
    heads = starts[:-1].copy()
    for c in range(k):  # larger suffixes, from the left
        lo = starts[c]
        done = lo
        while heads[c] > done:
            lo, done = done, heads[c]
            before = sa[lo:done] - 1
            before = before[before >= 0]
            before = before[~small[before]]
            if len(before):
                _grouped(text[before], before, heads, sa, False)
        before = sa[max(heads[c], tails[c]):starts[c + 1]] - 1
        before = before[before >= 0]
        before = before[~small[before]]
        if len(before):
            _grouped(text[before], before, heads, sa, False)
    tails = starts[1:].copy()
    for c in range(k - 1, -1, -1):  # smaller suffixes, from the right
        done = starts[c + 1]
        while tails[c] < done:
            hi, done = done, tails[c]
            before = sa[done:hi][::-1] - 1
            before = before[before >= 0]
            before = before[small[before]]
            if len(before):
                _grouped(text[before], before, tails, sa, True)
        before = sa[starts[c]:heads[c]][::-1] - 1
        before = before[before >= 0]
        before = before[small[before]]
        if len(before):
            _grouped(text[before], before, tails, sa, True)
    return sa


def _same(text, a, b, lengths):
    """Whether text[a:a + length] equals text[b:b + length], for arrays of places."""
    out, live = np.ones(len(a), bool), np.arange(len(a))
    step = 0
    while len(live):
        live = live[lengths[live] > step]
        equal = text[a[live] + step] == text[b[live] + step]
        out[live[~equal]] = False
        live = live[equal]
        step += 1
    return out


def _ranked(names):
    """Order of the suffixes of a string of names, by doubling."""
    rank = names.astype(np.int64)
    n, h = len(rank), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[:-h or None] = rank[h:] + 1 if h < n else 0
        key = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank[order] = new
        if new[-1] == n - 1 or h >= n:
            return order
        h *= 2


def suffix_array(text, symbols):
    """Suffix array of an integer array with symbols in range(symbols); a suffix
    that is a prefix of another comes first."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    text = np.append(text + 1, 0)  # a last symbol of its own
    small = _types(text)
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sa = _induce(text, small, starts, lms)
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]  # LMS substrings in order
    length = np.zeros(n + 1, np.int64)
    length[lms] = np.append(lms[1:], n) - lms + 1
    new = np.ones(len(order), bool)
    a, b = order[:-1], order[1:]
    alike = length[a] == length[b]
    where = np.flatnonzero(alike)
    alike[where] = _same(text, a[where], b[where], length[a[where]])
    new[1:] = ~alike
    name = np.zeros(n + 1, np.int64)
    name[order] = np.cumsum(new) - 1
    if not new.all():
        order = lms[_ranked(name[lms])]
    return _induce(text, small, starts, order)[1:]


def permuted_lcp(text, sa, first, last):
    """PLCP of the positions first[i] <= p < last[i] of separate strings: the common
    prefix of the suffix at p and the one before it in the array, cut at separators (symbol 0)."""
    phi = np.full(len(text), -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    plcp = np.zeros(len(text), np.int64)
    at, length = first.copy(), np.zeros(len(first), np.int64)
    live = np.flatnonzero(at < last)
    while len(live):
        p = at[live]
        other = phi[p]
        l = np.maximum(length[live] - 1, 0)  # noqa: E741
        grow = np.flatnonzero(other >= 0)
        l[other < 0] = 0
        while len(grow):
            x = text[p[grow] + l[grow]]
            grow = grow[(x != 0) & (x == text[other[grow] + l[grow]])]
            l[grow] += 1
        plcp[p] = l
        length[live] = l
        at[live] += 1
        live = live[at[live] < last[live]]
    return plcp
