"""Suffix arrays by the difference cover modulo 3, on numpy arrays."""

from __future__ import annotations

import numpy as np

_FIELD = 21


def _names(t: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank (from 1) of the triple at each position among the distinct triples, and their number."""
    if int(t.max(initial=0)) < 1 << _FIELD:
        key = t[at] << 2 * _FIELD | t[at + 1] << _FIELD | t[at + 2]
        distinct, name = np.unique(key, return_inverse=True)
        return name.ravel().astype(np.int64) + 1, len(distinct)
    order = np.lexsort((t[at + 2], t[at + 1], t[at]))
    sorted_at = at[order]
    new = np.ones(len(at), bool)
    new[1:] = np.any([t[sorted_at[1:] + d] != t[sorted_at[:-1] + d] for d in range(3)], axis=0)
    name = np.empty(len(at), np.int64)
    name[order] = np.cumsum(new)
    return name, int(new.sum())


def _keys(chars: list[tuple[np.ndarray, np.ndarray]], ranks: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One number for each of two lists of (characters, rank), in the order of those."""
    one, two = np.zeros(len(ranks[0]), np.int64), np.zeros(len(ranks[1]), np.int64)
    bits = 0
    for a, b in [*chars, ranks]:
        width = int(max(a.max(initial=0), b.max(initial=0))).bit_length()
        bits += width
        if bits > 62:  # number the values so far anew
            distinct = np.unique(np.concatenate([one, two]))
            one, two = np.searchsorted(distinct, one), np.searchsorted(distinct, two)
            if width > 40:
                values = np.unique(np.concatenate([a, b]))
                a, b = np.searchsorted(values, a), np.searchsorted(values, b)
                width = len(values).bit_length()
            bits = len(distinct).bit_length() + width
        one, two = one << width | a, two << width | b
    return one, two


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (whole numbers >= 1) in order.

    Triples at positions 1 and 2 modulo 3 are sorted and named; the suffixes of the string of names give the order
    of the sampled suffixes, which settles that of the others and the merge of both.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    one = np.arange(1, n + (n % 3 == 1), 3)
    two = np.arange(2, n, 3)
    at = np.concatenate([one, two])
    name, distinct = _names(t, at)
    order = suffix_array(name) if distinct < len(at) else np.argsort(name)
    rank = np.zeros(n + 3, np.int64)
    rank[at[order]] = np.arange(1, len(at) + 1)
    sampled = at[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((rank[rest + 1], t[rest]))]
    places = np.arange(len(rest))
    for step in (1, 2):  # a suffix of the rest goes after the sampled ones that are less: compare up to the next sampled position
        own = sampled[sampled % 3 == step]
        places += np.searchsorted(*_keys([x for d in range(step) for x in ((t[own + d], t[rest + d]),)], (rank[own + step], rank[rest + step])))
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    taken[places] = True
    out[places] = rest
    out[~taken] = sampled
    return out
