"""Suffix arrays by bucket-pointer refinement."""

from __future__ import annotations

import numpy as np


def bucket_pointers(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array ordered by the first ``depth`` tokens, and the bucket pointer of each suffix.

    Suffixes begin in buckets of as many tokens as fit a machine word.  A bucket is refined by
    sorting its suffixes on the bucket pointers of the suffixes ``step`` tokens later; the pointers
    so updated tell twice as many tokens apart, and the next pass sorts on them.  Buckets of one
    suffix are final and no longer touched.  Equal pointers mean equal first ``depth`` tokens;
    tokens after the end count as 0, so keep token values above 0.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = max(1, int(tokens.max()).bit_length())
    h = max(1, min(depth, 63 // bits))
    padded = np.concatenate((tokens.astype(np.uint64), np.zeros(h, np.uint64)))
    gram = np.zeros(n, np.uint64)
    for j in range(h):
        gram = (gram << np.uint64(bits)) | padded[j : j + n]
    order = np.argsort(gram)
    ordered = gram[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    pointer = np.zeros(n + 1, np.int64)
    pointer[n] = -1
    pointer[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    live = np.flatnonzero(~(new & np.concatenate((new[1:], [True]))))
    while h < depth and len(live):
        step = min(h, depth - h)
        at = order[live]
        own, later = pointer[at], pointer[np.minimum(at + step, n)] + 1
        by = np.argsort((own << 32) | later)
        at, own, later = at[by], own[by], later[by]
        order[live] = at
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (later[1:] != later[:-1])))
        pointer[at] = live[new][np.cumsum(new) - 1]
        live = live[~(new & np.concatenate((new[1:], [True])))]
        h += step
    return order, pointer[:n]
