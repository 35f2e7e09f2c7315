"""Numpy kernels over bytes: rolling hashes, window minima, bucket-pointer refinement."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
#: A random odd-looking value for each byte, an odd base and its inverse modulo 2**64.
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64."""
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(pow(base, k, 2**64))
        k += m
    return out


CHUNK = 1 << 17
_MARGIN = 512
_POW, _INV = powers(BASE, CHUNK + _MARGIN), powers(_INVERSE, CHUNK + _MARGIN)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads all bits."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Content-chosen anchors of all windows of length bytes that lie inside one document.

    data: the bytes of consecutive documents, ends: where each ends. Every window [s, s + length) picks the
    gram of the smallest hash in it, the last of equals: a choice of its content alone. Returns, for
    each run of windows with one pick: its place, first and last window start, the gram's hash, and a hash of
    all bytes under those windows together with the place of the pick among them.
    """
    n, wide = len(data), length - gram + 1
    low = np.uint64((1 << 18) - 1)  # under the hash, room for a place in the chunk
    found: list[tuple[np.ndarray, ...]] = []
    for c0 in range(0, max(0, n - length + 1), CHUNK):
        c1 = min(n, c0 + CHUNK + length - 1)
        m = c1 - c0
        p = np.zeros(m + 1, np.uint64)
        np.cumsum(BYTE[data[c0:c1]] * _POW[:m], out=p[1:])
        g = mix((p[gram:] - p[:-gram]) * _INV[: m + 1 - gram])
        key = (g & ~low) | (low - np.arange(len(g), dtype=np.uint64))
        k, best = 1, key
        while 2 * k <= wide:
            best, k = np.minimum(best[:-k], best[k:]), 2 * k
        if wide > k:
            best = np.minimum(best[: len(best) - (wide - k)], best[wide - k :])
        pick = (low - (best & low)).astype(np.int64)
        s = np.arange(len(pick))
        # Drop the windows that cross the end of a document.
        inside = ends[(ends > c0) & (ends < c1)] - c0
        if len(inside):
            ok = np.ones(len(pick) + 1, np.int32)
            step = np.zeros(len(pick) + 1, np.int32)
            np.add.at(step, np.clip(inside - length + 1, 0, len(pick)), 1)
            np.add.at(step, np.clip(inside, 0, len(pick)), -1)
            ok = np.cumsum(step)[:-1] == 0
            s, pick = s[ok], pick[ok]
        if not len(s):
            continue
        new = np.flatnonzero(np.concatenate([[True], (pick[1:] != pick[:-1]) | (s[1:] != s[:-1] + 1)]))
        first, last = s[new], s[np.concatenate([new[1:], [len(s)]]) - 1]
        at = pick[new]
        place = mix(((at - first) * 256 + (last - first)).astype(np.uint64) + np.uint64(7))
        around = mix((p[last + length] - p[first]) * _INV[first] ^ place)
        found.append((at + c0, first + c0, last + c0, mix(g[at] + np.uint64(0x51)), around))
    if not found:
        return (*(np.zeros(0, np.int64) for _ in range(3)), *(np.zeros(0, np.uint64) for _ in range(2)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def window_hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the length bytes from each start."""
    out, step = np.empty(len(starts), np.uint64), 1 << 15
    within, worth = np.arange(length), _POW[:length]
    for lo in range(0, len(starts), step):
        out[lo : lo + step] = (BYTE[data[starts[lo : lo + step, None] + within]] * worth).sum(1, dtype=np.uint64)
    return mix(out)


#: Suffixes that one sort of the refinement takes; a larger bucket is sorted alone.
SORTED = 1 << 16


def refine(text: np.ndarray, length: int, gram: int = 7) -> np.ndarray:
    """Class ids of all suffixes by their first length bytes: equal ids exactly where those bytes are equal.

    Bucket-pointer refinement. Suffixes start in the buckets of their first gram bytes, in order; every suffix points to
    its bucket (the place of the bucket's last member). Buckets are taken from a stack, whole ones up to SORTED suffixes a
    time: a bucket whose members agree in d bytes is sorted by the pointers of the suffixes d later, and its parts get
    their own pointers at once. What is sorted next, the parts first, reads those: a part agrees in d bytes and in as many
    more as the bucket it pointed to does, so refined pointers let later sorts skip ahead. Buckets of one
    member, and those that agree in length bytes, are final.

    Pointers refined beyond length may part suffixes that agree in length bytes, but keep them side by side; so, last,
    neighbours in the order found are compared byte by byte. Suffixes shorter than length are equal to none.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # Nine bits a byte, 0 beyond the end: a suffix that ends comes before one that goes on.
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(gram, np.uint64)])
    word = np.zeros(n + length, np.uint64)
    for k in range(gram):
        word[:n] = (word[:n] << np.uint64(9)) | padded[k : k + n]
    place = np.int32 if n + length < 2**31 else np.int64
    order = np.argsort(word[:n]).astype(place)
    # Beyond the end every suffix points before all buckets and counts as long enough.
    pointer, depth = np.full(n + length, -1, place), np.full(n + length, length, np.uint8)
    depth[:n] = min(gram, length)

    def point(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Pointers of the suffixes at places by runs of equal keys; which runs have several members."""
        last = np.flatnonzero(np.concatenate([keys[1:] != keys[:-1], [True]]))
        size = np.diff(np.concatenate([[-1], last]))
        pointer[order[places]] = np.repeat(places[last], size)
        return np.repeat(size > 1, size)

    every = np.arange(n, dtype=place)
    several = point(every, word[order])
    stack = [every[several]] if gram < length else []
    del every, several
    while stack:
        at = stack.pop()
        if len(at) > SORTED:  # whole buckets only: cut where the bucket of the SORTED-th ends
            cut = int(np.searchsorted(at, pointer[order[at[SORTED - 1]]], side="right"))
            if cut < len(at):
                stack.append(at[cut:])
                at = at[:cut]
        if not len(at):
            continue
        s = order[at]
        later = s + depth[s]
        by = (pointer[s].astype(np.int64) << 32) | (pointer[later] + 1)
        now = np.argsort(by)
        order[at] = s = s[now]
        later = later[now]
        agreed = np.minimum(length, later - s + depth[later])
        several = point(at, by[now])
        depth[s] = agreed
        live = at[several & (agreed < length)]
        if len(live):
            stack.append(live)
    a, b = order[:-1], order[1:]
    same = (a <= n - length) & (b <= n - length)
    for k in [*range(0, length - gram, gram), max(0, length - gram)]:
        at = np.flatnonzero(same)
        same[at] = word[a[at] + k] == word[b[at] + k]
    ids = np.empty(n, place)
    ids[order] = np.concatenate([[0], np.cumsum(~same)])
    return ids
