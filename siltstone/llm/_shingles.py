"""Numpy kernels for sets of word shingles."""

from __future__ import annotations

import numpy as np

from siltstone.llm._bytes import BASE, BYTE, mix, powers

WORDS = 5
#: Hash bits of a shingle; the rest of a 64-bit key holds the document's place in a batch.
BITS, MAX_DOCS, MAX_BYTES = 54, 1 << 10, 1 << 20
_PLACES = 1 << 12
_POWER = powers(BASE, _PLACES)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = [np.uint64(pow(BASE, 3 + 2 * k, 2**64)) for k in range(WORDS)]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word: runs of anything but space and U+0009..U+000D, A-Z lower-cased."""
    space = _SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64), start
    size = end - start
    inside = np.flatnonzero(~space)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(size) - size, size)
    value = BYTE[_LOWER[data[inside]]]
    long = place >= _PLACES
    if long.any():  # very long words: the byte's worth also depends on how often the powers have started anew
        value = np.where(long, mix(value + (place >> 12).astype(np.uint64)), value)
    value *= _POWER[place & (_PLACES - 1)]
    return mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64)), start


def _pieces(raw: bytes) -> list[bytes]:
    """A text in parts of about MAX_BYTES that no word crosses."""
    out, lo = [], 0
    while len(raw) - lo > MAX_BYTES:
        hi = lo + MAX_BYTES
        while hi < len(raw) and not _SPACE[raw[hi]]:
            hi += 1
        out.append(raw[lo:hi])
        lo = hi
    return [*out, raw[lo:]]


def shingle_sets(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes (BITS bits) of all texts in a row, and how many each has.

    At most MAX_DOCS texts. Fewer words than a shingle has: the whole sequence is one; no words: none.
    """
    hashes, counts = [], []
    for text in raw:
        if len(text) > MAX_BYTES:
            parts = [word_hashes(np.frombuffer(p, np.uint8))[0] for p in _pieces(text)]
            hashes.append(np.concatenate(parts))
            counts.append(np.array([len(hashes[-1])]))
    # The others in one sweep, kept apart by line ends.
    small = [t for t in raw if len(t) <= MAX_BYTES]
    joined = np.frombuffer(b"\n".join(small), np.uint8)
    h, start = word_hashes(joined)
    ends = np.cumsum([len(t) + 1 for t in small])
    per = np.bincount(np.searchsorted(ends, start, side="right"), minlength=len(small)) if len(small) else np.zeros(0, np.int64)
    if len(small) == len(raw):
        words, n = h, per
    else:
        at, big, cut = np.concatenate([[0], np.cumsum(per)]), iter(hashes), 0
        order, n = [], []
        for t in raw:
            if len(t) > MAX_BYTES:
                order.append(next(big))
            else:
                order.append(h[at[cut] : at[cut + 1]])
                cut += 1
            n.append(len(order[-1]))
        words, n = np.concatenate(order), np.array(n)
    return _sets(words, np.asarray(n, np.int64))


def _sets(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.repeat(np.arange(len(n)), n)
    first = np.repeat(np.cumsum(n) - n, n)
    place = np.arange(len(words)) - first
    total = words * _STEP[0]
    for k in range(1, WORDS):
        total[:-k] += words[k:] * _STEP[k]
    whole = place + WORDS <= n[doc]
    keys = [mix(total[whole])]
    docs = [doc[whole]]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        at = (np.cumsum(n) - n)[short]
        s = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            has = n[short] > k
            s[has] += words[at[has] + k] * _STEP[k]
        keys.append(mix(s + mix(n[short].astype(np.uint64))))
        docs.append(short)
    key = (np.concatenate(docs).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(keys) >> np.uint64(64 - BITS))
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key & np.uint64((1 << BITS) - 1), np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=len(n))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())
