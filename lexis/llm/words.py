"""Words of whole texts as 64-bit hashes, found with array operations on UTF-8.

The hash is not a polynomial, which would have well-known collisions; two different
words share one with a probability of 2^-64, words of up to eight bytes never if their
lengths agree.

A word is a maximal run of ``0-9``, ``a-z`` (after lower-casing ``A-Z``) and
everything outside ASCII; in UTF-8 that is a property of single bytes.
"""

from __future__ import annotations

STEP = 1 << 20          # bytes hashed at once
LONG = 512              # bytes; longer words are hashed one by one
SEED = 20_021
FIRST, SECOND, THIRD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB   # odd


def byte_tables():
    """Is a byte part of a word?"""
    import numpy as np

    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x61:0x7B] = word[0x80:] = True
    return word


def _mixed(h):
    """A bijection of 64-bit integers without linear structure."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(SECOND)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(THIRD)
    return h ^ (h >> np.uint64(31))


def _hashes(raw, s, e):
    """Hash of ``raw[s:e]`` for each word: its length, then eight bytes after eight are mixed in.

    Words of up to eight bytes and of the same length have different hashes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    size = e - s
    h = _mixed(size.astype(np.uint64) * np.uint64(FIRST))
    long = size > LONG
    todo = np.flatnonzero(~long)
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    k = 0
    while len(todo):
        block = np.ascontiguousarray(eights[s[todo] + k]).view("<u8")[:, 0]
        left = np.minimum(size[todo] - k, 8)
        block = block & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - left).astype(np.uint64)))
        h[todo] = _mixed((h[todo] ^ block) * np.uint64(FIRST) + np.uint64(k + 1))
        k += 8
        todo = todo[size[todo] > k]
    for i in np.flatnonzero(long).tolist():
        h[i] = xxh64_intdigest(raw[s[i]:e[i]].tobytes(), SEED)
    return h


def word_hashes(data: bytes, word):
    """Hash of every word of ``data`` (UTF-8, lower-cased), in order."""
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    out = []
    a = 0
    while a < len(raw):
        b = min(len(raw), a + STEP)
        if b < len(raw):   # cut at a byte outside words
            back = np.flatnonzero(~word[raw[a:b]])
            if len(back):
                b = a + int(back[-1]) + 1
            else:          # a word of more than STEP bytes: up to its end
                while b < len(raw) and word[raw[b]]:
                    b += 1
        part = raw[a:b]
        edge = np.diff(np.concatenate(([False], word[part], [False])).astype(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(s):
            out.append(_hashes(part, s, e))
        a = b
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
