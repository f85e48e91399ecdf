"""Words and their hashes for a batch of texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Hashes are the same on every machine: tables come from fixed seeds.
_TABLE = np.random.Generator(np.random.PCG64(20240917)).integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20  # bytes worked on at a time, to stay in the processor's cache


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ np.uint64(seed)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


# Bytes that words are made of; in UTF-8 all bytes of a character beyond ASCII are above 127.
WORDS = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
TERMS = np.array([c > 127 or chr(c).isalnum() for c in range(256)])


def word_hashes(texts: Sequence[str | None], lower: bool = False, made_of: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and where each text begins and ends in them.

    Words are runs of characters other than the six ASCII spaces, or of the
    bytes in ``made_of``, which has no line break. ``lower`` takes A to Z in
    lower case. Null counts as empty.
    """
    raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    hashes, counts, at = [], np.zeros(len(raw), np.int64), 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (size < _PIECE or end == at):
            size += len(raw[end]) + 1
            end += 1
        h, starts = _hash_piece(b"\n".join(raw[at:end]) + b"\n", lower, made_of)
        begins = np.cumsum([0] + [len(x) + 1 for x in raw[at : end - 1]])
        counts[at:end] = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
        hashes.append(h)
        at = end
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), bounds


def _hash_piece(joined: bytes, lower: bool, made_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(joined, np.uint8)
    inside = made_of[b]
    edge = np.flatnonzero(np.diff(inside, prepend=False))  # the last byte is a space, so edges pair up
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    if lower:
        b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
    sizes = ends - starts
    chars = b[inside]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(len(chars)) - np.repeat(first, sizes)
    terms = _TABLE[chars] * powers(int(_STEP) | 1, int(sizes.max()))[place]
    return mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64)), starts


def window_hashes(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """One hash for each run of ``n`` consecutive words, by where the run starts.

    Runs of a stream of several texts also cross texts; callers leave those out.
    """
    if len(h) < n:
        return np.zeros(0, np.uint64)
    step = int(mix(np.array([seed + 1], np.uint64))[0]) | 1
    back = pow(step, -1, 1 << 64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h, seed) * powers(step, len(h)), dtype=np.uint64)])
    return mix((total[n:] - total[:-n]) * powers(back, len(h) - n + 1), seed)
