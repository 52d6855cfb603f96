"""Shingle sets and SuperMinHash signatures, in numpy over a slice of documents."""

from __future__ import annotations

import numpy as np
import xxhash

#: Fixed mixing constants of the splitmix64 generator.
GAMMA, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_word_hash = xxhash.xxh3_64_intdigest


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S30)) * MIX_A
        x = (x ^ (x >> _S27)) * MIX_B
    return x ^ (x >> _S31)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word; words are runs without bytes 0x20 and 0x09-0x0D."""
    words = data.split()
    return np.fromiter(map(_word_hash, words), np.uint64, len(words))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles, A-Z lower-cased.

    Fewer words than `width` make one shingle of them all; no words, none.
    """
    h = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    n = len(h)
    if n == 0:
        return h
    k = min(width, n)
    acc = np.full(n - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            acc = mix(acc * GAMMA + h[i : n - k + 1 + i])
    return np.unique(acc)


def super_min_hash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, one row of m float64 a set; rows of empty sets are inf.

    An element's generator draws r_0, k_0, r_1, k_1, ...; step j swaps places j and k_j (from
    j..m-1) of its permutation and offers r_j + j to register p_j. Steps go level by level over
    all elements; a set leaves once no register is empty, as later offers are larger than any
    kept value. A whole permutation is never stored: p_j is found by walking the swaps back.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    sig = np.full((len(sets), m), np.inf)
    flat = sig.reshape(-1)
    live = np.flatnonzero(sizes)
    if not len(live):
        return sig
    elements = np.concatenate([sets[i] for i in live])
    owner = np.repeat(live, sizes[live])
    swaps: list[np.ndarray] = []
    for j in range(m):
        with np.errstate(over="ignore"):
            draw = mix(elements + GAMMA * np.uint64(2 * j + 1))
            pick = mix(elements + GAMMA * np.uint64(2 * j + 2))
        r = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        k = (j + ((pick >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)).astype(np.int16)
        place = k.copy()
        for i in range(j - 1, -1, -1):
            place[place == swaps[i]] = i
        np.minimum.at(flat, owner * m + place, r + j)
        open_sets = np.isinf(sig).any(axis=1)
        keep = open_sets[owner]
        if not keep.any():
            break
        elements, owner = elements[keep], owner[keep]
        swaps = [s[keep] for s in (*swaps, k)]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a band and signature; the band's number is part of the key."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    with np.errstate(over="ignore"):
        for i in range(rows):
            acc = mix(acc * GAMMA + bits[:, :, i])
    return acc.view(np.int64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """A digest of a set: two signed longs, 128 bits."""
    high, low = divmod(xxhash.xxh3_128_intdigest(shingles.tobytes()), 1 << 64)
    return high - (1 << 63), low - (1 << 63)
