"""SuperMinHash signatures of word shingles, their bands, and exact comparison of shingle sets (all on numpy arrays).

A SuperMinHash gives each element one random permutation of the registers, and to the j-th register in it a random value
in [j, j + 1): the ranks of an element are correlated over the registers, which lowers the variance of the share of equal
registers below that of independent hashes. Elements are worked on side by side, one rank after the other; when all
registers are below j, no later rank can change one, and the rest is left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from salescope.llm.common import ship

ship(__name__)

# Odd constants of 64-bit mixing functions.
_GOLDEN, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31, _S32 = np.uint64(30), np.uint64(27), np.uint64(31), np.uint64(32)
# A-Z in lower case.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Elements whose permutations are held at a time.
CHUNK = 8192


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


def shingle_set(text: str | None, length: int) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``length`` lower-cased words; of all words, where there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    length = min(length, len(words))
    runs = np.full(len(words) - length + 1, length, np.uint64)
    for i in range(length):
        runs = mixed(runs * _GOLDEN + hashes[i:len(hashes) - length + 1 + i])
    return np.unique(runs)


def signature(elements: np.ndarray, registers: int) -> np.ndarray:
    """The SuperMinHash of a set of 64-bit numbers."""
    values = np.full(registers, np.inf)
    for start in range(0, len(elements), CHUNK):
        part = elements[start:start + CHUNK]
        order = first = None
        row = np.arange(len(part))
        for j in range(registers):
            if values.max() <= j:
                break
            bits = mixed(part + np.array([j + 1], np.uint64) * _GOLDEN)
            rank = (bits >> _S32).astype(np.float64) / 4294967296.0 + j
            place = j + ((bits & np.uint64(0xFFFFFFFF)) % np.uint64(registers - j)).astype(np.int64)
            # The first rank needs no permutation yet, and for most chunks there is no second one.
            if j == 0:
                register = first = place
            else:
                if order is None:
                    order = np.tile(np.arange(registers, dtype=np.int16), (len(part), 1))
                    order[row, first], order[:, 0] = 0, first
                register = order[row, place].astype(np.int64)
                order[row, place], order[:, j] = order[:, j], register
            np.minimum.at(values, register, rank)
    return values


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit number for each run of ``rows`` registers; the number of the band goes into it."""
    bits = values.view(np.uint64).reshape(-1, rows)
    done = np.arange(1, len(bits) + 1, dtype=np.uint64)
    for i in range(rows):
        done = mixed(done * _GOLDEN + bits[:, i])
    return done.view(np.int64)


def fingerprint(values: np.ndarray) -> bytes:
    """One byte for each register: equal registers agree, others in one of 256 cases."""
    return (mixed(values.view(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes()


def band_rows(percent: int, missed: float = 1e-6, most: int = 168) -> tuple[int, int]:
    """(rows, bands): the most rows a band for which sets just similar enough share no band with probability ``missed``."""
    for rows in range(10, 0, -1):
        count = int(np.ceil(np.log(missed) / np.log1p(-((percent / 100) ** rows))))
        if rows * count <= most:
            return rows, count
    raise ValueError(f"no bands for a similarity of {percent} percent")


def set_key(elements: np.ndarray) -> bytes:
    """Equal for equal sets."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
