"""Words of whole batches of texts as hash arrays. A word is a run of bytes other than space and
0x09 to 0x0D; none of these bytes occurs inside a multi-byte character."""

from __future__ import annotations

import hashlib

import numpy as np

# Stretches are hashed as polynomials over the prime field of 2^61 - 1, at one seeded point. Different
# texts that do not depend on the seed collide with a chance of their length in 2^61; modulo a power
# of two, texts that collide at every point can be written down.
SEED = b"merchlake"
_MODULUS = (1 << 61) - 1
_POINT = int.from_bytes(hashlib.blake2b(SEED, digest_size=8).digest(), "little") % _MODULUS
_PRIME = np.uint64(_MODULUS)
_HALF = np.uint64((1 << 31) - 1)
_PIECE = 1 << 13
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
# Every ASCII character but letters and digits, for models of words without their punctuation.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """The remainders of any 64-bit numbers."""
    high = x >> np.uint64(61)
    high += x & _PRIME
    # What is not below the prime wraps around when it is taken away, and the smaller one is meant.
    return np.minimum(high, high - _PRIME, out=high)


def _joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Remainders of high * 2^31 + low, for parts below 2^63; 2^61 leaves 1."""
    x = (high & np.uint64((1 << 30) - 1)) << np.uint64(31)
    x += high >> np.uint64(30)
    x += low
    return _reduced(x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of remainders, from halves of 31 bits whose products fit 64 bits."""
    a_high, a_low = a >> np.uint64(31), a & _HALF
    b_high, b_low = b >> np.uint64(31), b & _HALF
    middle = a_high * b_low
    middle += a_low * b_high
    a_high *= b_high
    a_high += a_high  # 2^62 leaves 2
    a_low *= b_low
    a_high += a_low
    a_high += middle >> np.uint64(30)
    a_high += (middle & np.uint64((1 << 30) - 1)) << np.uint64(31)
    return _reduced(a_high)


def _table(kind: str, size: int) -> np.ndarray:
    """Powers of the point, or of its inverse, kept between calls up to a bounded length."""
    have = _powers.get(kind)
    if have is None or len(have) < size:
        step = _POINT if kind == "up" else pow(_POINT, -1, _MODULUS)
        have = np.ones(1, np.uint64)
        while len(have) < max(size, 1 << 16):
            far = np.full(len(have), pow(step, len(have), _MODULUS), np.uint64)
            have = np.concatenate([have, _times(have, far)])
        if size <= 1 << 22:
            _powers[kind] = have
    return have[:size]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums of symbol * point**position, from which ``span_hash`` reads the hash of any stretch. The
    sums of the products' upper and lower halves are exact and stay apart."""
    n = len(symbols)
    powers = _table("up", n)
    sums = np.zeros((2, n + 1), np.uint64)
    if symbols.dtype == np.uint8 and n < 1 << 23:
        # Products of a byte with either half of a power have 40 bits.
        values = symbols.astype(np.uint64)
        values += np.uint64(1)
        np.cumsum(values * (powers >> np.uint64(31)), out=sums[0, 1:])
        np.cumsum(values * (powers & _HALF), out=sums[1, 1:])
    else:
        terms = _times(_reduced(symbols.astype(np.uint64)) + np.uint64(1), powers)
        np.cumsum(terms >> np.uint64(31), out=sums[0, 1:])
        np.cumsum(terms & _HALF, out=sums[1, 1:])
    return sums


def _named(high: np.ndarray, low: np.ndarray, back: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes from a stretch's sums: moved back to position 0, with the length, spread over 64 bits."""
    found = _times(_joined(high, low), back)
    found ^= sizes * _MIX2
    return mix(found)


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end): equal content gives equal hashes wherever it stands."""
    high, low = sums[0][ends] - sums[0][starts], sums[1][ends] - sums[1][starts]
    return _named(high, low, _table("down", sums.shape[1])[starts], (ends - starts).astype(np.uint64))


def gram_hash(sums: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of every stretch of ``size`` symbols."""
    n = sums.shape[1] - size
    if n <= 0:
        return np.empty(0, np.uint64)
    back, sizes, found = _table("down", n), np.full(1, size, np.uint64), np.empty(n, np.uint64)
    # In pieces that stay in the processor's cache.
    for a in range(0, n, _PIECE):
        b = min(a + _PIECE, n)
        high, low = (part[a + size : b + size] - part[a:b] for part in sums)
        found[a:b] = _named(high, low, back[a:b], sizes)
    return found


def split_words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the number of words before it."""
    word = ~separator[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, separator: np.ndarray = SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and per text the number of words before it."""
    if lower:
        data = LOWER[data]
    starts, ends, places = split_words(data, offsets, separator)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends, places
    return span_hash(prefix_sums(data), starts, ends), starts, ends, places


def shingles(hashes: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and per text the number of shingles before it. A text
    with fewer words has one shingle, its whole sequence; a text without words has none."""
    counts = np.diff(places)
    per_text = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    where = np.zeros(len(places), np.int64)
    np.cumsum(per_text, out=where[1:])
    total = int(where[-1])
    if not total:
        return np.empty(0, np.uint64), where
    starts = np.arange(total) - np.repeat(where[:-1] - places[:-1], per_text)
    lengths = np.repeat(np.minimum(counts, size), per_text)
    return span_hash(prefix_sums(hashes), starts, starts + lengths), where
