"""Words and word hashes of many texts at once, from their UTF-8 bytes.

A word is a run of bytes other than ASCII white space (0x20, 0x09 to 0x0D). Its
hash is a polynomial over random byte values, taken from running sums, so the
cost is a few array passes whatever the words are; a finaliser spreads it.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np

#: Bytes whose running sum is held at once; words longer than this are hashed apart.
PIECE = 1 << 20
_ODD = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values (the published splitmix constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KIND = np.ones(256, np.int8)
_KIND[_SPACE] = 0
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_POWER = np.full(PIECE + 1, 0xD6E8FEB86659FD93, np.uint64)
_POWER[0] = 1
_POWER = np.cumprod(_POWER)


@dataclass
class Words:
    """Words of consecutive texts: ``first[i]:first[i + 1]`` are those of text ``i``."""

    buffer: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray | None = None

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        upto = int(np.searchsorted(end, low + PIECE, "right"))
        if upto == at:
            out[at] = int.from_bytes(blake2b(buffer[low : end[at]].tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        part = buffer[low : end[upto - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * _POWER[: len(part)], out=sums[1:])
        s, e = start[at:upto] - low, end[at:upto] - low
        out[at:upto] = mixed((sums[e] - sums[s]) * _POWER[PIECE - s])
        at = upto
    return out


def words(texts, fold: bool = False, hashed: bool = True, marks: bool = False) -> Words:
    """Words of ``texts`` (None: empty).

    ``fold`` lower-cases A to Z; ``marks`` makes runs of ASCII punctuation words of their own.
    """
    raw = [b"" if t is None else (t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t) for t in texts]
    joined = b"\n".join(raw)
    if fold:
        joined = joined.lower()
    buffer = np.frombuffer(joined, np.uint8)
    kind = np.zeros(len(buffer) + 2, np.int8)
    kind[1:-1] = _KIND[buffer] if marks else ~_SPACE[buffer]
    edge = kind[1:] != kind[:-1]
    start, end = np.flatnonzero(edge & (kind[1:] > 0)), np.flatnonzero(edge & (kind[:-1] > 0))
    lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    text_start = np.concatenate(([0], np.cumsum(lengths)))
    first = np.searchsorted(start, text_start)
    return Words(joined, start, end, first, hashes(buffer, start, end) if hashed else None)


def shingles(hash: np.ndarray, size: int) -> np.ndarray:
    """One hash for each ``size`` consecutive word hashes."""
    n = len(hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        factor = (_ODD * (2 * k + 1) ** 3 | 1) & 0xFFFFFFFFFFFFFFFF
        total += hash[k : k + n] * np.uint64(factor)
    return mixed(total)


def rolling(hash: np.ndarray, size: int) -> np.ndarray:
    """As ``shingles``, in a number of passes that does not grow with ``size``."""
    n = len(hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = PIECE - size
    for at in range(0, n, step):
        part = hash[at : at + step + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(mixed(part) * _POWER[: len(part)], out=sums[1:])
        m = len(part) - size + 1
        out[at : at + m] = (sums[size : size + m] - sums[:m]) * _POWER[PIECE - np.arange(m)]
    return mixed(out)
