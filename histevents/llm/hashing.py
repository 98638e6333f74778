"""64-bit polynomial hashes of many ranges of an array at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Odd bases of the polynomials modulo 2**64, and random numbers for bytes.
BASE = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95, "second": 0xA0761D6478BD642F}
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x2545F4914F6CDD1D))
BYTE2 = mix(BYTE + _U(1))
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n (kept in the worker)."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        m, b = 1 << max(16, n.bit_length()), BASE[base]
        up, down = np.full(m, b, np.uint64), np.full(m, pow(b, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[base] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS[base][0][:n], _POWERS[base][1][:n]


def ranges(values: np.ndarray, base: str, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[begin:end] for each pair, wherever it lies."""
    up, down = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return (total[end] - total[begin]) * down[begin]
