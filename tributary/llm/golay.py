"""The binary Golay code (23, 12, 7) as a hash of near bit strings.

The code is perfect: every 23-bit string lies within 3 bits of exactly one
codeword.  Two strings at most 2 bits apart have a string between them that is
at most 1 bit from either; its codeword is among the nearby codewords of both.
A string has one nearby codeword (within 2 bits of it) or six (3 bits off).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

BITS = 23
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(v: int) -> int:
    for shift in range(11, -1, -1):
        if v >> (shift + 11) & 1:
            v ^= _GENERATOR << shift
    return v


_OF_BIT = [_remainder(1 << b) for b in range(BITS)]


def _syndromes(values: np.ndarray) -> np.ndarray:
    out = np.zeros(values.shape, np.int64)
    for b, s in enumerate(_OF_BIT):
        out ^= (values >> b & 1) * s
    return out


def _errors() -> np.ndarray:
    """The error of at most 3 bits behind each of the 2048 syndromes."""
    table = np.zeros(1 << 11, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(BITS), weight):
            table[int(np.bitwise_xor.reduce([_OF_BIT[b] for b in bits]))] = sum(1 << b for b in bits)
    return table


_ERROR = _errors()


def decode(values: np.ndarray) -> np.ndarray:
    """Index (0..4095) of the codeword nearest to each 23-bit value."""
    return (values ^ _ERROR[_syndromes(values)]) >> 11


def nearby(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) for every codeword that a value, or a value one bit from
    it, decodes to; each pair once."""
    flips = np.concatenate([[0], 1 << np.arange(BITS)])
    index = decode(values[:, None] ^ flips[None, :])
    index.sort(axis=1)
    first = np.ones(index.shape, bool)
    first[:, 1:] = index[:, 1:] != index[:, :-1]
    return np.nonzero(first)[0], index[first]
