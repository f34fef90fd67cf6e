"""A minimal perfect hash of whole numbers: each of n keys gets its own place from 0 to n - 1.

Each level has two bits per key still without a place. A key alone at its bit,
by that level's hash, sets the bit and is done; the others go to the next level.
A key's place is the number of set bits before its own.
"""

from __future__ import annotations

import numpy as np

from vigil.llm.common import U64, mix

#: Bits per key and level.
ROOM = 2


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys.astype(U64) + U64(0x9E3779B97F4A7C15) * U64(level + 1)) % U64(size)).astype(np.int64)


def build(keys: np.ndarray) -> bytes:
    """The function of distinct keys: sizes of its levels, then their bits."""
    sizes, bits = [], []
    left = keys
    while len(left):
        size = -(-ROOM * len(left) // 8) * 8
        at = _bit(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~alone[at]]
    return np.array([len(sizes), *sizes], "<i8").tobytes() + b"".join(b.tobytes() for b in bits)


def places(function: bytes, keys: np.ndarray) -> np.ndarray:
    """Each key's place; a number that is no key gets -1 or any place, so the key there has to be compared."""
    levels = int(np.frombuffer(function, "<i8", 1)[0])
    sizes = np.frombuffer(function, "<i8", levels, 8)
    bits = np.unpackbits(np.frombuffer(function, np.uint8, offset=8 * (levels + 1))).astype(bool)
    before = np.cumsum(bits, dtype=np.int64) - bits
    out = np.full(len(keys), -1, np.int64)
    left = np.arange(len(keys))
    begin = 0
    for level, size in enumerate(sizes.tolist()):
        at = begin + _bit(keys[left], level, size)
        found = bits[at]
        out[left[found]] = before[at[found]]
        left = left[~found]
        begin += size
    return out


def in_order(function: bytes, keys: np.ndarray) -> np.ndarray:
    """The keys by place."""
    out = np.empty_like(keys)
    out[places(function, keys)] = keys
    return out


def verified_places(function: bytes, by_place: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys that must all be known; one that is not is an error."""
    at = places(function, keys)
    if len(keys) and (at.min() < 0 or (by_place[at] != keys).any()):
        raise ValueError("a key is missing from the hash function: the input changed between passes")
    return at
