"""XXH64 of many slices of one buffer at once."""

from __future__ import annotations

import numpy as np
import xxhash

# The primes of the XXH64 definition.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)
# Slices from this length on are hashed by the library, one by one.
LONG = 32
# Below this many slices the library is faster.
FEW = 24


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: bytes, starts: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """Unsigned XXH64 of ``data[start : start + size]`` for every slice."""
    out = np.empty(len(starts), np.uint64)
    short = sizes < LONG if len(starts) >= FEW else np.zeros(len(starts), bool)
    rest = np.flatnonzero(~short)
    of = xxhash.xxh64_intdigest
    ends = (starts + sizes)[rest].tolist()
    out[rest] = [of(data[a:b], seed) for a, b in zip(starts[rest].tolist(), ends, strict=True)]
    where = np.flatnonzero(short)
    if not len(where):
        return out
    room = data + bytes(8)
    eight = np.ndarray(len(data) + 1, "<u8", room, strides=(1,))
    four = np.ndarray(len(data) + 1, "<u4", room, strides=(1,))
    one = np.frombuffer(room, np.uint8)
    at, size = starts[where].copy(), sizes[where]
    h = np.uint64(seed) + P5 + size.astype(np.uint64)
    for step in range(8, LONG, 8):
        i = np.flatnonzero(size >= step)
        lane = _turn(eight[at[i]] * P2, 31) * P1
        h[i] = _turn(h[i] ^ lane, 27) * P1 + P4
        at[i] += 8
    i = np.flatnonzero(size & 4)
    h[i] = _turn(h[i] ^ (four[at[i]].astype(np.uint64) * P1), 23) * P2 + P3
    at[i] += 4
    for step in range(1, 4):
        i = np.flatnonzero((size & 3) >= step)
        h[i] = _turn(h[i] ^ (one[at[i]].astype(np.uint64) * P5), 11) * P1
        at[i] += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    out[where] = h ^ (h >> np.uint64(32))
    return out
