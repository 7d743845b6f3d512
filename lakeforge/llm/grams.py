"""Words of UTF-8 texts as places and 64-bit keys, found by numpy over bytes instead of word by word.

Keys are polynomial hashes made from one running sum over the bytes. Two words can share a key, so callers compare bytes
(:func:`agree`) wherever a result rests on a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes worked on at once, about; a longer stretch without a place to cut is taken whole.
CHUNK = 1 << 20
BASE, STEP = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer, as low bits of polynomial hashes are poor."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seed_of(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def folded(gaps: bytes, ends: bytes = b"") -> bytes:
    """A table for ``bytes.translate``: A-Z in lower case, ``gaps`` as blanks, ``ends`` as line ends."""
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    for b in gaps:
        table[b] = 32
    for b in ends:
        table[b] = 10
    return bytes(table)


def cuts(data: bytes, at: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """``data`` in stretches of about ``size`` bytes, cut after a byte ``at``."""
    begin = 0
    while len(data) - begin > size:
        end = data.rfind(at, begin, begin + size)
        end = end if end >= 0 else data.find(at, begin + size)
        if end < 0:
            break
        yield data[begin : end + 1]
        begin = end + 1
    yield data[begin:]


def gathered(parts: Iterable[tuple[int, bytes]], size: int = CHUNK) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbered stretches in groups of about ``size`` bytes."""
    numbers, held, total = [], [], 0
    for number, part in parts:
        if held and total + len(part) > size:
            yield numbers, held
            numbers, held, total = [], [], 0
        numbers.append(number)
        held.append(part)
        total += len(part) + 1
    if held:
        yield numbers, held


class Words:
    """Places and keys of the words of ``data``: runs of bytes other than blank and line end."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: bytes, base: int = BASE):
        self.data, self.x = data, np.frombuffer(data, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = (self.x != 32) & (self.x != 10)
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = self.powers(base, len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.x.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        self.keys = mixed((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    @classmethod
    def powers(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of ``base`` and of its inverse modulo 2^64; those of usual chunks are kept."""
        if base in cls._powers and n < len(cls._powers[base][0]):
            return cls._powers[base]
        size = max(n + 1, CHUNK + (CHUNK >> 2))
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        if size <= 2 * CHUNK:
            cls._powers[base] = tuple(made)
        return tuple(made)


def agree(x: np.ndarray, a: np.ndarray, a_end: np.ndarray, y: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether the bytes ``x[a:a_end]`` and ``y[b:b_end]`` are equal, for arrays of places."""
    size = a_end - a
    ok = size == b_end - b
    live, j = np.flatnonzero(ok), 0
    while len(live):
        live = live[size[live] > j]
        same = x[a[live] + j] == y[b[live] + j]
        ok[live[~same]] = False
        live, j = live[same], j + 1
    return ok
