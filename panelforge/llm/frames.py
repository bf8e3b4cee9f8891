"""Number arrays and words as compressed binary values, for rows that hold many of them at once."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import zstandard

_HEAD = struct.Struct("<2sq")


def narrow(a: np.ndarray) -> np.ndarray:
    """Non-negative whole numbers in the smallest unsigned type that holds them."""
    most = int(a.max()) if len(a) else 0
    return a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def pack(*arrays: np.ndarray, level: int = 3) -> bytes:
    """The arrays, each as one plane per byte of its numbers, in one zstd frame."""
    parts = [struct.pack("<i", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(_HEAD.pack(f"{a.dtype.kind}{a.dtype.itemsize}".encode(), len(a)))
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(frame: bytes) -> list[np.ndarray]:
    """The arrays of a frame of ``pack``."""
    raw = zstandard.ZstdDecompressor().decompress(frame)
    n, at, out = struct.unpack_from("<i", raw)[0], 4, []
    for _ in range(n):
        kind, length = _HEAD.unpack_from(raw, at)
        at += _HEAD.size
        size = int(kind[1:])
        planes = np.frombuffer(raw, dtype=np.uint8, count=size * length, offset=at).reshape(size, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype(kind.decode())))
        at += size * length
    return out


def pack_words(words: Sequence[bytes]) -> bytes:
    return pack(narrow(np.fromiter(map(len, words), dtype=np.int64, count=len(words))),
                np.frombuffer(b"".join(words), dtype=np.uint8))


def unpack_words(frame: bytes) -> list[bytes]:
    lengths, joined = unpack(frame)
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    whole = joined.tobytes()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]
