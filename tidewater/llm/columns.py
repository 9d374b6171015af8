"""Numeric arrays in compact binary columns: bytes of equal weight side by side, then zstd."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

HEADER = "<2sHQQQ"  # kind, bytes of an entry, factor (0: none), entries, length


def put(*arrays: np.ndarray | tuple[np.ndarray, int]) -> bytes:
    """An array may be given as (quotients, factor); it is read as their products, 64 bits wide."""
    squeeze = zstandard.ZstdCompressor(level=1)
    out = [struct.pack("<H", len(arrays))]
    for a in arrays:
        a, factor = a if isinstance(a, tuple) else (a, 0)
        a = np.ascontiguousarray(a)
        width = a.dtype.itemsize
        body = squeeze.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T).tobytes())
        out += [struct.pack(HEADER, a.dtype.str[1:].encode(), width, factor, len(a), len(body)), body]
    return b"".join(out)


def get(data: bytes) -> list[np.ndarray]:
    open_up = zstandard.ZstdDecompressor()
    (n,), at, out = struct.unpack_from("<H", data), 2, []
    for _ in range(n):
        kind, width, factor, size, length = struct.unpack_from(HEADER, data, at)
        at += struct.calcsize(HEADER)
        raw = open_up.decompress(data[at:at + length], max_output_size=max(1, size * width))
        at += length
        planes = np.frombuffer(raw, np.uint8, size * width).reshape(width, size)
        a = np.ascontiguousarray(planes.T).view(f"<{kind.decode()}").reshape(size)
        out.append(a.astype(np.uint64) * np.uint64(factor) if factor else a)
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of an ascending array of unsigned integers; ``np.cumsum`` undoes it."""
    return np.diff(a, prepend=a.dtype.type(0))


def coded(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, values) of an array with few distinct values."""
    values, codes = np.unique(a, return_inverse=True)
    return codes.astype(np.uint32), values
