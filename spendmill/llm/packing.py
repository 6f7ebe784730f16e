"""Columns of numbers as one compressed blob, so that a shuffle moves a few large rows instead of many tiny ones."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*columns: np.ndarray, level: int = 1) -> bytes:
    """Columns of any lengths; each is stored byte plane after byte plane, which makes small numbers compress."""
    parts = [struct.pack("<B", len(columns))]
    for column in columns:
        code = column.dtype.str.encode().ljust(4)
        planes = np.ascontiguousarray(column.reshape(-1, 1).view(np.uint8).T).tobytes() if len(column) else b""
        parts += [struct.pack("<4sQ", code, len(column)), planes]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    columns, at = [], 1
    for _ in range(raw[0]):
        code, n = struct.unpack_from("<4sQ", raw, at)
        kind = np.dtype(code.decode().strip())
        at += 12
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * kind.itemsize, offset=at).reshape(kind.itemsize, n)
        columns.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.empty(0, dtype=kind))
        at += n * kind.itemsize
    return columns


def smallest(numbers: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the narrowest unsigned type that holds them."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()) if len(numbers) else 0))
