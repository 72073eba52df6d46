"""Arrays of whole numbers as one compressed value of a column, so that a task's counts travel and lie in few bytes."""

from __future__ import annotations

import ctypes
import struct

import numpy as np
import pyarrow as pa

_HEAD = struct.Struct("<BQQ")
_WIDTHS = (1, 2, 4, 8)


def give_back() -> None:
    """Freed memory goes back to the system: workers live on between tasks, and what one keeps another lacks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays without negative numbers; each in the fewest bytes a number that hold its largest, byte by byte, zstd."""
    codec, out = pa.Codec("zstd", 1), []
    for x in arrays:
        most = int(x.max()) if len(x) else 0
        width = next(w for w in _WIDTHS if most < 1 << 8 * w)
        planes = np.ascontiguousarray(np.ascontiguousarray(x, dtype=f"<u{width}").view(np.uint8).reshape(len(x), width).T)
        data = codec.compress(planes.data, asbytes=True) if len(x) else b""
        out += [_HEAD.pack(width, len(x), len(data)), data]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays, of 32 bits where that is enough, else of 64; hashes are to be made unsigned again."""
    codec, out, at = pa.Codec("zstd", 1), [], 0
    while at < len(data):
        width, n, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        if n:
            planes = np.frombuffer(codec.decompress(memoryview(data)[at:at + size], width * n), np.uint8).reshape(width, n)
            short = width < 4 or width == 4 and planes[3].max() < 128
            out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int32 if short else np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += size
    return out
