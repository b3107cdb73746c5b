"""Byte-aligned variable-length coding of 32-bit values with separate control bytes.

Each control byte holds the byte lengths, less one, of four values (two bits each, the first in the lowest); the data are the
values' low bytes, little-endian, one after the other. Decoding looks lengths up in a table of 256 rows and gathers.
"""

from __future__ import annotations

import numpy as np

#: Lengths of the four values of each control byte.
LENGTHS = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)
_KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    v = np.asarray(values, "<u4")
    n = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    two = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    two[: len(v)] = n - 1
    control = (two.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    width = 2 if n.max(initial=1) <= 2 else 4  # bytes that no value has aren't looked at
    keep = np.ones(width * len(v), bool)
    for k in range(1, width):
        keep[k::width] = n > k
    return control.tobytes(), v.astype(f"<u{width}").view(np.uint8)[keep].tobytes()


def decode(control: bytes, data: bytes, count: int) -> np.ndarray:
    n = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    at = np.cumsum(n, dtype=np.int64) - n
    d = np.frombuffer(data + b"\0\0\0", np.uint8)
    v = d[at].astype(np.uint32)
    for k in range(1, int(n.max(initial=1))):
        v |= d[at + k].astype(np.uint32) << np.uint32(8 * k)
    return v & _KEEP[n]
