"""Places of points along a Hilbert curve in any number of dimensions (Skilling, 2004)."""

from __future__ import annotations

import numpy as np


def places(points: np.ndarray, bits: int) -> list[bytes]:
    """For each row of cell numbers below 2^bits its place on the curve, as bytes that sort like it."""
    x = points.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    for level in (top >> i for i in range(bits - 1)):
        below = level - 1
        for axis in x:
            high = (axis & level) != 0
            swap = np.where(high, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(high, below, swap)
            axis ^= swap
    # Gray code over the axes, then the turns that the lower levels of the last one ask for.
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in (top >> i for i in range(bits - 1)):
        turn ^= np.where(x[-1] & level, level - 1, 0)
    x ^= turn
    flags = [(axis >> bit) & 1 for bit in range(bits - 1, -1, -1) for axis in x]
    return [row.tobytes() for row in np.packbits(np.array(flags, np.uint8).T, axis=1)]
