"""A one-to-one mixing of 64-bit values."""

from __future__ import annotations

import numpy as np


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits; one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h
