"""The E8 lattice: decoding, neighbours and cell keys, as numpy array functions.

Points are kept with doubled coordinates, so that they are whole numbers.
"""

from __future__ import annotations

import itertools

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _decode_d8(y: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (whole coordinates of even sum) to each row."""
    near = np.rint(y)
    gap = y - near
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(gap[odd]).argmax(axis=1)
    near[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point to each row of ``y`` (n x 8), doubled."""
    whole = _decode_d8(y)
    half = _decode_d8(y - 0.5) + 0.5
    nearer = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], half, whole)).astype(np.int64)


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: the steps to neighbouring cells."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((2, -2), repeat=2):
            step = [0] * 8
            step[i], step[j] = a, b
            found.append(step)
    for signs in itertools.product((1, -1), repeat=8):
        if signs.count(-1) % 2 == 0:
            found.append(list(signs))
    return np.array(found, dtype=np.int64)


_STEPS = shortest_vectors()


def probe(y: np.ndarray, point: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``probes`` neighbours of ``point`` nearest to ``y``, and the extra squared distance of each."""
    residual = y - point / 2
    score = residual @ (_STEPS.T / 2)
    best = np.argpartition(-score, min(probes, 239), axis=1)[:, :probes]
    order = np.take_along_axis(score, best, axis=1).argsort(axis=1)[:, ::-1]
    best = np.take_along_axis(best, order, axis=1)
    return point[:, None, :] + _STEPS[best], 2 - 2 * np.take_along_axis(score, best, axis=1)


def cell_key(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit key of lattice points (coordinates on the last axis)."""
    key = np.full(points.shape[:-1], salt * 2 + 1, dtype=np.uint64) * _MIX
    for i in range(points.shape[-1]):
        key ^= points[..., i].astype(np.uint64) + _MIX + (key << np.uint64(6)) + (key >> np.uint64(2))
        key *= np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(31)
    return key.view(np.int64)
