"""Cross-polytope hashing: pseudo-random rotations by signs and fast Hadamard transforms, then the nearest signed axis."""

from __future__ import annotations

import numpy as np

ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, table: int, seed: int = 11) -> np.ndarray:
    """Rows turned by the pseudo-rotation number ``table``; widths are filled up to a power of two."""
    width = 1 << max(0, int(x.shape[1] - 1).bit_length())
    if width > x.shape[1]:
        x = np.concatenate([x, np.zeros((len(x), width - x.shape[1]))], axis=1)
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], size=(ROUNDS, width))
    for s in signs:
        x = hadamard(x * s)
    return x


def codes(x: np.ndarray, table: int, depth: int = 1) -> np.ndarray:
    """The nearest signed axis of each row, of ``depth`` rotations put together."""
    out = np.zeros(len(x), dtype=np.int64)
    for k in range(depth):
        y = rotated(x, table * 8 + k)
        axis = np.abs(y).argmax(axis=1)
        out = out * (2 * y.shape[1]) + axis + y.shape[1] * (y[np.arange(len(y)), axis] < 0)
    return out


def coarse_codes(x: np.ndarray, table: int, cells: int) -> np.ndarray:
    """A code below ``cells``, a power of two: nearest signed axes of as many rotations as needed, the last among the first axes only."""
    out = np.zeros(len(x), dtype=np.int64)
    k = 0
    while cells > 1:
        y = rotated(x, 1_000 + table * 8 + k)
        axes = min(y.shape[1], cells // 2)
        y = y[:, :axes]
        axis = np.abs(y).argmax(axis=1)
        out = out * (2 * axes) + axis + axes * (y[np.arange(len(y)), axis] < 0)
        cells //= 2 * axes
        k += 1
    return out


def probes(x: np.ndarray, table: int, count: int, depth: int = 1) -> np.ndarray:
    """The ``count`` codes of each row that lose least against the nearest axes, best first."""
    width = 1 << max(0, int(x.shape[1] - 1).bit_length())
    step = max(1, (1 << 22) // min(count, 2 * width) ** 2) if depth > 1 else max(1, len(x))  # combinations in memory at a time
    if len(x) > step:
        return np.concatenate([probes(x[i : i + step], table, count, depth) for i in range(0, len(x), step)])
    best, loss = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
    for k in range(depth):
        y = rotated(x, table * 8 + k)
        both = np.concatenate([y, -y], axis=1)
        near = np.argsort(-both, axis=1, kind="stable")[:, :count]
        lost = both.max(axis=1, keepdims=True) - np.take_along_axis(both, near, axis=1)
        all_codes = (best[:, :, None] * both.shape[1] + near[:, None, :]).reshape(len(x), -1)
        all_loss = (loss[:, :, None] + lost[:, None, :]).reshape(len(x), -1)
        order = np.argsort(all_loss, axis=1, kind="stable")[:, :count]
        best, loss = np.take_along_axis(all_codes, order, axis=1), np.take_along_axis(all_loss, order, axis=1)
    return best
