"""Strassen's multiplication of integer matrices."""

import numpy as np

LEAF = 32


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` in int64 by seven half-sized products, down to a side of ``leaf``.

    Odd sides get a row or column of zeros. Additions in int64 are exact modulo 2**64, so
    sums on the way may wrap around: the result is right wherever the true one fits.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,kj->ij", a, b)
    a, b = _even(a), _even(b)
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = product(a11 + a22, b11 + b22, leaf)
    p2 = product(a21 + a22, b11, leaf)
    p3 = product(a11, b12 - b22, leaf)
    p4 = product(a22, b21 - b11, leaf)
    p5 = product(a11 + a12, b22, leaf)
    p6 = product(a21 - a11, b11 + b12, leaf)
    p7 = product(a12 - a22, b21 + b22, leaf)
    whole = np.empty((2 * i, 2 * h), np.int64)
    whole[:i, :h] = p1 + p4 - p5 + p7
    whole[:i, h:] = p3 + p5
    whole[i:, :h] = p2 + p4
    whole[i:, h:] = p1 - p2 + p3 + p6
    return whole[:m, :n]


def _even(matrix: np.ndarray) -> np.ndarray:
    """The matrix with zeros added up to even sides."""
    odd = [(0, side % 2) for side in matrix.shape]
    return np.pad(matrix, odd) if odd != [(0, 0), (0, 0)] else matrix
