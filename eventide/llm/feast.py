"""Largest eigenpairs of a symmetric matrix by contour integration.

An interval of the axis is enclosed by a circle; a quadrature of solves with
complex shifts along it, ``sum w (z - A)^-1 Y``, keeps of random vectors ``Y``
what lies in the eigenspace of the enclosed eigenvalues and damps the rest.
Rayleigh-Ritz on that subspace gives eigenpairs, and the step is repeated with
the Ritz vectors until their residuals are at rounding level.  How many
eigenvalues an interval holds is known beforehand from the inertia of
``A - shift`` at both ends (Sylvester's law), so none can be missed.
"""

from __future__ import annotations

import numpy as np

POINTS = 8              # quadrature points on the upper half circle; the lower half mirrors them
IN_ONE = 8              # eigenvalues an interval holds at most, unless they are tied
GUARD = 6               # vectors beyond the interval's eigenvalues
TIED = 1e-7             # relative width below which an interval is not cut
ROUNDS = 40
SEED = 11
_PIVOT = (1 + 17 ** 0.5) / 8


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: the positive ones of
    the block-diagonal factor of ``a - shift``, factored symmetrically with
    complete pivoting (blocks of one or two rows)."""
    rest = a - shift * np.eye(len(a))
    positive = 0
    while len(rest):
        size = np.abs(rest)
        r, s = divmod(int(size.argmax()), len(rest))
        d = int(np.diagonal(size).argmax())
        if size[r, s] == 0:
            break
        pivot = [d] if size[d, d] >= _PIVOT * size[r, s] else [r, s]
        keep = np.setdiff1d(np.arange(len(rest)), pivot)
        block, side = rest[np.ix_(pivot, pivot)], rest[np.ix_(keep, pivot)]
        positive += int(block[0, 0] > 0) if len(pivot) == 1 else 1      # a block of two has one of each sign
        rest = rest[np.ix_(keep, keep)] - side @ np.linalg.solve(block, side.T)
        rest = (rest + rest.T) / 2
    return positive


def intervals(a: np.ndarray, wanted: int, low: float, high: float) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` from the top, disjoint, that hold at least the
    ``wanted`` largest eigenvalues above ``low``; their ends keep off them."""
    found, left = [], [(low, high, above(a, low), above(a, high))]
    while left and sum(f[2] for f in found) < wanted:
        lo, hi, over_lo, over_hi = left.pop()
        if over_lo == over_hi:
            continue
        cut = None
        if over_lo - over_hi > IN_ONE and hi - lo > TIED * high:
            gap = 1e-4 * (hi - lo)
            for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65):
                at = lo + share * (hi - lo)
                n = above(a, at - gap)
                if n == above(a, at + gap):
                    cut = (at, n)
                    break
        if cut is None:
            found.append((lo, hi, over_lo - over_hi))
        else:
            left += [(lo, cut[0], over_lo, cut[1]), (cut[0], hi, cut[1], over_hi)]
    return found


def project(a: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """``y`` through the contour's filter."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    for t, w in zip(nodes, weights):
        turn = np.exp(0.5j * np.pi * (1 - t))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(a)) - a, y.astype(complex))
        out += 0.5 * w * (radius * turn * solved).real
    return out


def rayleigh_ritz(a: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values and vectors of the space that ``basis`` spans."""
    q, s, _ = np.linalg.svd(basis, full_matrices=False)
    q = q[:, s > 1e-12 * s[0]]
    h = q.T @ a @ q
    values, turn = np.linalg.eigh((h + h.T) / 2)
    return values, q @ turn


def in_interval(a: np.ndarray, low: float, high: float, count: int, scale: float) -> np.ndarray:
    """The ``count`` eigenvectors of the eigenvalues in ``(low, high]``."""
    rng, width = np.random.default_rng(SEED), count + GUARD
    while True:
        width = min(width, len(a))
        y, best = rng.standard_normal((len(a), width)), None
        for _ in range(ROUNDS):
            values, vectors = rayleigh_ritz(a, project(a, y, low, high))
            inside = (values > low) & (values <= high)
            x = vectors[:, inside]
            if x.shape[1] == count:
                error = np.abs(a @ x - x * values[inside]).max()
                if best is not None and error >= best[0] / 2 and best[0] <= 1e-12 * scale:
                    return best[1]
                if best is None or error < best[0]:
                    best = (error, x)
            y = vectors
        if best is not None and best[0] <= 1e-12 * scale:
            return best[1]
        if width == len(a):
            raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}], not all were found")
        width *= 2


def largest(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding level of a positive
    semidefinite matrix, falling, and unit eigenvectors as columns (each with
    its largest component positive); fewer if fewer are above it."""
    scale = float(np.abs(a).sum(1).max(initial=0.0))        # no eigenvalue is larger
    if scale == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    low = scale * len(a) * 1e-14
    wanted = min(wanted, above(a, low))
    if not wanted:
        return np.zeros(0), np.zeros((len(a), 0))
    parts = [in_interval(a, lo, hi, n, scale) for lo, hi, n in intervals(a, wanted, low, scale * (1 + 1e-9))]
    values, vectors = rayleigh_ritz(a, np.concatenate(parts, axis=1))
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return values, vectors * sign
