"""Eigendecomposition of a symmetric matrix, changed by one rank at a time.

``Spectrum`` holds ``values`` (ascending) and ``vectors`` (columns) of a scatter matrix, with the exact count and sums of the vectors in it.
Adding ``v v'`` works in the eigenbasis: with z the coordinates of v there, the new eigenvalues are the roots of the secular equation

    1 + sum_i z_i^2 / (d_i - x) = 0,

one between each two neighbouring old ones. Deflation first takes out what doesn't change: coordinates that are zero to working
precision, and all but one of a set of equal eigenvalues (a rotation puts their coordinates into one). Every root is kept as its distance
from the nearer pole, and the coordinates are computed anew from the roots (so that these are exact for them), which keeps the
vectors orthogonal to working precision however close two roots are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(float).eps
#: Steps of the root finder at most: it needs three to six, and from the twelfth on every other one halves the bracket.
STEPS = 160


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots for distinct ascending poles ``d`` and squared coordinates ``z2`` > 0, and the matrix of d_i - root_k ([k, i])."""
    n = len(d)
    upper = np.append(d[1:], d[-1] + 1.01 * z2.sum())
    k = np.arange(n)
    # which pole is nearer: the sign at the middle of the interval
    middle = (d + upper) / 2
    f = 1 + (z2 / (d - middle[:, None])).sum(axis=1)
    left = (f >= 0) | (k == n - 1)  # the last interval has a pole at its left end only
    origin = np.where(left, d, upper)
    delta = d[None, :] - origin[:, None]
    gap = upper - d
    low, high = np.where(left, 0.0, -gap), np.where(left, gap, 0.0)
    half = (f >= 0)
    low = np.where(left & ~half, gap / 2, low)
    high = np.where(left & half, gap / 2, high)
    low = np.where(~left, -gap / 2, low)
    tau = (low + high) / 2
    below = np.tril(np.ones((n, n)))  # [k, i]: pole i lies left of root k
    next_pole = np.minimum(k + 1, n - 1)
    active = np.ones(n, bool)
    for step in range(STEPS):
        gaps = delta - tau[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            part = z2 / gaps
            slope = part / gaps
            whole, psi = part.sum(axis=1), np.einsum("ki,ki->k", part, below)
            phi = whole - psi
            f = 1 + whole
            done = (np.abs(f) <= 8 * EPS * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= 2 * EPS * np.abs(tau)) | (f == 0)
            active &= ~done
            if not active.any():
                break
            low, high = np.where(active & (f < 0), tau, low), np.where(active & (f > 0), tau, high)
            # a rational function with the two neighbouring poles takes the place of the sum
            dpsi = np.einsum("ki,ki->k", slope, below)
            dphi = slope.sum(axis=1) - dpsi
            a1 = gaps[k, k]
            a2 = np.where(k < n - 1, gaps[k, next_pole], 0.0)
            c = f - a1 * dpsi - a2 * dphi
            a = (a1 + a2) * f - a1 * a2 * (dpsi + dphi)
            b = a1 * a2 * f
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            move = np.where(k < n - 1, move, _last_move(f, dpsi, a1))
            new = tau + move
        # where the model leaves the bracket, or takes long, the bracket is halved
        bad = ~np.isfinite(new) | (new <= low) | (new >= high) | (step >= 12 and step % 2 == 0)
        tau = np.where(active, np.where(bad, (low + high) / 2, new), tau)
    return origin + tau, delta - tau[:, None]


def _last_move(f: np.ndarray, slope: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Step for the last root: c + s / (gap - x) with the sum's value and slope."""
    s = slope * gap * gap
    c = f - s / gap
    return gap + s / c


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of Q diag(values) Q' + v v'."""
    z = vectors.T @ v
    norm2 = float(z @ z)
    if not norm2 > 0:
        return values, vectors
    tol = 8 * EPS * max(float(np.abs(values).max()), norm2)
    d, q = values.copy(), vectors.copy()
    size = np.sqrt(norm2)
    live = np.abs(z) * size > tol
    z[~live] = 0
    at = np.flatnonzero(live)
    # of poles that are equal to working precision one keeps the coordinate
    last = at[0] if len(at) else -1
    for i in at[1:].tolist():
        r = np.hypot(z[last], z[i])
        c, s = z[i] / r, z[last] / r
        if abs((d[i] - d[last]) * c * s) <= tol:
            one, two = d[last], d[i]
            z[i], z[last] = r, 0.0
            live[last] = False
            q[:, last], q[:, i] = c * q[:, last] - s * q[:, i], s * q[:, last] + c * q[:, i]
            d[last], d[i] = one * c * c + two * s * s, one * s * s + two * c * c
        last = i
    at = np.flatnonzero(live)
    at = at[np.argsort(d[at], kind="stable")]
    if len(at):
        poles = d[at]
        roots, gaps = secular_roots(poles, z[at] ** 2)
        n = len(at)
        # coordinates that have exactly these roots: products over interlacing differences
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = poles[None, :] - poles[:, None]  # [k, i]: d_i - d_k
            k, i = np.indices((n, n))
            ratio = np.ones((n, n))
            before = k < i
            ratio[before] = (-gaps[before]) / (-apart[before])  # (root_k - d_i) / (d_k - d_i)
            later = (k >= i) & (k < n - 1)
            ratio[later] = (-gaps[later]) / (-apart[np.minimum(k + 1, n - 1), i][later])  # (root_k - d_i) / (d_{k+1} - d_i)
            z_new = np.sqrt(np.abs(np.prod(ratio, axis=0) * -gaps[n - 1]))
        z_new = np.copysign(z_new, z[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            u = z_new[None, :] / gaps  # [k, i]
        hit = ~np.isfinite(u)
        if hit.any():  # a root that is a pole to the last bit
            rows = hit.any(axis=1)
            u[rows] = hit[rows].astype(float)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        q[:, at] = q[:, at] @ u.T
        d[at] = roots
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


@dataclass
class Spectrum:
    """Scatter about the mean of some vectors of whole numbers: its spectrum, their count and exact sums."""

    n: int
    sums: np.ndarray  # Python ints
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size, object), np.zeros(size), np.eye(size))

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _shift(self, n: int, sums: np.ndarray) -> None:
        """What the distance of the two means adds, and the new count and sums."""
        if self.n and n:
            gap = self.n * sums - n * self.sums  # exact: (mean - own mean) * n * own n
            self._update(np.array([float(g) for g in gap]) / np.sqrt(float(self.n) * n * (self.n + n)))
        self.n, self.sums = self.n + n, self.sums + sums

    def add_rows(self, x: np.ndarray) -> None:
        """Take in the rows of ``x`` (int64), centred on their own mean.

        More rows than columns are first turned into as many as columns, of equal scatter (the triangle of their QR decomposition),
        each of which is one update; fewer are updates themselves.
        """
        n = len(x)
        if not n:
            return
        sums = (x >> 26).sum(axis=0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)
        whole = np.array([int(s) // n for s in sums], np.int64)
        rest = np.array([int(s) % n for s in sums], float) / n
        centred = (x - whole).astype(float) - rest
        for row in np.linalg.qr(centred, mode="r") if n > x.shape[1] else centred:
            self._update(row)
        self._shift(n, sums)

    def add(self, other: Spectrum) -> None:
        """Take in another spectrum: one update for each of its eigenvalues, one for the means."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self._update(np.sqrt(value) * vector)
        self._shift(other.n, other.sums)
