"""Seasonal ARMA models of one differenced series by exact Gaussian likelihood. Small helpers for work that Spark deals out by series.

The likelihood is that of all observations under the model's own covariance, so no row is spent on lags: the autocovariances follow
from the polynomials in closed form, and a Cholesky factor of their Toeplitz matrix gives innovations and determinant. Series of
months are short, so the matrix is small.
"""

from __future__ import annotations

import math

import numpy as np

LONGEST = 600  # observations, the latest ones, that the likelihood reads: fifty years of months
TRIES = 40  # likelihoods per parameter that the search may try


def _bounded(raw: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary polynomial from free numbers: partial autocorrelations inside (-1, 1), unrolled."""
    out = np.zeros(0)
    for r in np.tanh(raw):
        out = np.append(out - r * out[::-1], r)
    return out


def polynomials(raw: np.ndarray, order, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Lag weights (ar, ma) from lag 1 on: the products of the ordinary and the seasonal polynomials."""
    p, q, sp, sq = order
    parts, at = [], 0
    for n in (p, sp, q, sq):
        parts.append(_bounded(raw[at : at + n]))
        at += n

    def product(short: np.ndarray, long: np.ndarray, sign: float) -> np.ndarray:
        a = np.concatenate(([1.0], sign * short))
        b = np.zeros(1 + period * len(long))
        b[0] = 1.0
        b[period::period] = sign * long
        return sign * np.convolve(a, b)[1:]

    return product(parts[0], parts[1], -1.0), product(parts[2], parts[3], 1.0)


def weights(ar: np.ndarray, ma: np.ndarray, n: int) -> np.ndarray:
    """The first `n` weights of past innovations."""
    psi = np.zeros(n)
    psi[0] = 1.0
    for j in range(1, n):
        back = min(j, len(ar))
        psi[j] = (ma[j - 1] if j <= len(ma) else 0.0) + ar[:back] @ psi[j - back : j][::-1]
    return psi


def autocovariances(ar: np.ndarray, ma: np.ndarray, n: int) -> np.ndarray:
    """Autocovariances at lags 0 to n - 1 for unit innovations: a linear system for the first, a recursion for the others."""
    r, theta = len(ar), np.concatenate(([1.0], ma))
    psi = weights(ar, ma, len(theta))
    right = np.array([theta[k:] @ psi[: len(theta) - k] for k in range(len(theta))])
    size = max(r + 1, len(theta))
    right = np.concatenate([right, np.zeros(max(size - len(right), 0))])
    system = np.eye(size)
    for k in range(size):
        for j in range(1, r + 1):
            system[k, abs(k - j)] -= ar[j - 1]
    gamma = np.linalg.solve(system, right[:size])
    out = np.zeros(max(n, size))
    out[:size] = gamma
    for k in range(size, n):
        out[k] = ar @ out[k - r : k][::-1] if r else 0.0
    return out[:n]


def _innovations(w: np.ndarray, gamma: np.ndarray):
    """(Cholesky factor, innovations over their deviations) under the autocovariances; None if they are no covariance."""
    at = np.abs(np.subtract.outer(np.arange(len(w)), np.arange(len(w))))
    try:
        factor = np.linalg.cholesky(gamma[at])
    except np.linalg.LinAlgError:
        return None
    return factor, np.linalg.solve(factor, w)


def deviance(raw: np.ndarray, w: np.ndarray, order, period: int) -> float:
    """Minus twice the log likelihood at the best innovation variance."""
    try:
        gamma = autocovariances(*polynomials(raw, order, period), len(w))
    except np.linalg.LinAlgError:
        return math.inf
    found = _innovations(w, gamma) if np.isfinite(gamma).all() and gamma[0] > 0 else None
    if found is None:
        return math.inf
    factor, e = found
    n = len(w)
    return n * (math.log(2 * math.pi * max(float(e @ e) / n, 1e-12)) + 1) + 2 * float(np.log(np.diag(factor)).sum())


def minimise(fn, start: np.ndarray, tries: int) -> tuple[np.ndarray, float]:
    """Downhill simplex from `start`, which stops when its corners agree."""
    corners = [start, *(start + 0.4 * np.eye(len(start))[i] for i in range(len(start)))]
    simplex = sorted(((fn(c), tuple(c)) for c in corners), key=lambda t: t[0])
    used = len(corners)
    while used < tries and abs(simplex[-1][0] - simplex[0][0]) > 1e-3:
        middle = np.mean([c for _, c in simplex[:-1]], axis=0)
        worst = np.array(simplex[-1][1])

        def at(step: float) -> tuple[float, tuple]:
            c = middle + step * (middle - worst)  # noqa: B023
            return fn(c), tuple(c)

        new = at(1.0)
        used += 1
        if new[0] < simplex[0][0]:
            far = at(2.0)
            used += 1
            new = min(new, far, key=lambda t: t[0])
        elif new[0] >= simplex[-2][0]:
            new = min(new, at(-0.5), at(0.5), key=lambda t: t[0])
            used += 2
        if new[0] < simplex[-1][0]:
            simplex[-1] = new
        else:
            best = np.array(simplex[0][1])
            simplex = [simplex[0], *((fn(c), tuple(c)) for c in (best + 0.5 * (np.array(c) - best) for _, c in simplex[1:]))]
            used += len(simplex) - 1
        simplex.sort(key=lambda t: t[0])
    return np.array(simplex[0][1]), simplex[0][0]


def differenced(v: np.ndarray, period: int) -> np.ndarray:
    w = np.diff(v)
    return (w[period:] - w[:-period])[-LONGEST:]


def fit(v: np.ndarray, order, period: int):
    """(AIC, ar, ma, innovation variance) of the twice differenced series; None for one too short for the order, or with gaps.

    A series whose differences are all 0 fits exactly.
    """
    if len(v) <= period + 1:
        return None
    w, count = differenced(v, period), sum(order)
    if len(w) <= count + 2 or not np.isfinite(w).all():
        return None
    if not np.any(w):
        ar, ma = polynomials(np.zeros(count), order, period)
        return -math.inf, ar, ma, 0.0
    scale = float(np.sqrt(np.mean(w * w)))
    raw, least = (np.zeros(0), deviance(np.zeros(0), w / scale, order, period)) if not count else minimise(
        lambda r: deviance(np.clip(r, -6, 6), w / scale, order, period), np.zeros(count), TRIES * count
    )
    if not math.isfinite(least):
        return None
    ar, ma = polynomials(np.clip(raw, -6, 6), order, period)
    _, e = _innovations(w, autocovariances(ar, ma, len(w)))
    return least + 2 * len(w) * math.log(scale) + 2 * (count + 1), ar, ma, float(e @ e) / len(w)


def project(v: np.ndarray, found, period: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts of the series itself and their standard deviations."""
    _, ar, ma, variance = found
    w = differenced(v, period)
    n = len(w)
    gamma = autocovariances(ar, ma, n + steps)
    ahead = np.zeros(steps)
    if np.any(w):
        factor, e = _innovations(w, gamma[:n])
        solved = np.linalg.solve(factor.T, e)
        ahead = gamma[np.arange(n, n + steps)[:, None] - np.arange(n)[None, :]] @ solved
    levels = list(v[-period - 1 :])
    for step in ahead:
        levels.append(step + levels[-1] + levels[-period] - levels[-period - 1])
    psi, own = [], weights(ar, ma, steps)
    for h in range(steps):
        back = [psi[h - j] if h >= j else 0.0 for j in (1, period, period + 1)]
        psi.append(own[h] + back[0] + back[1] - back[2])
    return np.array(levels[period + 1 :]), np.sqrt(variance * np.cumsum(np.square(psi)))
