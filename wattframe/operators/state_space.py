"""Seasonal ARIMA by exact maximum likelihood: state-space form, Kalman recursion, simplex search.

The differenced series w follows (1 - aB)(1 - sB^12) w = (1 + mB)(1 + gB^12) e with normal shocks e. The state's first component
is w itself, and the others are what past values and shocks add to the values to come, so that the transition is a
companion matrix. The recursion starts from the stationary distribution; its one-step errors and their variances give
the exact likelihood of the series, with the shocks' variance concentrated out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

SEASON = 12
#: ARMA orders (p, q) and seasonal ones, after one plain and one seasonal difference of the logs.
ORDERS = [((0, 1), (0, 1)), ((1, 0), (0, 1)), ((1, 1), (0, 1)), ((0, 1), (1, 0))]
#: Weights stay inside this distance from zero: values stationary, shocks invertible.
MOST_WEIGHT = 0.99


def polynomials(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of past values and of past shocks, by lag from 1, of (a, s, m, g): products of a plain and a seasonal polynomial."""
    a, s, m, g = weights
    values, shocks = np.zeros(SEASON + 1), np.zeros(SEASON + 1)
    values[0], values[SEASON - 1], values[SEASON] = a, s, -a * s
    shocks[0], shocks[SEASON - 1], shocks[SEASON] = m, g, m * g
    return values, shocks


@dataclass
class StateSpace:
    """state' = transition @ state + load * shock; a value is the first component."""

    transition: np.ndarray
    load: np.ndarray

    @classmethod
    def of(cls, weights: np.ndarray) -> StateSpace:
        values, shocks = polynomials(weights)
        size = SEASON + 2
        transition = np.eye(size, k=1)
        transition[: len(values), 0] = values
        return cls(transition, np.r_[1.0, shocks])

    def stationary(self) -> np.ndarray:
        """Covariance of the state in the long run: the sum of all past shocks', by doubling."""
        total, power = np.outer(self.load, self.load), self.transition
        for _ in range(60):
            more = power @ total @ power.T
            total = total + more
            if np.abs(more).max() <= 1e-15 * np.abs(total).max():
                break
            power = power @ power
        return total

    def filter(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One-step errors, their variances in units of the shocks', and the state after the last value."""
        state, spread = np.zeros(len(self.load)), self.stationary()
        added = np.outer(self.load, self.load)
        errors, sizes = np.empty(len(w)), np.empty(len(w))
        t = self.transition
        for k, x in enumerate(w):
            errors[k], sizes[k] = x - state[0], spread[0, 0]
            gain = spread[:, 0] / sizes[k]
            state = t @ (state + gain * errors[k])
            spread = t @ (spread - np.outer(gain, spread[0])) @ t.T + added
        return errors, sizes, state

    def ahead(self, state: np.ndarray, steps: int) -> np.ndarray:
        """Expected values from the state before the next value on."""
        out = np.empty(steps)
        for k in range(steps):
            out[k] = state[0]
            state = self.transition @ state
        return out


def log_likelihood(w: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Log likelihood of w at the best variance of the shocks, and that variance."""
    errors, sizes, _ = StateSpace.of(weights).filter(w)
    variance = max(float((errors * errors / sizes).mean()), 1e-300)
    n = len(w)
    return -0.5 * (n * np.log(2 * np.pi * variance) + float(np.log(sizes).sum()) + n), variance


def simplex(loss: Callable[[np.ndarray], float], start: np.ndarray, width: float = 0.4, tolerance: float = 1e-6, most: int = 400) -> tuple[np.ndarray, float]:
    """Least loss by a simplex that is reflected, stretched, and drawn in (Nelder and Mead), and started once anew where it ended."""
    best, low = start, loss(start)
    for _ in range(2):
        points = np.vstack([best, best + width * np.eye(len(best))])
        found = np.array([low, *map(loss, points[1:])])
        for _ in range(most):
            order = np.argsort(found, kind="stable")
            points, found = points[order], found[order]
            if found[-1] - found[0] <= tolerance:
                break
            middle = points[:-1].mean(axis=0)
            there = 2 * middle - points[-1]
            value = loss(there)
            if value < found[0]:
                further = 3 * middle - 2 * points[-1]
                more = loss(further)
                points[-1], found[-1] = (further, more) if more < value else (there, value)
            elif value < found[-2]:
                points[-1], found[-1] = there, value
            else:
                inner = (middle + (there if value < found[-1] else points[-1])) / 2
                more = loss(inner)
                if more < min(value, found[-1]):
                    points[-1], found[-1] = inner, more
                else:
                    points[1:] = (points[1:] + points[0]) / 2
                    found[1:] = [loss(p) for p in points[1:]]
        best, low = points[0], float(found[0])
        width /= 4
    return best, low


@dataclass
class Fitted:
    weights: np.ndarray
    likelihood: float
    variance: float
    aicc: float


def fit(w: np.ndarray, orders: tuple[tuple[int, int], tuple[int, int]]) -> Fitted:
    """Maximum likelihood over the weights that the orders ask for; the search is free, its points are mapped inside the bounds."""
    (p, q), (ps, qs) = orders
    free = np.array([p, ps, q, qs], dtype=bool)

    def weights(point: np.ndarray) -> np.ndarray:
        out = np.zeros(4)
        out[free] = MOST_WEIGHT * np.tanh(point)
        return out

    # Past values start at a little positive, shocks at a little negative weight: the usual signs of differenced series.
    start = np.array([0.2, 0.2, -0.4, -0.4])[free]
    best, _ = simplex(lambda x: -log_likelihood(w, weights(x))[0], start)
    likelihood, variance = log_likelihood(w, weights(best))
    n, k = len(w), int(free.sum()) + 1
    return Fitted(weights(best), likelihood, variance, -2 * likelihood + 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1))


def arima(values: np.ndarray, last: int, horizons: int = SEASON) -> np.ndarray:
    """Forecasts of the orders of least AICc, on logs with one plain and one seasonal difference."""
    y = np.log(values)
    w = np.diff(y[SEASON:] - y[:-SEASON])
    best = min((fit(w, orders) for orders in ORDERS), key=lambda f: f.aicc)
    model = StateSpace.of(best.weights)
    path = list(y)
    for d in model.ahead(model.filter(w)[2], horizons):
        path.append(path[-1] + path[-SEASON] - path[-SEASON - 1] + d)
    return np.exp(path[-horizons:])
