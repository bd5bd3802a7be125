"""Forecast models over one training window: predict(values, month number of the last value) -> 12 forecasts.

Plain numpy on 72 numbers; Spark runs them per origin and series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

#: Exponential smoothing: trend (none or damped), season (additive or multiplicative).
SMOOTHING = [(trend, season) for trend in (False, True) for season in ("add", "mul")]


def smoothing(values: np.ndarray, last: int) -> np.ndarray:
    """The specification of least AICc, fitted by a coordinate search over its smoothing weights."""
    best = None
    for trend, season in SMOOTHING:
        step = np.array([0.3, 0.1, 0.1, 0.95] if trend else [0.3, 0.1])
        score, forecast = _smooth(values, step, trend, season)
        width = 0.15
        while width > 0.01:
            moved = False
            for k in range(len(step)):
                for d in (-width, width):
                    trial = step.copy()
                    trial[k] = np.clip(trial[k] + d, 0.01, 0.99)
                    s2, f2 = _smooth(values, trial, trend, season)
                    if s2 < score:
                        step, score, forecast, moved = trial, s2, f2, True
            if not moved:
                width /= 2
        n, k = len(values), len(step) + 13 + 2 * trend
        aicc = n * np.log(score / n) + 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1)
        if best is None or aicc < best[0]:
            best = (aicc, forecast)
    return best[1]


def _smooth(y: np.ndarray, weights: np.ndarray, trend: bool, season: str) -> tuple[float, np.ndarray]:
    """Sum of squared one-step errors and 12 forecasts."""
    a, g = weights[0], weights[1]
    b, phi = (weights[2], weights[3]) if trend else (0.0, 0.0)
    multiply = season == "mul"
    level, slope = y[:12].mean(), (y[12:24].mean() - y[:12].mean()) / 12 if trend else 0.0
    seasons = list(y[:12] / level if multiply else y[:12] - level)
    loss = 0.0
    for t in range(12, len(y)):
        s, base = seasons[t - 12], level + phi * slope
        error = y[t] - (base * s if multiply else base + s)
        loss += error * error
        level = base + a * (error / s if multiply and s else error)
        slope = phi * slope + (b * a * (error / s if multiply and s else error) if trend else 0.0)
        seasons.append(s + g * (error / base if multiply and base else error))
    damp = np.cumsum(phi ** np.arange(1, 13)) if trend else np.zeros(12)
    ahead = level + slope * damp
    tail = np.array(seasons[-12:])
    return max(loss, 1e-9), ahead * tail if multiply else ahead + tail


def autoregression(values: np.ndarray, last: int) -> np.ndarray:
    """Seasonal autoregressions on differenced logs, conditional least squares, the specification of least AICc."""
    y = np.log(np.maximum(values, 1e-9))
    best = None
    for p, ps in ((1, 0), (2, 0), (1, 1), (2, 1)):
        d = y[12:] - y[:-12]
        lags = [*range(1, p + 1), *[12 * k for k in range(1, ps + 1)]]
        start = max(lags)
        x = np.c_[np.ones(len(d) - start), *[d[start - k : len(d) - k] for k in lags]]
        target = d[start:]
        beta = np.linalg.lstsq(x, target, rcond=None)[0]
        loss = max(float(((target - x @ beta) ** 2).sum()), 1e-12)
        n, k = len(target), len(beta) + 1
        aicc = n * np.log(loss / n) + 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1)
        if best is None or aicc < best[0]:
            history, path = list(d), list(y)
            for _ in range(12):
                history.append(beta[0] + sum(b * history[-k] for b, k in zip(beta[1:], lags, strict=True)))
                path.append(path[-12] + history[-1])
            best = (aicc, np.exp(path[-12:]))
    return best[1]


def ridge(values: np.ndarray, last: int, penalty: float = 1.0, business: np.ndarray | None = None) -> np.ndarray:
    """Logs on a trend, month dummies and log days of the month; standardised, intercept free of penalty.

    business: the business days of the window's months and of the twelve after them; their logs are one more column.
    """
    months = last + np.arange(-len(values) + 1, 13)
    days = np.array([pd.Period(year=m // 12, month=m % 12 + 1, freq="M").days_in_month for m in months])
    x = np.c_[(months - last) / 12.0, *[(months % 12 == k).astype(float) for k in range(1, 12)], np.log(days)]
    if business is not None:
        x = np.c_[x, np.log(np.maximum(business, 1))]
    train = x[: len(values)]
    mean, sd = train.mean(axis=0), train.std(axis=0, ddof=1)
    sd[sd == 0] = 1
    z, y = (x - mean) / sd, np.log(values)
    zt = z[: len(values)]
    beta = np.linalg.solve(zt.T @ zt + penalty * np.eye(z.shape[1]), zt.T @ (y - y.mean()))
    return np.exp(y.mean() + z[len(values) :] @ beta)


def boosted(values: np.ndarray, last: int, rounds: int = 60, rate: float = 0.1) -> np.ndarray:
    """Boosted stumps on the yearly log ratio, features known a year ahead: last ratios and the month."""
    y = np.log(values)
    ratio = y[12:] - y[:-12]
    rows = np.arange(12, len(ratio))
    feats = lambda t: np.c_[ratio[t - 12], [ratio[max(0, k - 15) : k - 11].mean() for k in t], (t % 12).astype(float)]
    x, target = feats(rows), ratio[rows]
    ahead = np.arange(len(ratio), len(ratio) + 12)
    xf, fit, out = feats(ahead), np.full(len(rows), target.mean()), np.full(12, target.mean())
    for _ in range(rounds):
        rest, best = target - fit, None
        for f in range(x.shape[1]):
            for cut in np.quantile(x[:, f], [0.2, 0.4, 0.6, 0.8]):
                left = x[:, f] <= cut
                if 4 <= left.sum() <= len(rows) - 4:
                    a, b = rest[left].mean(), rest[~left].mean()
                    gain = left.sum() * a * a + (~left).sum() * b * b
                    if best is None or gain > best[0]:
                        best = (gain, f, cut, a, b)
        if best is None:
            break
        _, f, cut, a, b = best
        fit += rate * np.where(x[:, f] <= cut, a, b)
        out += rate * np.where(xf[:, f] <= cut, a, b)
    return values[-12:] * np.exp(out)
