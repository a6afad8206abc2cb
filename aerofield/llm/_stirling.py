"""Numbers of tables of a Pitman-Yor restaurant's words, drawn exactly.

A word with c customers sits at t tables with a weight of S(c, t) z^t, where S are the generalised
Stirling numbers of the discount d.  For few customers they come from their recurrence.  For more,
from their sum S(c, t) = 1 / (t! d^t) * sum over j of (-1)^j C(t, j) Gamma(c - d j) / Gamma(-d j), over the
numbers of tables around the likeliest one that can matter in double precision; past c^d tables,
where the sum's terms cancel, from the saddle point of its generating function, (1 - (1 - z)^d)^t.
"""

from __future__ import annotations

import math

import numpy as np

#: Customers up to which the recurrence is used.
EXACT = 256
#: Numbers of weights that are worked out at once.
AT_ONCE = 1 << 20
#: Terms of the sum at most.
TERMS = 72

_TABLES: dict[float, np.ndarray] = {}


def recurrence(discount: float, most: int = EXACT) -> np.ndarray:
    """ln S(c, t) for c and t up to ``most``."""
    if (discount, most) not in _TABLES:
        s = np.full((most + 1, most + 1), -np.inf)
        s[0, 0] = 0.0
        t = np.arange(1, most + 1)
        for c in range(most):
            with np.errstate(divide="ignore", invalid="ignore"):
                stay = np.where(t <= c, np.log(np.maximum(c - discount * t, 1e-300)) + s[c, 1:], -np.inf)
            s[c + 1, 1:] = np.logaddexp(s[c, :-1], stay)
        _TABLES[discount, most] = s
    return _TABLES[discount, most]


def _by_sum(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    out, term = np.zeros(t.shape), np.ones(t.shape)
    z = c[:, None]
    for j in range(1, TERMS + 1):
        # from Gamma(z) to Gamma(z - d), by Stirling's series
        z_next = z - discount
        term = term * (t - j + 1) / j * np.exp((z_next - 0.5) * np.log1p(-discount / z) - discount * np.log(z) + discount + (1 / z_next - 1 / z) / 12)
        z = z_next
        x = discount * j
        if abs(x - round(x)) > 1e-9:
            add = (-1) ** j / math.gamma(-x) * term
            out += add
            if j > 3 and (np.abs(add) <= 1e-16 * np.abs(out)).all():
                break
    return np.log(np.maximum(out, 1e-300))


def _by_saddle_point(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    c = c[:, None]
    t = np.minimum(t, c - 1)
    y = np.minimum(np.log(discount * t / c) / (1 - discount), -1e-3)  # ln of 1 minus the saddle point
    for _ in range(30):
        s, sd = np.exp(y), np.exp(discount * y)
        off = math.log(discount) + np.log(-np.expm1(y)) + (discount - 1) * y - np.log(-np.expm1(discount * y)) - np.log(c / t)
        step = off / (-s / -np.expm1(y) + discount - 1 + discount * sd / -np.expm1(discount * y))
        y = np.clip(y - step, np.maximum(y * 4, -200), y / 4)
        if (np.abs(step) < 1e-12 * np.abs(y)).all():
            break
    z = -np.expm1(y)
    spread = c * (1 + (1 - discount) * z / np.exp(y) - c / t)
    return np.log(c) + t * np.log(-np.expm1(discount * y)) - c * np.log(z) - 0.5 * np.log(2 * math.pi * np.maximum(spread, 1e-9))


def log_weight(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """ln of t! d^t S(c, t) / Gamma(c) for rows of t, one row for each c above `EXACT`."""
    c, t = c.astype(float), t.astype(float)
    near = t <= c[:, None] ** discount
    out = np.empty(t.shape)
    for rows, f, fit in ((near.any(axis=1), _by_sum, np.minimum), (~near.all(axis=1), _by_saddle_point, np.maximum)):
        if rows.any():
            got = f(c[rows], fit(t[rows], c[rows, None] ** discount), discount)
            here = near[rows] if f is _by_sum else ~near[rows]
            part = out[rows]
            part[here] = got[here]
            out[rows] = part
    return out


def _drawn(weights: np.ndarray, first: np.ndarray, u: np.ndarray) -> np.ndarray:
    p = np.cumsum(np.exp(weights - weights.max(axis=1, keepdims=True)), axis=1)
    return first + (p < u[:, None] * p[:, -1:]).sum(axis=1)


def _many(c: np.ndarray, rate: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """Draws for more than `EXACT` customers; ``rate`` is z / d."""
    most = np.minimum(c, np.floor(rate + 10 * np.sqrt(rate) + 40)).astype(np.int64)
    lo, hi = np.ones(len(c), np.int64), most.copy()
    while (lo < hi).any():  # the likeliest number of tables
        at = (lo + hi) >> 1
        w = log_weight(c, np.column_stack([at, np.minimum(at + 1, c)]), discount)
        up = np.log(rate / (at + 1)) + w[:, 1] > w[:, 0]
        lo, hi = np.where(up & (lo < hi), at + 1, lo), np.where(~up, at, hi)
    half = np.ceil(8 * np.sqrt(lo) + 12).astype(np.int64)
    out = np.empty(len(c), np.int64)
    order = np.argsort(half, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * (2 * half[order[to]] + 1) <= AT_ONCE:
            to += 1
        some = order[at:to]
        first = np.maximum(1, lo[some] - half[some])
        t = first[:, None] + np.arange(2 * half[some[-1]] + 1)
        w = np.cumsum(np.log(rate[some, None] / t), axis=1) + log_weight(c[some], np.minimum(t, c[some, None]), discount)
        out[some] = _drawn(np.where(t <= most[some, None], w, -np.inf), first, u[some])
        at = to
    return out


def draw_tables(c: np.ndarray, rate: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """A number of tables for each of c customers, with weights S(c, t) (discount * rate)^t, from uniform numbers u."""
    out = np.minimum(c, 1)
    some = np.flatnonzero(c > 1)
    some = some[np.argsort(c[some], kind="stable")]
    few = some[: np.searchsorted(c[some], EXACT, "right")]
    logs, n = recurrence(discount), c[few]
    for at in np.split(few, np.flatnonzero(np.diff(n)) + 1):
        if len(at):
            m = int(c[at[0]])
            t, step = np.arange(1, m + 1), max(1, AT_ONCE // m)
            for k in range(0, len(at), step):
                rows = at[k : k + step]
                out[rows] = _drawn(np.log(discount * rate[rows])[:, None] * t + logs[m, 1 : m + 1], np.ones(len(rows), np.int64), u[rows])
    rest = some[len(few) :]
    if len(rest):
        out[rest] = _many(c[rest], rate[rest], u[rest], discount)
    return out
