"""Chinese-restaurant seating of a hierarchical Pitman-Yor model, for many words at once.

All customers of a word are taken out of a restaurant and seated anew: a Gibbs step over a block. Of n customers, beside
K tables of the other words, with probability p of the word in the parent, t tables have the conditional probability

    S(n, t) * p^t * (s + d K) (s + d (K + 1)) ... (s + d (K + t - 1))   up to a factor without t,

S being the generalised Stirling numbers of the discount d. ``draw`` takes t from it exactly up to ``EXACT`` customers and
from a normal distribution about its mode for more. Random numbers are hashes of word, restaurant and sweep, so a sweep is the same
wherever it runs and however often.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.tokens import mix

EXACT = 1024                # customers up to which the tables are drawn from their conditional probabilities
_CELLS = 1 << 18
STRENGTHS = (1.0, 1.0, 1.0)


def uniform(seeds: np.ndarray, step: int, sweep: int) -> np.ndarray:
    salt = (step * 0x9E3779B97F4A7C15 + sweep * 0xD1B54A32D192ED03) & ((1 << 64) - 1)
    return (mix(seeds ^ np.uint64(salt)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


class Stirling:
    """Logarithms of the generalised Stirling numbers S(n, t) of a discount, t from 1 to n, worked out as far as asked."""

    def __init__(self, discount: float) -> None:
        self.discount, self.rows = discount, [np.zeros(0), np.zeros(1)]

    def __getitem__(self, n: int) -> np.ndarray:
        while len(self.rows) <= n:
            last, have = self.rows[-1], len(self.rows) - 1
            row = np.full(have + 1, -np.inf)
            row[1:] = last
            row[:-1] = np.logaddexp(row[:-1], last + np.log(have - self.discount * np.arange(1, have + 1)))
            self.rows.append(row)
        return self.rows[n]


def draw(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float,
         stirling: Stirling, seeds: np.ndarray, sweep: int) -> np.ndarray:
    """Numbers of tables of blocks of customers, given the tables of the other words and the probability in the parent."""
    discount = stirling.discount
    out = (customers > 0).astype(np.int64)
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        out[many] = draw_near(customers[many], others[many], parent[many], strength, discount, seeds[many], sweep)
    some = np.flatnonzero((customers > 1) & (customers <= EXACT))
    some = some[np.argsort(customers[some], kind="stable")]
    sizes, first = np.unique(customers[some], return_index=True)
    u = uniform(seeds[some], 0, sweep)
    for n, lo, end in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(some)]):
        step = max(1, _CELLS // n)
        for at in range(lo, end, step):
            stop = min(at + step, end)
            block, t = some[at:stop], np.arange(1, n + 1)
            chance = np.cumsum(np.log(strength + discount * (others[block, None] + (t - 1))), axis=1)
            chance += stirling[n] + np.log(parent[block, None]) * t
            reached = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            out[block] = 1 + (reached < (u[at:stop] * reached[:, -1])[:, None]).sum(axis=1)
    return out


def draw_near(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float, discount: float,
              seeds: np.ndarray, sweep: int) -> np.ndarray:
    """Like ``draw`` for many customers, from a normal distribution about the mode of the conditional probabilities.

    S(n, t) t! d^t / n! is the n-th coefficient of (1 - (1-x)^d)^t; its saddle point x, in the terms of e = -log(1-x), is
    where t = n (1 - exp(-de)) exp(-(1-d)e) / (d (1 - exp(-e))), and log S then falls by log(dt) - log(1 - exp(-de)) with t.
    """
    def at(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tables at the saddle point, and the slope of the log probability there."""
        t = customers * -np.expm1(-discount * e) * np.exp(-(1 - discount) * e) / (discount * -np.expm1(-e))
        return t, (np.log(-np.expm1(-discount * e)) + np.log((strength + discount * (others + t)) * parent)
                   - np.log(discount * np.maximum(t, 1e-300)))

    low, high = np.full(len(customers), np.log(1e-9)), np.full(len(customers), np.log(700.0))
    for _ in range(60):
        middle = (low + high) / 2
        rising = at(np.exp(middle))[1] > 0
        low, high = np.where(rising, low, middle), np.where(rising, middle, high)
    e = np.exp((low + high) / 2)
    (t, _), (t1, slope1), (t2, slope2) = at(e), at(e * 0.999), at(e * 1.001)
    spread = np.sqrt(np.maximum((t1 - t2) / np.maximum(slope2 - slope1, 1e-300), 0))
    normal = np.sqrt(-2 * np.log(uniform(seeds, 1, sweep))) * np.cos(2 * np.pi * uniform(seeds, 2, sweep))
    return np.clip(np.rint(t + 0.5 + spread * normal), 1, customers).astype(np.int64)


def look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted values in sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted
