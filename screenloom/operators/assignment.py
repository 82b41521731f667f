"""Guides of cells by a mixture of two log-linear Poisson models whose covariates both components share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.store import written
from .regression import RIDGE, Design

STARTS = (2.0, 5.0, 20.0, 100.0)  # how many times more counts the upper component is first taken to have


BATCH, CELLS = 64, 500_000  # guides that are fitted together, and guides times strata at most
ENTRIES = 200_000  # counts of a block of guides, about


def products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different products of two columns of x, and which of them each pair of columns has."""
    some, which = np.unique((x[:, :, None] * x[:, None, :]).reshape(len(x), -1), axis=1, return_inverse=True)
    return some, which.reshape(x.shape[1], x.shape[1])


def newton(x: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], held: np.ndarray, y: np.ndarray, beta: np.ndarray, mean: np.ndarray, upper: np.ndarray, upper_y: np.ndarray, gamma: np.ndarray):
    """One step of the M step for a row of guides: `held` cells and y counts of each stratum, of which `upper` cells and upper_y counts are the upper component's; mean is exp(x beta)."""
    width = x.shape[1]
    ridge = np.full(width, RIDGE)
    ridge[0] = 0
    above = upper * mean * np.exp(gamma)[:, None]
    both = (held - upper) * mean + above
    slope, info = np.empty((len(beta), width + 1)), np.empty((len(beta), width + 1, width + 1))
    slope[:, :width], slope[:, width] = (y - both) @ x - ridge * beta, upper_y - above.sum(axis=1)
    info[:, :width, :width] = (both @ pairs[0])[:, pairs[1]] + np.diag(ridge)
    info[:, :width, width] = info[:, width, :width] = above @ x
    info[:, width, width] = above.sum(axis=1)
    move = np.clip(np.linalg.solve(info + 1e-9 * np.eye(width + 1), slope[:, :, None])[:, :, 0], -2, 2)
    return beta + move[:, :width], np.maximum(0.0, gamma + move[:, width])


def log_linear_mixture(x: np.ndarray, stratum: np.ndarray, value: np.ndarray, weight: np.ndarray, starts=STARTS, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float, float, bool]:
    """(posterior of the upper component for each entry, coefficients, log ratio of the components, share of the upper one, whether converged) of one guide."""
    post, beta, gamma, share, done = log_linear_mixtures(x, np.zeros((1, len(x))), np.zeros(len(stratum), int), stratum, value, weight, starts, rounds)
    return post, beta[0], float(gamma[0]), float(share[0]), bool(done[0])


def log_linear_mixtures(x: np.ndarray, zeros: np.ndarray, owner: np.ndarray, stratum: np.ndarray, value: np.ndarray, weight: np.ndarray, starts=STARTS, rounds: int = 200):
    """(posterior of the upper component for each entry; coefficients, log ratio of the components, share of the upper one, whether converged for each guide).

    An entry is `weight` cells of a stratum (row of x) with the same count of a guide (owner: its row of zeros); zeros (guides x strata) are cells without an
    entry. The mean count is exp(x beta) in the lower component and exp(gamma) times that in the upper one. Posteriors need the entries, the M step only
    sums over strata. All guides advance together until each stands still. Of the starts the one with the best likelihood is taken, for each guide.
    """
    (guides, size), width, pairs = zeros.shape, x.shape[1], products(x)
    cell = owner * size + stratum

    def summed(values: np.ndarray, cell: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(cell, values, n * size).reshape(n, size)

    def means(beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        line = np.clip(beta @ x.T, -30, 30)
        return line, np.exp(line)

    held, y = zeros + summed(weight, cell, guides), summed(weight * value, cell, guides)
    n = held.sum(axis=1)
    plain = np.zeros((guides, width))
    plain[:, 0] = np.log(np.maximum(y.sum(axis=1), 0.5) / n)
    at = np.arange(guides)
    for _ in range(50):
        if not len(at):
            break
        nothing = np.zeros(len(at))
        now, _ = newton(x, pairs, held[at], y[at], plain[at], means(plain[at])[1], np.zeros((len(at), size)), nothing, nothing)
        still = np.abs(now - plain[at]).max(axis=1) < 1e-9
        plain[at] = now
        at = at[~still]

    best, best_beta, best_gamma, best_share, best_done, post = np.full(guides, -np.inf), plain.copy(), np.zeros(guides), np.zeros(guides), np.zeros(guides, bool), np.zeros(len(owner))
    for times in starts:
        beta, gamma, share, done = plain.copy(), np.full(guides, np.log(times)), np.full(guides, 0.05), np.zeros(guides, bool)
        at = None
        for _ in range(rounds):
            if at is None or done[at].any():  # those that go on
                at = np.flatnonzero(~done)
                if not len(at):
                    break
                place = np.full(guides, -1)
                place[at] = np.arange(len(at))
                mine = np.flatnonzero(place[owner] >= 0)
                own, w, v = place[owner[mine]], weight[mine], value[mine]
                where = own * size + stratum[mine]
                held_at, y_at, zeros_at, wv = held[at], y[at], zeros[at], w * v
            b, g, s = beta[at], gamma[at], share[at]
            mean, odds, rise = means(b)[1], np.log(s / (1 - s)), np.expm1(g)
            of_zeros = zeros_at / (1 + np.exp(-np.clip(odds[:, None] - mean * rise[:, None], -700, 700)))
            of_entries = w / (1 + np.exp(-np.clip(odds[own] + v * g[own] - mean.ravel()[where] * rise[own], -700, 700)))
            upper = of_zeros + summed(of_entries, where, len(at))
            upper_y = np.bincount(own, of_entries * v, len(at))
            now = np.clip(upper.sum(axis=1) / n[at], 1e-9, 1 - 1e-9)
            after, ratio = newton(x, pairs, held_at, y_at, b, mean, upper, upper_y, g)
            after, ratio = newton(x, pairs, held_at, y_at, after, means(after)[1], upper, upper_y, ratio)
            change = np.maximum(np.maximum(np.abs(after - b).max(axis=1), np.abs(ratio - g)), np.abs(now - s))
            beta[at], gamma[at], share[at], done[at] = after, ratio, now, change < 1e-6
        line, mean = means(beta)
        odds, rise = np.log(share / (1 - share)), np.expm1(gamma)
        of_zeros, of_entries = odds[:, None] - mean * rise[:, None], odds[owner] + value * gamma[owner] - mean.ravel()[cell] * rise[owner]
        fit = (zeros * (np.logaddexp(0, of_zeros) - mean)).sum(axis=1) + np.bincount(owner, weight * (value * line.ravel()[cell] - mean.ravel()[cell] + np.logaddexp(0, of_entries)), guides)
        fit += n * np.log1p(-share) - RIDGE / 2 * (beta[:, 1:] ** 2).sum(axis=1)
        better = np.isneginf(best) | (fit > best + 1e-9 * np.abs(np.where(np.isneginf(best), 0, best)))
        best[better], best_beta[better], best_gamma[better], best_share[better], best_done[better] = fit[better], beta[better], gamma[better], share[better], done[better]
        mine = better[owner]
        post[mine] = 1 / (1 + np.exp(-np.clip(of_entries[mine], -700, 700)))
    return post, best_beta, best_gamma, best_share, best_done


def assign_with_covariates(guide_counts: DataFrame, made: Design, threshold: float = 0.8, starts=STARTS, rounds: int = 200, digits: int = 6) -> DataFrame:
    """(cell, guide, n, posterior) of the counts (cell, guide, n) whose posterior of the upper component reaches the threshold.

    Cells of a stratum of `made` with equal counts of a guide are one entry, added up before the shuffle; its cells without a count are one more,
    from the stratum's size, so zeros take part and are never laid out. Guides are dealt to blocks of about BATCH, fewer where they have many counts, and
    fitted together; of a guide a task holds at most as many entries as it has different (stratum, count), however many cells. Counts that are null or not
    above 0 are left out, as are cells that made doesn't place. A guide whose components can't be told apart (log ratio below 0.1) has no cells.
    """
    x, sizes = made.x, made.sizes
    placed = written(guide_counts.where("n > 0 and guide is not null").join(made.placed, "cell").select("cell", "guide", "stratum", F.col("n").cast("long").alias("n")), "guide-counts")
    entries = placed.groupBy("guide", "stratum", "n").agg(F.count("*").alias("weight"))
    facts = placed.agg(F.approx_count_distinct("guide").alias("guides"), F.count("*").alias("rows")).first()
    batch = max(1, min(BATCH, CELLS // max(1, len(x))))
    blocks = max(1, -(-facts.guides // batch), -(-facts.rows // ENTRIES))
    kind = dict(placed.dtypes)["guide"]

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        owner, names = pd.factorize(p["guide"])
        order = np.argsort(owner, kind="stable")
        p, owner = p.iloc[order], owner[order]
        bounds, parts = np.searchsorted(owner, np.arange(len(names) + 1)), []
        for lo in range(0, len(names), batch):
            hi = min(lo + batch, len(names))
            part, own = p.iloc[bounds[lo] : bounds[hi]], owner[bounds[lo] : bounds[hi]] - lo
            stratum, value, weight = part["stratum"].to_numpy(int), part["n"].to_numpy(float), part["weight"].to_numpy(float)
            zeros = np.maximum(sizes - np.bincount(own * len(x) + stratum, weight, (hi - lo) * len(x)).reshape(hi - lo, len(x)), 0)
            post, _, gamma, _, _ = log_linear_mixtures(x, zeros, own, stratum, value, weight, starts, rounds)
            kept = part[["guide", "stratum", "n"]].assign(posterior=np.round(post, digits))
            parts.append(kept[(kept["posterior"] >= threshold) & (gamma[own] >= 0.1)])
        return pd.concat(parts)

    fitted = entries.groupBy(F.pmod(F.xxhash64("guide"), F.lit(blocks)).alias("block")).applyInPandas(fit, f"guide {kind}, stratum int, n long, posterior double")
    return placed.join(fitted, ["guide", "stratum", "n"]).select("cell", "guide", "n", "posterior")
