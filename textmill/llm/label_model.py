"""Generative model of noisy voters, fitted by expectation-maximisation, and a linear scorer that learns from its posterior labels."""

from __future__ import annotations

import numpy as np


class LabelModel:
    """Two classes, voters that vote 0 or 1 or abstain (-1).

    Each voter has a table of vote probabilities for either class. Voters are not taken as independent: after every round the correlation of each two voters within a class is estimated from the expected counts, and a voter's evidence is divided by one plus its correlations with those that vote alike, so that ten copies of a voter count about as one. Fitting needs only the distinct vote patterns and their counts, whose number does not grow with the rows.
    """

    def __init__(self, n_voters: int, prior: float = 0.5, smoothing: float = 1.0, floor: float = 0.5):
        """floor: correlation within a class that is not yet taken for a shared mistake. 0 suits voters that look at one thing in several ways and classes that lie far apart."""
        self.n, self.smoothing, self.floor = n_voters, smoothing, floor
        self.prior = prior
        self.tables = np.zeros((n_voters, 2, 3))
        self.correlations = np.eye(n_voters)

    def fit(self, patterns: np.ndarray, counts: np.ndarray, start: np.ndarray, *, rounds: int = 60) -> LabelModel:
        """patterns: (rows, voters); start: first guess of P(class 1) for each pattern, which says which class is which."""
        counts = counts.astype(float)
        q = np.clip(start, 0.02, 0.98)
        one_hot = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
        for _ in range(rounds):
            mass = np.stack([counts * (1 - q), counts * q], 1)  # (rows, class)
            self.prior = float((mass[:, 1].sum() + 1) / (mass.sum() + 2))
            self.tables = np.einsum("rc,rnv->ncv", mass, one_hot) + self.smoothing
            self.tables /= self.tables.sum(2, keepdims=True)
            self._correlate(one_hot, mass)
            new = self.posterior(patterns)
            moved = np.abs(new - q).max()
            q = new
            if moved < 1e-6:
                break
        return self

    def flip(self) -> None:
        """The classes change places."""
        self.tables, self.prior = self.tables[:, ::-1], 1 - self.prior

    def _correlate(self, one_hot: np.ndarray, mass: np.ndarray) -> None:
        shared = np.zeros((self.n, self.n))
        value = one_hot[:, :, 2] - one_hot[:, :, 1]
        for c in range(2):
            w = mass[:, c] / max(mass[:, c].sum(), 1e-9)
            centred = value - w @ value
            cov = (centred * w[:, None]).T @ centred
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            shared += np.clip(cov / np.outer(sd, sd), 0, 1) / 2
        # voters that all but repeat each other are one voter, whatever the classes: the classes may have been made after them
        every = mass.sum(1) / mass.sum()
        centred = value - every @ value
        cov = (centred * every[:, None]).T @ centred
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        raw = cov / np.outer(sd, sd)
        shared = np.where(raw > 0.95, np.maximum(shared, raw), shared)
        shared = np.clip((shared - self.floor) / (1 - self.floor), 0, 1)
        np.fill_diagonal(shared, 1)
        self.correlations = shared

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(class 1) for each row of votes."""
        log = np.log(self.tables)
        ratio = log[:, 1] - log[:, 0]  # (voters, votes)
        # voters that vote alike and are correlated speak about once together; independent voters add up
        alike = (patterns[:, :, None] == patterns[:, None, :]) * self.correlations
        evidence = (ratio[np.arange(self.n), patterns + 1] / alike.sum(2)).sum(1)
        return 1 / (1 + np.exp(-np.clip(np.log(self.prior / (1 - self.prior)) + evidence, -30, 30)))

    def accuracies(self) -> np.ndarray:
        """P(vote right | voted) of each voter."""
        t, p = self.tables, self.prior
        right, wrong = p * t[:, 1, 2] + (1 - p) * t[:, 0, 1], p * t[:, 1, 1] + (1 - p) * t[:, 0, 2]
        return right / np.maximum(right + wrong, 1e-12)


def feature_scores(a: np.ndarray, b: np.ndarray, total_a: float, total_b: float) -> np.ndarray:
    """How many standard errors apart the log odds of features are that stand in a rows of total_a in one class and in b of total_b in the other; 0 for those in fewer than three rows."""
    a_, b_ = a + 0.5, b + 0.5
    rest_a, rest_b = total_a - a + 0.5, total_b - b + 0.5
    odds = np.log(b_ / rest_b) - np.log(a_ / rest_a)
    return np.where(a + b >= 3, odds / np.sqrt(1 / a_ + 1 / b_ + 1 / rest_a + 1 / rest_b), 0.0)


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, bins: int, *, epochs: int = 12, rate: float = 0.3, l2: float = 1e-5, balance: bool = True, seed: int = 7) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by adaptive gradient steps over rows of (bins, values); deterministic for the order of rows and the seed."""
    w, g2, bias, gb = np.zeros(bins), np.full(bins, 1e-2), 0.0, 1e-2
    share = min(max(float(target.mean()), 1e-3), 1 - 1e-3) if len(target) else 0.5
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            y = target[i]
            p = 1 / (1 + np.exp(-np.clip(bias + w[at] @ v, -30, 30)))
            weight = (y / (2 * share) + (1 - y) / (2 * (1 - share))) if balance else 1.0
            e = (p - y) * weight
            g = e * v + l2 * w[at]
            g2[at] += g * g
            w[at] -= rate * g / np.sqrt(g2[at])
            gb += e * e
            bias -= rate * e / np.sqrt(gb)
    return w, float(bias)
