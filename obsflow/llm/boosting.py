"""Boosted regression trees of depth two over counted cells, written out as SQL.

A cell is a combination of feature values with its number of rows and of positives, so a table of
any size is learned from exactly through its few cells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Split:
    """value of ``feature`` <= ``at``: ``low``, else ``high``; each a Split or a step."""

    feature: str
    at: int
    low: Split | float
    high: Split | float

    def sql(self) -> str:
        low, high = (x.sql() if isinstance(x, Split) else f"{x!r}D" for x in (self.low, self.high))
        return f"(CASE WHEN {self.feature} <= {self.at} THEN {low} ELSE {high} END)"

    def value(self, cells: dict[str, np.ndarray]) -> np.ndarray:
        low, high = (x.value(cells) if isinstance(x, Split) else x for x in (self.low, self.high))
        return np.where(cells[self.feature] <= self.at, low, high)


def _best(cells: dict[str, np.ndarray], features: list[str], gradient: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int) -> Split | float:
    def step(at: np.ndarray) -> float:
        return round(float(gradient[at].sum() / (curve[at].sum() + 1.0)), 6)

    def gain(at: np.ndarray) -> float:
        return gradient[at].sum() ** 2 / (curve[at].sum() + 1.0)

    found, most = None, gain(rows) + 1e-6
    for feature in features if depth else []:
        values = cells[feature]
        for at in np.unique(values[rows])[:-1]:
            low, high = rows & (values <= at), rows & (values > at)
            if gain(low) + gain(high) > most:
                found, most = (feature, int(at), low, high), gain(low) + gain(high)
    if found is None:
        return step(rows)
    feature, at, low, high = found
    return Split(feature, at, *(_best(cells, features, gradient, curve, x, depth - 1) for x in (low, high)))


def boost(cells: dict[str, np.ndarray], features: list[str], rows: np.ndarray, positives: np.ndarray, rounds: int = 25, rate: float = 0.4) -> tuple[float, list[Split | float]]:
    """(log odds to start from, trees) of logistic boosting with Newton steps."""
    total, good = float(rows.sum()), float(positives.sum())
    base = round(float(np.log((good + 0.5) / (total - good + 0.5))), 6)
    score, trees = np.full(len(rows), base), []
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-score))
        tree = _best(cells, features, positives - rows * chance, rows * chance * (1 - chance), np.ones(len(rows), dtype=bool), 2)
        trees.append(tree)
        score = score + rate * (tree.value(cells) if isinstance(tree, Split) else tree)
    return base, trees


def score_of(base: float, trees: list[Split | float], cells: dict[str, np.ndarray], rate: float = 0.4) -> np.ndarray:
    parts = [t.value(cells) if isinstance(t, Split) else t for t in trees]
    return base + rate * sum(parts, np.zeros(len(next(iter(cells.values())))))


def sql_of(base: float, trees: list[Split | float], rate: float = 0.4) -> str:
    parts = [t.sql() if isinstance(t, Split) else f"{t!r}D" for t in trees]
    return f"({base!r}D + {rate!r}D * (" + " + ".join(parts or ["0D"]) + "))"
