"""The factorization machine on a block of rows: score, loss and gradient in numpy.

A model has a bias, one linear weight per feature and ``k`` factors per feature:

    score(x) = bias + x . linear + 1/2 * sum_f [ (x . v_f)^2 - (x^2) . (v_f^2) ]

For training the parts are laid out in one flat vector: factors feature by feature, then the linear
weights, then the bias; a part that is switched off is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

REGRESSION, CLASSIFICATION = 0, 1


@dataclass(frozen=True)
class Shape:
    """Which parts a model has, and how wide they are."""

    num_features: int
    num_factors: int
    use_bias: bool = True
    use_linear: bool = True

    def __post_init__(self):
        if self.num_features <= 0 or self.num_factors <= 0:
            raise ValueError("a factorization machine needs at least one feature and one factor")

    @property
    def size(self) -> int:
        n = self.num_features
        return n * self.num_factors + (n if self.use_linear else 0) + (1 if self.use_bias else 0)

    def unpack(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Factors (features x k), linear weights and bias; parts that are off read as zero."""
        n, cut = self.num_features, self.num_features * self.num_factors
        factors = flat[:cut].reshape(n, self.num_factors)
        linear = flat[cut : cut + n] if self.use_linear else np.zeros(n)
        return factors, linear, float(flat[-1]) if self.use_bias else 0.0

    def pack(self, factors: np.ndarray, linear: np.ndarray, bias: float) -> np.ndarray:
        parts = [np.asarray(factors, dtype=float).ravel()]
        if self.use_linear:
            parts.append(np.asarray(linear, dtype=float))
        if self.use_bias:
            parts.append(np.array([float(bias)]))
        return np.concatenate(parts)

    def initial(self, std: float, seed: int) -> np.ndarray:
        """Factors drawn from N(0, std), everything else zero."""
        draws = np.random.default_rng(seed).normal(0.0, std, (self.num_features, self.num_factors))
        return self.pack(draws, np.zeros(self.num_features), 0.0)

    def penalties(self, bias: float, linear: float, factors: float) -> np.ndarray:
        """One L2 strength per entry of the flat vector."""
        n = self.num_features
        return self.pack(np.full((n, self.num_factors), factors), np.full(n, linear), bias)


def scores(x: np.ndarray, shape: Shape, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores of a block, and x . v_f for each row and factor."""
    factors, linear, bias = shape.unpack(flat)
    sums = x @ factors
    pairs = (sums**2).sum(axis=1) - (x**2) @ (factors**2).sum(axis=1)
    return bias + x @ linear + 0.5 * pairs, sums


def loss_and_gradient(
    x: np.ndarray,
    y: np.ndarray,
    shape: Shape,
    flat: np.ndarray,
    task: int,
    bounds: tuple[float, float] | None = None,
) -> tuple[float, np.ndarray]:
    """Summed loss and gradient of a block, without penalties.

    Classification: labels are +1 and -1, log-loss. Regression: half the squared error, with the
    score first clamped to ``bounds`` when they are given.
    """
    score, sums = scores(x, shape, flat)
    if task == CLASSIFICATION:
        margin = y * score
        loss = np.logaddexp(0.0, -margin).sum()
        pull = -y * np.exp(-np.logaddexp(0.0, margin))
    else:
        if bounds is not None:
            score = np.clip(score, *bounds)
        pull = score - y
        loss = 0.5 * (pull**2).sum()
    factors, _, _ = shape.unpack(flat)
    by_factor = x.T @ (sums * pull[:, None]) - factors * ((x**2).T @ pull)[:, None]
    return float(loss), shape.pack(by_factor, x.T @ pull, pull.sum())
