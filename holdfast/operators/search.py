"""A search that learns from its trials: Parzen densities of good and other points, proposals in batches."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

FIRST_TRIALS, DRAWS = 8, 24


@dataclass(frozen=True)
class Dimension:
    """A number between ``low`` and ``high``; ``kind`` is int, float or log (a float on a logarithmic scale)."""

    low: float
    high: float
    kind: str = "float"

    def to_unit(self, value: float) -> float:
        if self.kind == "log":
            return math.log(value / self.low) / math.log(self.high / self.low)
        low, width = self._span()
        return (value - low) / width

    def from_unit(self, unit: float) -> float | int:
        if self.kind == "log":
            return min(max(self.low * (self.high / self.low) ** unit, self.low), self.high)
        low, width = self._span()
        value = low + unit * width
        if self.kind == "int":
            return int(min(max(round(value), self.low), self.high))
        return value

    def _span(self) -> tuple[float, float]:
        """Whole numbers own half a step on either side."""
        half = 0.5 if self.kind == "int" else 0.0
        return self.low - half, self.high - self.low + 2 * half


class _Parzen:
    """A mixture of bells cut to [0, 1]: one at every point, as wide as the gap to its farther neighbour, and a flat share."""

    def __init__(self, points: Sequence[float]):
        self.points = sorted(points)
        edges = [0.0, *self.points, 1.0]
        narrowest = 1.0 / min(100, len(points) + 2)
        self.widths = [
            min(max(edges[i + 1] - edges[i], edges[i + 2] - edges[i + 1], narrowest), 1.0)
            for i in range(len(points))
        ]

    @staticmethod
    def _below(x: float) -> float:
        return 0.5 * (1 + math.erf(x / math.sqrt(2)))

    def draw(self, rng: random.Random) -> float:
        i = rng.randrange(len(self.points) + 1)
        if i == len(self.points):
            return rng.random()
        while True:
            x = rng.gauss(self.points[i], self.widths[i])
            if 0 <= x <= 1:
                return x

    def density(self, x: float) -> float:
        total = 1.0
        for point, width in zip(self.points, self.widths):
            inside = self._below((1 - point) / width) - self._below(-point / width)
            total += math.exp(-0.5 * ((x - point) / width) ** 2) / (width * math.sqrt(2 * math.pi) * inside)
        return total / (len(self.points) + 1)


def propose(
    space: Mapping[str, Dimension], trials: Sequence[tuple[Mapping[str, object], float]], rng: random.Random,
    first: int = FIRST_TRIALS, draws: int = DRAWS,
) -> dict[str, object]:
    """The next point to try, for higher scores.

    The first points are drawn at random. Then the best fifth of the trials and the others give a density each in every
    dimension, and of ``draws`` values from the good one that is taken where it exceeds the other most.
    """
    if len(trials) < first:
        return {name: d.from_unit(rng.random()) for name, d in space.items()}
    ranked = sorted(trials, key=lambda trial: -trial[1])
    n_good = max(1, math.ceil(0.2 * len(ranked)))
    point: dict[str, object] = {}
    for name, dimension in space.items():
        good, other = (
            _Parzen([dimension.to_unit(params[name]) for params, _ in part])
            for part in (ranked[:n_good], ranked[n_good:])
        )
        tried = [good.draw(rng) for _ in range(draws)]
        point[name] = dimension.from_unit(max(tried, key=lambda x: good.density(x) / other.density(x)))
    return point
