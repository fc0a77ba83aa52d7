"""D3: number of bands and rows per band for a similarity threshold.

A pair of similarity s shares a band of r rows with probability
1 - (1 - s**r)**b.  Below the threshold that is a false positive, above it its
complement is a false negative; the best (b, r) has the least weighted sum of
the two areas under the curve.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def band_errors(threshold: float, bands: int, rows: int) -> tuple[float, float]:
    """(area of false positives, area of false negatives)."""
    x, w = np.polynomial.legendre.leggauss(64)

    def area(lo: float, hi: float, f) -> float:
        return float((hi - lo) / 2 * (w * f((hi - lo) / 2 * x + (hi + lo) / 2)).sum())

    def missed(s: np.ndarray) -> np.ndarray:
        return (1 - s**rows) ** bands

    return area(0.0, threshold, lambda s: 1 - missed(s)), area(threshold, 1.0, missed)


@functools.cache
def band_parameters(threshold: float, num_perm: int, weight: float = 0.5) -> tuple[int, int]:
    """The (bands, rows) of at most ``num_perm`` values with the least error; ``weight`` is that of false positives."""
    if not 0 < threshold <= 1 or num_perm < 1:
        raise ValueError("a threshold in (0, 1] and at least one permutation are needed")

    def error(shape: tuple[int, int]) -> float:
        positive, negative = band_errors(threshold, *shape)
        return weight * positive + (1 - weight) * negative

    shapes = [(b, r) for b in range(1, num_perm + 1) for r in range(1, num_perm // b + 1)]
    return min(shapes, key=lambda shape: (error(shape), shape))


def candidate_probability(similarity: Column, bands: int, rows: int) -> Column:
    """The probability that a pair of that similarity shares a band."""
    return 1 - F.pow(1 - F.pow(similarity, F.lit(float(rows))), F.lit(float(bands)))
