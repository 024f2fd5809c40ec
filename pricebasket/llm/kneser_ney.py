"""Formulas of interpolated modified Kneser-Ney smoothing."""

from __future__ import annotations

import numpy as np


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the numbers of n-grams seen once, twice, three and four times.

    Where a number is 0 (tiny or peculiar corpora), the estimate is undefined and 0.5, 1 and 1.5
    stand in; each discount is kept within 0.05 and its count.
    """
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(min(max(d, 0.05), k)) for k, d in enumerate(found, 1))


def discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    """Each count less the discount of its class; 0 stays 0."""
    return counts - np.array([0.0, *by])[np.minimum(counts, 3).astype(np.int64)]


def count_classes(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]
