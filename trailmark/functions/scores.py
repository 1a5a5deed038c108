"""Scoring expressions: ratios, z-scores, confidences, divergence terms."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(n: Column, base: Column) -> Column:
    """n / base, and 0 where there is no positive base."""
    return F.when(base > 0, n / base).otherwise(F.lit(0.0))


def robust_z(n: Column, median: Column, mad: Column, epsilon: float = 0.01) -> Column:
    spread = mad + F.lit(epsilon)
    return F.when(spread != 0, (n - median) / spread).otherwise(F.lit(0.0))


def spike_confidence(
    z: Column,
    ratio: Column,
    z_threshold: float = 3.5,
    ratio_threshold: float = 10.0,
    curve: str = "gentle",
) -> Column:
    """Logistic score of how far a spike lies beyond its thresholds.

    ``gentle``: both parts bounded by 10, slope 1 around 1.
    ``steep``: z part unbounded, slope 5 around 0.5.
    """
    if curve not in ("gentle", "steep"):
        raise ValueError(f"unknown curve: {curve}")
    z_part = F.abs(F.coalesce(z, F.lit(0.0))) / max(z_threshold, 1.0)
    ratio_part = F.least(F.coalesce(ratio, F.lit(0.0)) / max(ratio_threshold, 1.0), F.lit(10.0))
    if curve == "gentle":
        z_part, slope, centre = F.least(z_part, F.lit(10.0)), 1.0, 1.0
    else:
        slope, centre = 5.0, 0.5
    combined = (z_part + ratio_part) / 2
    return 1 / (1 + F.exp(-slope * (combined - centre)))


def mix_confidence(changed: Column, change: Column, rule: str = "interpolated") -> Column:
    """0.9 for a new top referrer, otherwise a score of the share change."""
    if rule == "interpolated":
        score = F.least(0.5 + 0.5 * (change - 0.2) / 0.8, F.lit(1.0))
    elif rule == "proportional":
        score = F.least(change / 0.5, F.lit(1.0))
    else:
        raise ValueError(f"unknown rule: {rule}")
    return F.when(changed, F.lit(0.9)).otherwise(score)


def divergence_term(p: Column, q: Column) -> Column:
    """p * ln(p / m) with m the mean of p and q; 0 where p is 0."""
    return F.when(p > 0, p * F.ln(2 * p / (p + q))).otherwise(F.lit(0.0))


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two equally long arrays of numbers."""
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def edge_outlier_confidence(distance: Column, threshold: float) -> Column:
    """0.5 at the threshold, towards 1 far beyond it."""
    return F.when(distance > 0, 1 - 0.5 * (F.lit(threshold) / distance)).otherwise(F.lit(0.5))
