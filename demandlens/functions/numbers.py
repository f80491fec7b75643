"""Numeric cells, missing values, risk tiers and the linear scorer."""

from pyspark.sql import functions as F

from ..fixed_values import TIER_BOUNDS, UNKNOWN_TIER

_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def number_or_null(cell):
    """Text to double; whatever is not a plain number becomes null."""
    text = F.trim(cell.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def nan_to_null(value):
    return F.when(~F.isnan(value), value)


def risk_tier(probability):
    """Tier of a probability; null or NaN is the unknown tier."""
    known = F.when(probability.isNull() | F.isnan(probability), UNKNOWN_TIER)
    for tier, bound in TIER_BOUNDS:
        known = known.when(probability >= bound, tier) if bound is not None else known.otherwise(tier)
    return known


def logistic(intercept, weights):
    """Probability expression from a dict column -> weight (plain columns only)."""
    z = F.lit(float(intercept))
    for column, weight in weights.items():
        z = z + F.col(column).cast("double") * float(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
