"""Bands of discount rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed upper bounds of the discount bands and their labels.
DISCOUNT_BANDS = (
    (0.05, "0–5%"),
    (0.10, "5–10%"),
    (0.15, "10–15%"),
    (0.20, "15–20%"),
    (0.26, "20–26%"),
    (1.0, "26%+"),
)
LOWEST_RATE = -0.001


def discount_bucket(rate: Column) -> Column:
    """Label of the band a rate falls in, null outside all bands."""
    rate = rate.cast("double")
    label = F.when(rate <= LOWEST_RATE, None)
    for upper, name in DISCOUNT_BANDS:
        label = label.when(rate <= upper, name)
    return label
