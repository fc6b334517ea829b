"""Sentiment and status labels derived from one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentiment_label(stars: Column) -> Column:
    """Positive from 4 stars, Negative up to 2, Neutral otherwise; missing stars are Neutral."""
    return F.when(stars >= 4, "Positive").when(stars <= 2, "Negative").otherwise("Neutral")


def polarity(stars: Column) -> Column:
    """Two-way label; anything between 2 and 4 stars, and missing stars, is null."""
    return F.when(stars >= 4, "positive").when(stars <= 2, "negative")


def sentiment_code(stars: Column) -> Column:
    """Class number: 0 up to 2 stars, 1 at exactly 3, else 2; missing stars give 2."""
    return F.when(stars <= 2, 0).when(stars == 3, 1).otherwise(2)


def open_status(is_open: Column) -> Column:
    return F.when(is_open == 1, "Open").otherwise("Closed")
