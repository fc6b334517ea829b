"""Features and tokens of review text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_length(text: Column) -> Column:
    return F.length(text)


def exclamations(text: Column) -> Column:
    """Number of `!` in the text."""
    return F.length(text) - F.length(F.replace(text, F.lit("!")))


def capitals(text: Column) -> Column:
    """Number of capitals A-Z in the text."""
    return F.length(F.regexp_replace(text, "[^A-Z]+", ""))


def tokens(text: Column) -> Column:
    """Lower-case tokens between single white-space characters, without the empty ones at the end.

    Text of white space alone has no token; empty and missing text have one empty token.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    cut = F.regexp_replace(low, "\\s+$", "")
    return F.when((cut == "") & (low != ""), F.array().cast("array<string>")).otherwise(F.split(cut, "\\s"))


def normalise_words(word: Column, mapping: dict[str, str]) -> Column:
    """Replace each listed form by its normal form."""
    return reduce(
        lambda rest, pair: F.when(word == pair[0], pair[1]).otherwise(rest), reversed(mapping.items()), word
    )
