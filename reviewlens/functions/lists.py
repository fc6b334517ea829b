"""Delimited strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(col: Column, sep: str = ", ", trim: bool = False) -> Column:
    """Split a delimited string into an array, with its items trimmed if asked; null stays null."""
    items = F.split(col, re.escape(sep))
    return F.transform(items, lambda item: F.trim(item)) if trim else items


def item_count(col: Column, sep: str = ", ") -> Column:
    """How many items a delimited string holds; the empty string counts as one, null stays null."""
    return F.array_size(F.split(col, re.escape(sep)))
