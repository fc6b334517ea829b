from reviewlens.functions.dates import date_parts, parse_ts
from reviewlens.functions.labels import open_status, polarity, sentiment_code, sentiment_label
from reviewlens.functions.lists import item_count, split_list
from reviewlens.functions.numbers import axis_format, human_format, nan_to_null, pct, star_label
from reviewlens.functions.taxonomy import TAXONOMY, assign_category, category_of, rules_of
from reviewlens.functions.text import capitals, exclamations, normalise_words, text_length, tokens

__all__ = [
    "TAXONOMY", "assign_category", "axis_format", "capitals", "category_of", "date_parts", "exclamations",
    "human_format", "item_count", "nan_to_null", "normalise_words", "open_status", "parse_ts", "pct",
    "polarity", "rules_of", "sentiment_code", "sentiment_label", "split_list", "star_label",
    "text_length", "tokens",
]
