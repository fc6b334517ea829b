"""The wide feature table of the sentiment models: row-local columns on top of the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import capitals, date_parts, exclamations, sentiment_code, text_length
from reviewlens.operators.clean import fill_defaults, fill_empty_array, fill_zero

# The scalar model features in vector order, and the defaults of a review without a match.
NUMERIC_FEATURES = (
    "review_length", "num_exclamations", "num_caps",
    "average_stars", "user_review_count", "fans",
    "user_activity", "user_engagement",
    "business_stars", "business_review_count",
    "is_open", "checkin_count", "user_tip_count",
    "year", "month",
)
JOIN_DEFAULTS = {
    "checkin_count": 0, "user_tip_count": 0, "business_tip_count": 0,
    "business_review_count": 0, "user_review_count": 0, "fans": 0,
    "text": "", "average_stars": 0, "business_stars": 0, "is_open": 0,
}


def text_features(df: DataFrame, col: str = "text") -> DataFrame:
    """Add length, number of exclamation marks and number of capitals."""
    text = F.col(col)
    return df.withColumns(
        {
            "review_length": text_length(text),
            "num_exclamations": exclamations(text),
            "num_caps": capitals(text),
        }
    )


def user_features(df: DataFrame) -> DataFrame:
    """Add the user's activity and engagement; a missing part makes the sum missing."""
    return df.withColumns(
        {
            "user_activity": F.col("user_review_count") + F.col("fans"),
            "user_engagement": F.col("user_useful") + F.col("user_funny") + F.col("user_cool"),
        }
    )


def feature_table(wide: DataFrame) -> DataFrame:
    """Fill the gaps the left joins leave, then add text, user and calendar features and the label."""
    df = fill_empty_array(fill_defaults(wide, JOIN_DEFAULTS), "categories")
    df = date_parts(user_features(text_features(df)), "date", ("year", "month"))
    return df.withColumn("label", sentiment_code(F.col("stars")))


def model_columns(df: DataFrame, keep: tuple[str, ...] = ("business_id", "state")) -> DataFrame:
    """The columns the models use, with every numeric gap filled by zero."""
    cols = [*keep, "text", "label", *NUMERIC_FEATURES, "categories"]
    return fill_zero(df.select(*[c for c in cols if c in df.columns]), list(NUMERIC_FEATURES))
