"""Exploratory analysis: clean the tables once, then derive every report table from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import assign_category, date_parts, open_status, parse_ts, text_length
from reviewlens.operators import aggregates as agg
from reviewlens.operators import quality
from reviewlens.operators import ranking as rank
from reviewlens.operators.clean import (
    drop_cols,
    drop_invalid_strings,
    impute_concat,
    replace_sentinel,
    require_nonempty,
)
from reviewlens.operators.words import word_table, words_for_businesses

VOTES = ["cool", "funny", "useful"]
USER_COLUMNS = [
    "user_id", "name", "review_count", "average_stars", "fans", "useful", "funny", "cool",
]


def clean_reviews(review: DataFrame) -> DataFrame:
    """Votes of -1 set to 0, dates parsed, text length added."""
    df = parse_ts(replace_sentinel(review, [c for c in VOTES if c in review.columns]), "date")
    return df.withColumn("review_length", text_length(F.col("text"))) if "text" in df.columns else df


def clean_businesses(business: DataFrame, rules: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """Businesses with tags and a postal code, with a filled address and a main category."""
    df = require_nonempty(business, ["categories"], nan=True)
    df = drop_cols(require_nonempty(df, ["postal_code"]), ["attributes", "hours"])
    return assign_category(impute_concat(df, "address", ["city", "postal_code"]), rules=rules)


def clean_users(user: DataFrame, since_field: str | None = None) -> DataFrame:
    """The columns in use, of users with a real name, with the member-since column parsed."""
    cols = [*USER_COLUMNS, since_field] if since_field else USER_COLUMNS
    df = drop_invalid_strings(user.select(*cols), "name")
    return parse_ts(df, since_field) if since_field else df


def clean_tips(tip: DataFrame) -> DataFrame:
    return parse_ts(tip, "date")


def profile_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Row counts, missing values and summaries of every table, and the checks of the reviews, by name."""
    review = tables["review"]
    profile = {
        "row_counts": quality.row_counts(tables),
        "duplicate_reviews": quality.duplicate_keys(review, ["review_id"]),
        "blank_texts": quality.blank_rows(review, "text"),
        "distinct_votes": quality.distinct_count(review, VOTES),
        "lowest_votes": quality.summarize(review, VOTES, ("min",)),
    }
    for vote in VOTES:
        profile[f"counts_of_{vote}"] = quality.value_counts(review, vote)
    for name, df in tables.items():
        profile[f"missing_{name}"] = quality.missing_counts(df, empty=True)
        profile[f"summary_{name}"] = quality.summarize(df)
    return profile


def eda_tables(
    reviews: DataFrame,
    businesses: DataFrame,
    users: DataFrame,
    focus: tuple[str, str] = ("Food & Dining", "Home & Local Services"),
    min_total: int = 500,
    k: int = 10,
    k_words: int = 20,
) -> dict[str, DataFrame]:
    """Every report table of the exploratory analysis, by name, from the cleaned tables. All are lazy."""
    dated = date_parts(reviews, "date")
    sentiment = agg.category_sentiment(agg.category_sentiment_counts(reviews, businesses), min_total)
    status = businesses.withColumn("business_status", open_status(F.col("is_open")))
    stars = agg.group_count(reviews, ["stars"])
    food = focus[0]
    since = [c for c in users.columns if c not in USER_COLUMNS]
    tables = {
        "business_density": agg.grid_density(businesses),
        "top_cities": rank.top_groups(businesses, "city", k),
        "top_raw_categories": rank.top_groups(businesses, "categories", k),
        "tag_counts": agg.tag_counts(businesses),
        "top_main_categories": rank.top_groups(businesses, "main_category", k),
        "top_reviewed_categories": agg.reviews_by_category(reviews, businesses, k),
        "star_distribution": agg.share_of_total(stars, digits=1).orderBy("stars"),
        "length_by_stars": agg.length_by_group(reviews),
        "category_sentiment": sentiment,
        "most_negative_categories": agg.extreme_categories(sentiment, "negative_pct", k),
        "most_positive_categories": agg.extreme_categories(sentiment, "positive_pct", k),
        "top_words": rank.top_words(word_table(reviews), k=k_words),
        "words_of_most_reviewed": words_for_businesses(
            reviews, rank.top_businesses(businesses, food, k), k_words
        ),
        "words_of_least_reviewed": words_for_businesses(
            reviews, rank.bottom_businesses(businesses, food, k), k_words
        ),
        "business_status": agg.share_of_total(agg.group_count(status, ["business_status"]), digits=2),
        "reviews_by_year": agg.group_count(dated, ["year"], "review_count").orderBy("year"),
        "reviews_by_month": agg.group_count(dated, ["month"]).orderBy("month"),
        "reviews_by_hour": agg.group_count(dated, ["hour"]).orderBy("hour"),
        "top_users": rank.top_users(users, k, ("name", "review_count", *since)),
        "avg_stars_by_category": agg.avg_by_group(businesses),
    }
    for category in focus:
        tables[f"city_stats: {category}"] = agg.city_stats(businesses, category)
        tables[f"top_businesses: {category}"] = rank.top_businesses(businesses, category, k)
    return tables
