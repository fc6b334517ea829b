"""The two analyses as batch jobs over files.

    spark-submit --py-files reviewlens.zip reviewlens/jobs.py eda       --input DIR --output DIR
    spark-submit --py-files reviewlens.zip reviewlens/jobs.py sentiment --input DIR --output DIR

`--input` holds review, business, user, checkin and tip as JSON lines or Parquet (`--format`). Tables that
several reports read are written out first and read back: each raw file is parsed once, into a typed copy, each
later scan reads the columns it needs, and a lost executor costs a read and not the work before it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from reviewlens.operators.reputation import business_reputation
from reviewlens.plans import eda, sentiment
from reviewlens.schemas import TABLES
from reviewlens.sources import export_counts, read_features, read_table, save_models, write_features


def read_inputs(spark: SparkSession, folder: str, fmt: str, since_field: str | None) -> dict[str, DataFrame]:
    suffix = ".json" if fmt == "json" else ".parquet"
    return {name: read_table(spark, f"{folder}/{name}{suffix}", name, fmt, since_field) for name in TABLES}


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back."""
    write_features(df, path)
    return read_features(df.sparkSession, path)


def typed_copies(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """The input tables as Parquet, so that their text is parsed in one scan each."""
    return {name: stored(table, f"{out}/raw/{name}") for name, table in tables.items()}


def write_reports(reports: dict[str, DataFrame], out: str) -> None:
    for name, table in reports.items():
        write_features(table, f"{out}/reports/{name}")


def eda_job(tables: dict[str, DataFrame], out: str, since_field: str | None = None, **options) -> None:
    """Typed copies and profiles of the raw tables, cleaned tables and every report table under `out`."""
    tables = typed_copies(tables, out)
    for name, table in eda.profile_tables(tables).items():
        write_features(table, f"{out}/profile/{name}")
    reviews = stored(eda.clean_reviews(tables["review"]), f"{out}/clean/review")
    businesses = stored(eda.clean_businesses(tables["business"]), f"{out}/clean/business")
    users = stored(eda.clean_users(tables["user"], since_field), f"{out}/clean/user")
    stored(eda.clean_tips(tables["tip"]), f"{out}/clean/tip")
    for name, table in eda.eda_tables(reviews, businesses, users, **options).items():
        folder = name.replace(": ", "-").replace(" & ", "_and_").replace(" ", "_")
        if name == "tag_counts":
            export_counts(table, f"{out}/reports/{folder}")
        else:
            write_features(table, f"{out}/reports/{folder}")


def sentiment_job(
    tables: dict[str, DataFrame],
    out: str,
    since_field: str | None = None,
    cfg: sentiment.TrainingConfig = sentiment.TrainingConfig(),
    checkpoint_dir: str | None = None,
    min_reviews: int = 20,
    **limits,
) -> None:
    """Wide table, models, their comparison, the scored reviews and the reputation tables under `out`."""
    tables = typed_copies(tables, out)
    order = ("review", "business", "user", "checkin", "tip")
    wide = sentiment.prepare_wide(*(tables[t] for t in order), since_field=since_field, spread=cfg.key)
    wide = stored(wide, f"{out}/wide")
    train, test = sentiment.training_sets(wide, cfg)
    models, predictions, comparison = sentiment.train_models(train, test, cfg, checkpoint_dir)
    save_models(models, f"{out}/models")
    reports = {**sentiment.wide_reports(wide), **sentiment.model_reports(models, predictions, comparison)}
    write_reports(reports, out)
    wide.sparkSession.catalog.clearCache()
    scored = stored(sentiment.score_all(models, wide), f"{out}/scored")
    reputation = stored(business_reputation(scored, min_reviews), f"{out}/reports/reputation")
    write_reports(sentiment.reputation_tables(scored, reputation, **limits), out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Review analytics on Spark")
    parser.add_argument("job", choices=("eda", "sentiment"))
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", choices=("json", "parquet"), default="json")
    parser.add_argument("--since-field", help="name of the user table's member-since column, if it has one")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"reviewlens-{args.job}").getOrCreate()
    tables = read_inputs(spark, args.input, args.format, args.since_field)
    run = eda_job if args.job == "eda" else sentiment_job
    run(tables, args.output, args.since_field)


if __name__ == "__main__":
    main()
