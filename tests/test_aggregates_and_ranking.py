from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from reviewlens.operators import aggregates as agg
from reviewlens.operators import aggregates as a
from reviewlens.operators import ranking as r
from reviewlens.operators.words import NOISE_WORDS, remove_stopwords, tokenize, word_table, words_for_businesses
from reviewlens.plans.eda import clean_businesses, clean_reviews, clean_users, eda_tables
from reviewlens.sources import register_views


@pytest.fixture(scope="module")
def shops(raw):
    return clean_businesses(raw["business"])


def test_group_count_and_share(spark):
    df = spark.createDataFrame([("x",)] * 2 + [("y",)] + [(None,)], "k string")
    out = a.share_of_total(a.group_count(df, ["k"]), digits=1).collect()
    assert {tuple(x) for x in out} == {("x", 2, 50.0), ("y", 1, 25.0), (None, 1, 25.0)}


def test_tag_counts(shops):
    rows = [tuple(x) for x in a.tag_counts(shops).collect()]
    assert rows[0] == ("Restaurants", 2) and sum(n for _, n in rows) == 6


def test_dataframe_and_sql_agree(raw, shops, spark):
    register_views(spark, reviews=raw["review"], businesses=shops)
    frame = [tuple(x) for x in a.reviews_by_category(raw["review"], shops).collect()]
    assert frame == [tuple(x) for x in a.reviews_by_category_sql(spark).collect()]
    assert frame == [("Food & Dining", 3), ("Travel & Hospitality", 2)]
    top = [tuple(x) for x in r.top_businesses(shops, "Food & Dining").drop("business_id").collect()]
    assert top == [tuple(x) for x in r.top_businesses_sql(spark, "Food & Dining").collect()]


def test_category_sentiment(raw, shops):
    table = a.category_sentiment(a.category_sentiment_counts(raw["review"], shops), 1)
    rows = {x.main_category: x.asDict() for x in table.collect()}
    food = rows["Food & Dining"]
    assert (food["Negative"], food["Neutral"], food["Positive"], food["total"]) == (2, 0, 1, 3)
    assert (food["positive_pct"], food["negative_pct"], food["neutral_pct"]) == (33.3, 66.7, 0.0)
    assert a.category_sentiment(a.category_sentiment_counts(raw["review"], shops), 3).count() == 1
    assert a.extreme_categories(table, "negative_pct", 1).first().main_category == "Food & Dining"
    assert a.extreme_categories(table, "positive_pct", 1).first().main_category == "Travel & Hospitality"


def test_city_stats_order(shops):
    rows = a.city_stats(shops.withColumn("main_category", F.lit("x")), "x").collect()
    assert [(x.city, x.total_businesses, x.avg_rating, x.total_reviews) for x in rows] == [
        ("Reno", 2, 3.75, 100), ("Tampa", 1, 4.0, 100)]


def test_length_by_group(raw):
    rows = {x.stars: (x.avg_length, x.median_length) for x in a.length_by_group(clean_reviews(raw["review"])).collect()}
    assert rows[4.0] == (3.0, 3) and rows[None] == (None, None)


def test_avg_by_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 5.0)], "main_category string, stars double")
    assert [tuple(x) for x in a.avg_by_group(df).collect()] == [("y", 5.0, 3.5), ("x", 2.0, 3.5)]


def test_correlation_matrix_is_pairwise_complete(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame(rng.normal(size=(200, 4)), columns=list("abcd"))
    frame["b"] += frame["a"]
    frame.loc[rng.random(200) < 0.3, "c"] = None
    rows = [tuple(None if pd.isna(v) else float(v) for v in row) for row in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    want = frame.corr()
    got = {(x.x, x.y): x.r for x in a.correlation_matrix(df, list("abcd")).collect()}
    assert len(got) == 16
    for (x, y), value in got.items():
        assert value == pytest.approx(want.loc[x, y])
    one = a.correlation(df, "a", "c").first()
    assert one.correlation == pytest.approx(want.loc["a", "c"])
    assert one.n_used == frame["c"].notna().sum() and one.n_used + one.n_excluded == 200


def test_correlation_with_a_constant_or_empty_column(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, 1.0)], "a double, b double, c double")
    got = {(x.x, x.y): x.r for x in a.correlation_matrix(df, list("abc")).collect()}
    assert got[("a", "b")] is None and got[("a", "c")] is None and got[("a", "a")] == pytest.approx(1.0)
    assert a.correlation(df, "a", "b").first().correlation is None


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    out = sorted((x.bin, x.n, x.bin_start, x.mean) for x in a.histogram(df, "v", 50).collect())
    counts, edges = np.histogram(values, bins=50)
    assert [n for _, n, _, _ in out] == counts.tolist()
    assert [s for _, _, s, _ in out] == pytest.approx(edges[:-1].tolist())
    assert out[0][3] == pytest.approx(values.mean())


def test_histogram_of_a_constant(spark):
    out = {x.bin: x.n for x in a.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).collect()}
    assert out == {0: 0, 1: 0, 2: 2, 3: 0}
    assert np.histogram([2.0, 2.0], bins=4)[0].tolist() == [0, 0, 2, 0]


def test_grid_density(shops):
    cells = {tuple(x) for x in a.grid_density(shops, step=1.0).collect()}
    assert cells == {(27.0, -83.0, 1), (39.0, -120.0, 2)}


def test_top_and_bottom(shops, raw):
    assert [x.business_id for x in r.bottom_businesses(shops.withColumn("main_category", F.lit("x")), "x").collect()] == ["b3", "b2", "b1"]
    assert [x.business_id for x in r.top_businesses(shops.withColumn("main_category", F.lit("x")), "x", 2).collect()] == ["b1", "b2"]
    assert [tuple(x) for x in r.top_users(clean_users(raw["user"]), 2).collect()] == [("Bob", 30), ("Ann", 10)]
    assert [tuple(x) for x in r.top_groups(shops, "city", 1).collect()] == [("Reno", 2)]


def test_word_table(raw):
    rows = sorted((x.business_id, x.sentiment, x.word) for x in word_table(raw["review"]).collect())
    # "line!!", "it.", "cold," and "crème" hold other characters; "ever" stays, "came" and "called" are noise
    assert rows == [
        ("b1", "negative", "ever"), ("b1", "negative", "order"), ("b1", "negative", "order"),
        ("b1", "negative", "twice"), ("b1", "negative", "worst"),
        ("b1", "positive", "great"), ("b1", "positive", "great"),
    ]


def test_word_table_agrees_with_the_feature_stages(spark):
    from pyspark.ml.feature import StopWordsRemover, Tokenizer

    texts = ["The  Food was\tgood, very GOOD food", " leading and trailing ", "don't stop", "x yy zzz", ""]
    df = spark.createDataFrame([(t, 5.0) for t in texts], "text string, stars double")
    staged = StopWordsRemover(inputCol="raw", outputCol="w").transform(
        Tokenizer(inputCol="text", outputCol="raw").transform(df))
    want = sorted(w for row in staged.collect() for w in row.w
                  if len(w) > 2 and w not in NOISE_WORDS and w.isascii() and w.isalpha())
    assert sorted(x.word for x in word_table(df, keys=()).collect()) == want
    ours = remove_stopwords(tokenize(df)).collect()
    strip = lambda ws: [w for w in ws if w]
    assert [strip(x.filtered_words) for x in ours] == [strip(x.w) for x in staged.collect()]


def test_top_words_per_class(spark):
    rows = [("p", "aaa")] * 3 + [("p", "bbb")] * 3 + [("p", "ccc")] + [("n", "ddd")]
    out = r.top_words(spark.createDataFrame(rows, "sentiment string, word string"), k=2).collect()
    assert {(x.sentiment, x.word, x["count"], x["rank"]) for x in out} == {("p", "aaa", 3, 1), ("p", "bbb", 3, 2), ("n", "ddd", 1, 1)}


def test_words_for_businesses(raw, shops):
    out = words_for_businesses(raw["review"], r.top_businesses(shops, "Food & Dining", 1), 3)
    assert [tuple(x) for x in out.collect()] == [("great", 2), ("order", 2), ("ever", 1)]


def test_every_eda_table_runs(raw):
    tables = eda_tables(clean_reviews(raw["review"]), clean_businesses(raw["business"]),
                        clean_users(raw["user"], "member_since"), min_total=1)
    assert len(tables) == 24
    empty = {name for name, df in tables.items() if not df.collect()}
    assert empty == {"city_stats: Home & Local Services", "top_businesses: Home & Local Services"}


def test_tokens_equal_sparks_tokenizer(spark):
    texts = ["", "a", "good ", " lead", "two  gaps", "   ", "\n\t", "Tab\tEnd \n", "É  x ", "a b  \t"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    theirs = {r.text: r.words for r in Tokenizer(inputCol="text", outputCol="words").transform(df).collect()}
    assert {r.text: r.raw_words for r in tokenize(df).collect()} == theirs
    assert tokenize(spark.createDataFrame([(None,)], "text string")).first().raw_words == [""]


def test_histogram_leaves_out_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    rows = agg.histogram(df, "v", 2).orderBy("bin").collect()
    assert [(r.n, r.bin_start, r["mean"]) for r in rows] == [(1, 1.0, 1.5), (1, 1.5, 1.5)]


def test_correlations_do_not_unfold_the_rows(spark):
    df = spark.range(100).selectExpr("id AS a", "id * id AS b", "id % 3 AS c")
    plan = agg.correlation_matrix(df, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and plan.count("Range (") == 1
