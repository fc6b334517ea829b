from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reviewlens import functions as fn
from reviewlens.operators import clean as c
from reviewlens.operators import quality as q
from reviewlens.operators.features import text_features, user_features
from reviewlens.plans.eda import VOTES, clean_businesses, clean_reviews, clean_tips, clean_users


def column(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def test_sentinel_replaces_minus_one_only(raw):
    before = q.summarize(raw["review"], VOTES, ("min",))
    after = c.replace_sentinel(raw["review"], VOTES)
    assert ("funny", "-1") in {tuple(r) for r in before.collect()}
    assert sorted(r[0] for r in after.select("useful").collect()) == [-2, 0, 0, 0, 1, 2]


def test_invalid_names(raw):
    kept = c.drop_invalid_strings(raw["user"], "name")
    assert {r.name for r in kept.collect()} == {"Ann", "Bob"}
    assert q.missing_counts(kept.select("name"), empty=True).first()[0] == 0


def test_require_nonempty(raw):
    kept = c.require_nonempty(raw["business"], ["categories"], nan=True)
    assert {r.business_id for r in kept.collect()} == {"b1", "b2", "b3", "b6", "b7"}
    both = c.require_nonempty(kept, ["postal_code"])
    assert {r.business_id for r in both.collect()} == {"b1", "b2", "b3"}


def test_impute_concat(raw, spark):
    filled = {r.business_id: r.address for r in c.impute_concat(raw["business"], "address", ["city", "postal_code"]).collect()}
    assert filled["b1"] == "Tampa, 33602" and filled["b2"] == "Reno, 89501" and filled["b3"] == "1 Main"
    other = c.impute_concat(raw["business"], "address", ["postal_code", "city"])
    assert {r.business_id: r.address for r in other.collect()}["b1"] == "33602, Tampa"
    assert not [v for v in filled.values() if not v]


def test_fills(spark):
    df = spark.createDataFrame([(None, None, None), (1, "x", ["t"])], "n bigint, s string, a array<string>")
    filled = c.fill_empty_array(c.fill_defaults(df, {"n": 0, "s": ""}), "a")
    assert [tuple(r) for r in filled.collect()] == [(0, "", []), (1, "x", ["t"])]
    assert c.fill_zero(df, ["n"]).first().n == 0


def test_projection_and_rename(raw):
    df = c.drop_cols(raw["business"], ["attributes", "hours"])
    assert not {"attributes", "hours"} & set(df.columns)
    assert c.select_cols(df, ["name", "city"]).columns == ["name", "city"]
    renamed = c.prefix_columns(df, ["name", "useful", "stars"], "business_")
    assert {"business_name", "business_stars"} <= set(renamed.columns) and "business_useful" not in renamed.columns


def test_like_and_volume(raw):
    assert [r.business_id for r in c.name_like(raw["business"], "%Bay Gr%").collect()] == ["b1"]
    assert c.min_volume(raw["business"], "review_count", 50).count() == 3


def test_parse_ts_malformed_is_null(raw):
    out = {r.review_id: r.date for r in clean_reviews(raw["review"]).filter("business_id <> 'b1' or review_id <> 'r5'").collect()}
    assert out["r5"] is None and out["r2"].hour == 23
    assert [r.date is None for r in clean_tips(raw["tip"]).collect()].count(True) == 2
    users = clean_users(raw["user"], "member_since")
    assert dict(users.dtypes)["member_since"] == "timestamp"


def test_date_parts(raw):
    row = fn.date_parts(clean_reviews(raw["review"]).filter("review_id = 'r2'"), "date").first()
    assert (row.year, row.month, row.hour) == (2018, 6, 23)


@pytest.mark.parametrize("text, n", [("a, b, c", 3), ("", 1), ("one", 1), (None, None), ("a,b", 1)])
def test_item_count(spark, text, n):
    assert column(spark, text, fn.item_count) == n


def test_split_list(spark):
    assert column(spark, "Pizza , Food", lambda v: fn.split_list(v, ",", trim=True)) == ["Pizza", "Food"]
    assert column(spark, "Pizza, Food", fn.split_list) == ["Pizza", "Food"]
    assert column(spark, None, fn.split_list) is None


def test_text_features(spark):
    df = spark.createDataFrame([("A!b!! É C",), ("",), (None,)], "text string")
    rows = [tuple(r)[1:] for r in text_features(df).collect()]
    assert rows == [(9, 3, 2), (0, 0, 0), (None, None, None)]


def test_labels(spark):
    df = spark.createDataFrame([(s,) for s in (1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, None)], "s double")
    s = F.col("s")
    rows = [tuple(r) for r in df.select(fn.sentiment_label(s), fn.polarity(s), fn.sentiment_code(s)).collect()]
    assert [r[0] for r in rows] == ["Negative"] * 2 + ["Neutral"] * 3 + ["Positive"] * 2 + ["Neutral"]
    assert [r[1] for r in rows] == ["negative"] * 2 + [None] * 3 + ["positive"] * 2 + [None]
    assert [r[2] for r in rows] == [0, 0, 2, 1, 2, 2, 2, 2]


def test_numbers(spark):
    assert column(spark, 3_400_000, fn.human_format, "bigint") == "3.4M"
    assert column(spark, 1_200, fn.human_format, "bigint") == "1.2K"
    assert column(spark, -1_500, fn.human_format, "bigint") == "-1.5K"
    assert column(spark, 950, fn.human_format, "bigint") == "950"
    assert column(spark, 12_345, fn.axis_format, "bigint") == "12k"
    assert column(spark, 4.0, fn.star_label, "double") == "4★"
    assert column(spark, float("nan"), fn.nan_to_null, "double") is None
    assert column(spark, 1, lambda v: fn.pct(v, F.lit(3)), "int") == 33.3
    assert column(spark, 1, lambda v: fn.pct(v, F.lit(0)), "int") is None
    assert column(spark, 0, fn.open_status, "int") == "Closed"


def test_number_labels_round_like_python(spark):
    values = [0, 999, 1_050, 1_150, 1_250, 1_350, 1_750, 2_500, 3_500, 999_949, 999_950, 999_999, 1_000_000,
              1_050_000, 1_250_000, 1_350_000, 12_345_678_901, *range(1_000, 40_000, 50)]

    def short(n):
        return f"{n / 1e6:.1f}M" if n >= 1e6 else f"{n / 1e3:.1f}K" if n >= 1e3 else str(n)

    def axis(n):
        return f"{n / 1e6:.1f}M" if n >= 1e6 else f"{n / 1e3:.0f}k"

    df = spark.createDataFrame([(n,) for n in values], "n bigint")
    for n, a, b in df.select("n", fn.human_format(F.col("n")), fn.axis_format(F.col("n"))).collect():
        assert (a, b) == (short(n), axis(n))


def test_user_features_null_propagates(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5), (1, 2, None, 4, 5)],
                               "user_review_count int, fans int, user_useful int, user_funny int, user_cool int")
    assert [(r.user_activity, r.user_engagement) for r in user_features(df).collect()] == [(3, 12), (3, None)]


def test_taxonomy_size_and_order():
    rules = fn.rules_of(fn.TAXONOMY)
    assert len(rules) == len(dict(rules)) == 105 and len(fn.TAXONOMY) == 10
    assert rules[0] == ("Restaurants", "Food & Dining") and rules[-1][0] == "Calligraphy"


@pytest.mark.parametrize("tags, group", [
    ("Restaurants, Hotels", "Travel & Hospitality"),
    ("Hotels, Restaurants", "Travel & Hospitality"),
    ("Traditional Chinese Medicine", "Food & Dining"),
    ("Traditional Chinese Medicine, Health & Medical", "Health & Medical"),
    ("Food Banks", "Food & Dining"),
    ("restaurants", "Other"),
    ("Something Else", "Other"),
    (None, "Other"),
])
def test_last_matching_rule_wins(spark, tags, group):
    df = spark.createDataFrame([(tags,)], "categories string")
    assert fn.assign_category(df).first().main_category == group


def test_category_against_a_plain_loop(spark):
    """Random tag strings: go through the rules in order and let each match overwrite the last."""
    rng = random.Random(5)
    rules = fn.rules_of(fn.TAXONOMY)
    tags = [t for t, _ in rules] + ["Thai", "Food Banks", "Chinese Martial Arts", "hotels", "Art Galleries"]
    texts = [", ".join(rng.sample(tags, rng.randint(1, 5))) for _ in range(500)]

    def loop(text):
        group = "Other"
        for tag, main in rules:
            group = main if tag in text else group
        return group

    out = fn.assign_category(spark.createDataFrame([(t,) for t in texts], "categories string")).collect()
    assert [r.main_category for r in out] == [loop(t) for t in texts]


def test_custom_rules_overlap(spark):
    df = spark.createDataFrame([("ab",)], "categories string")
    pick = lambda rules: fn.assign_category(df, rules=rules).first().main_category
    assert pick([("a", "A"), ("b", "B")]) == "B" and pick([("b", "B"), ("a", "A")]) == "A" and pick([]) == "Other"


def test_clean_businesses(raw):
    out = clean_businesses(raw["business"])
    assert {r.business_id: r.main_category for r in out.collect()} == {
        "b1": "Food & Dining", "b2": "Travel & Hospitality", "b3": "Health & Medical"}
