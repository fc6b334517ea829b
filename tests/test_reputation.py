from __future__ import annotations

import pytest

from reviewlens.operators import reputation as rep

SCHEMA = ("business_id string, categories array<string>, business_stars double, is_open bigint, state string, "
          "year int, label int, prediction double, pos_prob double, neg_prob double, sentiment_score double")


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        ("a", ["x"], 4.0, 1, "FL", 2020, 2, 2.0, 0.9, 0.1, 0.8),
        ("a", ["x"], 4.0, 1, "FL", 2021, 2, 2.0, 0.7, 0.1, 0.6),
        ("a", ["x"], 4.0, 1, "FL", 2021, 0, 0.0, None, None, None),  # no valid score: its 0 is no vote
        ("b", ["y", "z"], 2.0, 0, None, 2004, 0, 0.0, 0.1, 0.7, -0.6),
        ("b", ["y", "z"], 2.0, 0, None, 2020, 0, 1.0, 0.3, 0.3, 0.0),
        ("c", None, None, None, "NV", 2020, 1, 0.0, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_business_reputation(scored):
    rows = {r.business_id: r for r in rep.business_reputation(scored, 1).collect()}
    a = rows["a"]
    assert (a.total_reviews, a.n_positive, a.n_negative, a.avg_stars, a.state) == (3, 2, 0, 4.0, "FL")
    assert a.avg_sentiment_score == pytest.approx(0.7) and a.avg_label == pytest.approx(4 / 3)
    assert (a.positive_pct, a.negative_pct) == (66.7, 0.0)
    c = rows["c"]
    assert c.avg_sentiment_score is None and c.n_negative == 0 and c.avg_stars is None and c.categories is None
    assert rep.business_reputation(scored, 3).count() == 1


def test_attributes_that_differ_between_reviews_stay_one_business(spark, scored):
    extra = spark.createDataFrame([("a", ["x"], 5.0, 1, "GA", 2021, 2, 2.0, 0.5, 0.5, 0.0)], SCHEMA)
    rows = [r for r in rep.business_reputation(scored.unionByName(extra), 1).collect() if r.business_id == "a"]
    assert len(rows) == 1 and rows[0].total_reviews == 4 and rows[0].avg_stars == 5.0


def test_correlation_and_ranking(scored):
    reputation = rep.business_reputation(scored, 1)
    row = rep.score_star_corr(reputation).first()
    assert row.correlation == pytest.approx(1.0) and (row.n_used, row.n_excluded) == (2, 1)
    assert [r.business_id for r in rep.rank_reputation(reputation, 1, 5).collect()] == ["a", "b"]
    worst = rep.rank_reputation(reputation, 1, 1, best=False)
    assert worst.first().business_id == "b" and "negative_pct" in worst.columns


def test_by_year(scored):
    rows = {r.year: r for r in rep.sentiment_by_year(scored, min_n=1).collect()}
    assert set(rows) == {2020, 2021}  # 2004 lies outside the years
    assert rows[2020].review_count == 2 and rows[2020].avg_sentiment == pytest.approx(0.4)
    assert rows[2021].is_marked and rows[2021].mean_of_years == pytest.approx(0.5)


def test_by_state(scored):
    rows = [tuple(r) for r in rep.sentiment_by_state(scored, 1).collect()]
    assert len(rows) == 1 and rows[0][0] == "FL" and rows[0][-1] is True
    assert rep.sentiment_by_state(scored, 5).isEmpty()


def test_open_closed(scored):
    rows = {r.is_open: (r.n_businesses, r.mean_stars) for r in rep.open_closed(rep.business_reputation(scored, 1)).collect()}
    assert rows == {0: (1, 2.0), 1: (1, 4.0)}
