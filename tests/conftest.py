from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from workloads.checking import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"

REVIEWS = [
    # review, business, user, stars, useful, funny, cool, text, date
    ("r1", "b1", "u1", 5.0, -1, 0, 3, "Great oysters, GREAT line!!", "2018-01-01 00:00:00"),
    ("r2", "b1", "u2", 1.0, -2, -1, 0, "Ordered it. came cold, called twice", "2018-06-01 23:59:59"),
    ("r3", "b2", "u1", 3.0, 0, 2, 1, "", "2019-02-28 12:30:00"),
    ("r4", "b2", "u9", 4.0, 1, 1, 1, "   ", "2020-03-01 05:00:00"),
    ("r5", "b9", "u2", None, 2, 0, 0, None, "not a date"),
    ("r5", "b1", "u3", 2.0, 0, 0, 0, "Worst crème ever ordered", "2021-12-31 18:00:00"),
]
BUSINESSES = [
    # id, name, address, city, state, postal, lat, lon, stars, reviews, open, categories, attributes
    ("b1", "Bay Grill", None, "Tampa", "FL", "33602", 27.9, -82.4, 4.0, 100, 1, "Restaurants, Seafood", {"DogsAllowed": "True"}),
    ("b2", "Hotel One", "", "Reno", None, "89501", 39.5, -119.8, 4.0, 50, 0, "Hotels, Restaurants", None),
    ("b3", "Acupuncture", "1 Main", "Reno", "NV", "89502", 39.6, -119.9, 3.5, 50, 1, "Traditional Chinese Medicine, Health & Medical", None),
    ("b4", "No Tags", "2 Main", "Reno", "NV", "89503", 0.2, 0.3, 2.0, 1, 1, None, None),
    ("b5", "Empty Tags", "3 Main", "Reno", "NV", "89504", 0.2, 0.3, 2.0, 1, 1, "", None),
    ("b6", "No Post", "4 Main", "Tampa", "FL", "", 27.1, -82.1, 2.0, 1, 1, "Food", None),
    ("b7", "Null Post", "5 Main", "Tampa", "FL", None, 27.1, -82.1, 2.0, 1, 1, "Food", None),
    ("b8", "NaN Tags", "6 Main", "Tampa", "FL", "33603", 27.1, -82.1, 2.0, 1, 1, "NaN", None),
]
USERS = [
    ("u1", "Ann", 10, 3.5, 2, 5, 1, 1, "u2, u3", "2018, 2019", "2015-05-05 10:00:00"),
    ("u2", "", 30, 4.5, 0, 0, 0, 0, "None", "", "bad"),
    ("u3", "None", 30, 1.5, 1, 1, 1, 1, "", "", "2016-01-01 00:00:00"),
    ("u4", None, 5, 2.5, 1, 1, 1, 1, "", "", None),
    ("u5", "Bob", 30, 2.0, 3, 0, 0, 0, "", "", "2017-01-01 00:00:00"),
]
CHECKINS = [("b1", "2018-01-01 00:00:00, 2018-01-02 00:00:00, 2018-01-03 00:00:00"), ("b2", ""), ("b7", None),
            ("b9", "2018-01-01 00:00:00")]
TIPS = [("b1", "u1", "go", "2018-01-01 00:00:00", 0), ("b1", "u1", "now", "oops", 1), ("b9", "u9", "hm", None, 0)]


def _write(path: Path, names: list[str], rows: list[tuple]) -> None:
    lines = [json.dumps({n: v for n, v in zip(names, row) if v is not None}) for row in rows]
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def json_dir(tmp_path_factory) -> Path:
    folder = tmp_path_factory.mktemp("json")
    _write(folder / "review.json", "review_id business_id user_id stars useful funny cool text date".split(), REVIEWS)
    _write(folder / "business.json", ("business_id name address city state postal_code latitude longitude stars "
                                      "review_count is_open categories attributes").split(), BUSINESSES)
    _write(folder / "user.json", ("user_id name review_count average_stars fans useful funny cool friends elite "
                                  "member_since").split(), USERS)
    _write(folder / "checkin.json", ["business_id", "date"], CHECKINS)
    _write(folder / "tip.json", "business_id user_id text date compliment_count".split(), TIPS)
    return folder


@pytest.fixture(scope="session")
def raw(spark, json_dir):
    """The five tables as read from JSON lines."""
    from reviewlens.sources import read_table

    return {
        name: read_table(spark, str(json_dir / f"{name}.json"), name, since_field="member_since")
        for name in ("review", "business", "user", "checkin", "tip")
    }


def rows_of(df) -> set:
    return {tuple(r) for r in df.collect()}
