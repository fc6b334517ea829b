"""Fixed schemas (DDL) of the five input tables, so that no pass over the data is spent on inference."""

from __future__ import annotations

# Field names of the JSON-lines input files.
REVIEW = (
    "review_id string, business_id string, user_id string, stars double, "
    "useful bigint, funny bigint, cool bigint, text string, date string"
)

# `attributes` is an open-ended object, so it is read as a map: `attributes.DogsAllowed` still works.
BUSINESS = (
    "business_id string, name string, address string, city string, state string, postal_code string, "
    "latitude double, longitude double, stars double, review_count bigint, is_open bigint, "
    "attributes map<string, string>, categories string, "
    "hours struct<Monday: string, Tuesday: string, Wednesday: string, Thursday: string, "
    "Friday: string, Saturday: string, Sunday: string>"
)

USER = (
    "user_id string, name string, review_count bigint, useful bigint, funny bigint, cool bigint, "
    "fans bigint, average_stars double, friends string, elite string, "
    "compliment_cool bigint, compliment_cute bigint, compliment_funny bigint, compliment_hot bigint, "
    "compliment_list bigint, compliment_more bigint, compliment_note bigint, compliment_photos bigint, "
    "compliment_plain bigint, compliment_profile bigint, compliment_writer bigint"
)

CHECKIN = "business_id string, date string"

TIP = "business_id string, user_id string, text string, date string, compliment_count bigint"

TABLES = {"review": REVIEW, "business": BUSINESS, "user": USER, "checkin": CHECKIN, "tip": TIP}


def table_schema(name: str, since_field: str | None = None) -> str:
    """Schema of table `name`; `since_field` adds the user table's member-since column under its own name."""
    extra = f", {since_field} string" if name == "user" and since_field else ""
    return TABLES[name] + extra
