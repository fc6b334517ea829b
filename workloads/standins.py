"""Review-shaped views over the driver's tables, each with the same view as SQL text.

`reviews`, `businesses`, `users`, `tips` and `checkins` stand in for the five input tables. Missing and
invalid values, which the driver's tables lack, are derived from ordinary values (a sentinel vote, a
null postal code, a user called "None"), so that no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import sentiment_code, split_list
from reviewlens.operators.joins import collected, hot_keys, join_in_parts, row_parts, skew_join

# Sample rules: overlaps on purpose, since the last matching rule wins.
RULES = [
    ("ring", "Hardware"), ("gear", "Hardware"), ("bolt", "Hardware"), ("small", "Compact"),
    ("red", "Colour"), ("blue", "Colour"), ("hot", "Thermal"), ("cold", "Thermal"), ("rod", "Hardware"),
    ("PROMO", "Campaign"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def line_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews without stars and user: order lines alone."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_partkey").alias("business_id"),
        F.col("l_shipdate").alias("date"),
        (F.col("l_linenumber") - 2).cast("bigint").alias("useful"),
        F.col("l_suppkey").alias("funny"),
        F.floor("l_quantity").alias("cool"),
        "l_linenumber",
        "l_returnflag",
        "l_discount",
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the user and the stars (leading digit of the priority) of their order."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("stars"),
        F.col("o_orderpriority").alias("text"),
    )
    return join_in_parts(line_reviews(spark, sf), orders, "review_id", review_parts(spark, sf))


def review_parts(spark: SparkSession, sf: str) -> int | None:
    """Parts that the reviews are joined in, by the number of order lines."""
    return row_parts(table(spark, sf, "lineitem"))


def review_hot_keys(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Hot businesses and users of `reviews`, counted without the join: lines by part, and by order and its user."""
    lines = line_reviews(spark, sf)
    of_order = lines.groupBy("review_id").agg(F.count(F.lit(1)).alias("_lines"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("review_id"), F.col("o_custkey").alias("user_id"))
    return {
        "business_id": collected(hot_keys(lines, "business_id")),
        "user_id": collected(hot_keys(of_order.join(orders, "review_id"), "user_id", weight="_lines")),
    }


REVIEWS = """
    SELECT l_orderkey AS review_id, l_partkey AS business_id, o_custkey AS user_id,
           CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS stars, l_shipdate AS date,
           CAST(l_linenumber - 2 AS BIGINT) AS useful, l_suppkey AS funny,
           CAST(floor(l_quantity) AS BIGINT) AS cool, l_linenumber, l_returnflag, l_discount,
           o_orderpriority AS text
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def businesses(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as businesses: some without tags, postal code, address or state."""
    size = F.col("p_size")
    tags = F.concat_ws(", ", F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")), F.col("p_type"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        F.when(size < 10, F.lit(None)).when(size < 20, "").otherwise(F.col("p_name")).alias("address"),
        F.col("p_brand").alias("city"),
        F.when(size != 7, F.col("p_type")).alias("state"),
        F.when(size % 10 == 0, "").when(size % 10 != 1, F.col("p_brand")).alias("postal_code"),
        (F.col("p_retailprice") / 100).alias("latitude"),
        (size - 25).cast("double").alias("longitude"),
        (1 + F.col("p_partkey") % 5).cast("double").alias("stars"),
        size.cast("bigint").alias("review_count"),
        (size % 2).cast("bigint").alias("is_open"),
        F.when(size == 50, F.lit(None)).when(size == 49, "").otherwise(tags).alias("categories"),
    )


BUSINESSES = """
    SELECT p_partkey AS business_id, p_name AS name,
           CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN '' ELSE p_name END AS address,
           p_brand AS city, CASE WHEN p_size <> 7 THEN p_type END AS state,
           CASE WHEN p_size % 10 = 0 THEN '' WHEN p_size % 10 <> 1 THEN p_brand END AS postal_code,
           p_retailprice / 100 AS latitude, CAST(p_size - 25 AS DOUBLE) AS longitude,
           CAST(1 + p_partkey % 5 AS DOUBLE) AS stars, CAST(p_size AS BIGINT) AS review_count,
           CAST(p_size % 2 AS BIGINT) AS is_open,
           CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN ''
                ELSE replace(p_name, ' ', ', ') || ', ' || p_type END AS categories
    FROM part
"""

_CASES = "\n".join(f"WHEN categories LIKE '%{tag}%' THEN '{group}'" for tag, group in reversed(RULES))
CATEGORY = f"CASE {_CASES} ELSE 'Other' END"

CLEAN_BUSINESSES = f"""
    SELECT * EXCLUDE (address),
           CASE WHEN address IS NULL OR address = '' THEN concat_ws(', ', city, postal_code)
                ELSE address END AS address,
           {CATEGORY} AS main_category
    FROM ({BUSINESSES})
    WHERE categories IS NOT NULL AND categories <> '' AND postal_code <> ''
"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as users, some of them without a real name."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    name = (
        F.when(segment == "MACHINERY", "None")
        .when(segment == "BUILDING", "")
        .when(segment != "HOUSEHOLD", F.col("c_name"))
    )
    return table(spark, sf, "customer").select(
        key.alias("user_id"),
        name.alias("name"),
        (key % 97).alias("review_count"),
        (key % 11).alias("useful"),
        (key % 5).alias("funny"),
        (key % 3).alias("cool"),
        (key % 7).alias("fans"),
        (F.col("c_acctbal") / 2000).alias("average_stars"),
    )


USERS = """
    SELECT c_custkey AS user_id,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'None' WHEN c_mktsegment = 'BUILDING' THEN ''
                WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS name,
           c_custkey % 97 AS review_count, c_custkey % 11 AS useful, c_custkey % 5 AS funny,
           c_custkey % 3 AS cool, c_custkey % 7 AS fans, c_acctbal / 2000 AS average_stars
    FROM customer
"""


def tips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        (F.col("event_id") % 100).alias("business_id"),
        "user_id",
        F.col("ts").alias("date"),
        F.floor("value").alias("compliment_count"),
        F.col("event_type").alias("text"),
    )


TIPS = """
    SELECT event_id % 100 AS business_id, user_id, ts AS date,
           CAST(floor(value) AS BIGINT) AS compliment_count, event_type AS text
    FROM events
"""


def checkins(spark: SparkSession, sf: str) -> DataFrame:
    """Document text as the delimited check-in string of the business with the document's number."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("business_id"), F.col("text").alias("date")
    )


CHECKINS = "SELECT doc_id AS business_id, text AS date FROM documents"


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with a made-up prediction and score; the score is missing on every seventh line number."""
    valid = F.col("l_linenumber") != 7
    pos = F.round(F.col("l_discount") * 10, 2)
    return reviews(spark, sf).select(
        "review_id",
        "l_linenumber",
        "business_id",
        sentiment_code(F.col("stars")).alias("label"),
        F.year("date").alias("year"),
        F.when(F.col("l_returnflag") == "R", 0.0)
        .when(F.col("l_returnflag") == "N", 1.0)
        .otherwise(2.0)
        .alias("prediction"),
        F.when(valid, pos).alias("pos_prob"),
        F.when(valid, (1 - pos) / 2).alias("neg_prob"),
    ).withColumn("sentiment_score", F.col("pos_prob") - F.col("neg_prob"))


def scored_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """`scores` with the columns of their business."""
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("business_id"))
    about = businesses(spark, sf).select(
        "business_id",
        split_list(F.col("categories")).alias("categories"),
        F.col("stars").alias("business_stars"),
        "is_open",
        "state",
    )
    hot, spread, parts = hot_keys(lines, "business_id"), ["review_id", "l_linenumber"], review_parts(spark, sf)
    return skew_join(scores(spark, sf), about, "business_id", hot=hot, spread=spread, parts=parts)


SCORED = f"""
    SELECT r.*, r.pos_prob - r.neg_prob AS sentiment_score, string_split(b.categories, ', ') AS categories,
           b.stars AS business_stars, b.is_open, b.state
    FROM (
        SELECT review_id, l_linenumber, business_id,
               CASE WHEN stars <= 2 THEN 0 WHEN stars = 3 THEN 1 ELSE 2 END AS label,
               CAST(year(date) AS INTEGER) AS year,
               CASE l_returnflag WHEN 'R' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE
                    ELSE 2.0::DOUBLE END AS prediction,
               CASE WHEN l_linenumber <> 7 THEN round(l_discount * 10, 2) END AS pos_prob,
               CASE WHEN l_linenumber <> 7 THEN (1 - round(l_discount * 10, 2)) / 2 END AS neg_prob
        FROM ({REVIEWS})
    ) r LEFT JOIN ({BUSINESSES}) b USING (business_id)
"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Label and made-up prediction of each review."""
    return reviews(spark, sf).select(
        sentiment_code(F.col("stars")).alias("label"),
        F.when(F.col("l_returnflag") == "R", 0.0)
        .when(F.col("l_returnflag") == "N", 1.0)
        .otherwise(2.0)
        .alias("prediction"),
    )


PREDICTIONS = f"""
    SELECT CASE WHEN stars <= 2 THEN 0 WHEN stars = 3 THEN 1 ELSE 2 END AS label,
           CASE l_returnflag WHEN 'R' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE
                ELSE 2.0::DOUBLE END AS prediction
    FROM ({REVIEWS})
"""


def text_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as reviews of their source; labelled ones have 1, 3 or 5 stars, the others none."""
    labels = table(spark, sf, "labels")
    stars = (
        F.when(F.col("toxic") == 1, 1.0).when(F.col("quality") == 1, 5.0).when(F.col("quality") == 0, 3.0)
    )
    docs = table(spark, sf, "documents").join(labels, "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("review_id"),
        F.substring("source", 4, 10).cast("bigint").alias("business_id"),
        F.col("doc_id").alias("user_id"),
        stars.alias("stars"),
        "text",
        F.date_add(F.lit("2005-01-01").cast("date"), (F.col("doc_id") % 6000).cast("int"))
        .cast("timestamp")
        .alias("date"),
    )


TEXT_REVIEWS = """
    SELECT doc_id AS review_id, CAST(substr(source, 4, 10) AS BIGINT) AS business_id, doc_id AS user_id,
           CASE WHEN toxic = 1 THEN 1.0::DOUBLE WHEN quality = 1 THEN 5.0::DOUBLE
                WHEN quality = 0 THEN 3.0::DOUBLE END AS stars,
           text, DATE '2005-01-01' + CAST(doc_id % 6000 AS INTEGER) AS date
    FROM documents LEFT JOIN labels USING (doc_id)
"""


def text_businesses(spark: SparkSession, sf: str) -> DataFrame:
    """The businesses that documents review, with the number of their documents as review count."""
    counts = text_reviews(spark, sf).groupBy("business_id").agg(F.count(F.lit(1)).alias("review_count"))
    return businesses(spark, sf).drop("review_count").join(counts, "business_id")


TEXT_BUSINESSES = f"""
    SELECT b.* EXCLUDE (review_count), c.review_count
    FROM ({BUSINESSES}) b
    JOIN (SELECT business_id, count(*) AS review_count FROM ({TEXT_REVIEWS}) GROUP BY business_id) c
    USING (business_id)
"""
