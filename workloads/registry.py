"""The registered queries: each a Spark callable over the driver's tables and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import (
    assign_category,
    axis_format,
    date_parts,
    human_format,
    item_count,
    open_status,
    parse_ts,
    polarity,
    sentiment_code,
    sentiment_label,
    split_list,
    star_label,
)
from reviewlens.operators import aggregates as agg
from reviewlens.operators import clean, quality, sampling
from reviewlens.operators import modeltables as tables
from reviewlens.operators import evaluate as ev
from reviewlens.operators import ranking as rank
from reviewlens.operators import reputation as rep
from reviewlens.operators.features import NUMERIC_FEATURES, feature_table, text_features, user_features
from reviewlens.operators.joins import hot_keys_scanned, tip_counts
from reviewlens.operators.model import add_class_weights, featurize, score, score_rows, term_statistics
from reviewlens.operators.words import (
    NOISE_WORDS,
    STOP_WORDS,
    remove_stopwords,
    tokenize,
    word_table,
    words_for_businesses,
)
from reviewlens.plans.eda import clean_businesses
from reviewlens.sources import (
    Layout,
    export_counts,
    from_rows,
    load_models,
    read_counts,
    read_features,
    read_table,
    register_views,
    row_buckets,
    save_models,
    store_star,
    wide_from_star,
    write_features,
)
from workloads import models as ml
from workloads import standins as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MIN_CATEGORY, MIN_BUSINESS, MIN_RANKED, MIN_STATE, MIN_YEAR, YEARS = 500, 20, 30, 1000, 500, (1996, 2000)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round floating results: the last bits of a sum depend on its order."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def shops(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned businesses with a main category."""
    return clean_businesses(st.businesses(spark, sf), st.RULES)


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# ---------------------------------------------------------------- profiling and data quality

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@query("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def _(spark, sf):
    return quality.row_counts({t: st.table(spark, sf, t) for t in TABLES})


_BUSINESS_COLS = ("business_id", "name", "address", "city", "state", "postal_code", "latitude", "longitude",
                  "stars", "review_count", "is_open", "categories")


@query("missing_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') AS {c}" for c in _BUSINESS_COLS
) + f" FROM ({st.BUSINESSES})")
def _(spark, sf):
    return quality.missing_counts(st.businesses(spark, sf), empty=True)


@query("missing_counts_null_nan", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS {c}"
    if c in ("latitude", "longitude", "stars") else f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
    for c in _BUSINESS_COLS) + f" FROM ({st.BUSINESSES})")
def _(spark, sf):
    return quality.missing_counts(st.businesses(spark, sf))


@query("blank_text", f"SELECT business_id, address FROM ({st.BUSINESSES}) WHERE trim(address) = ''")
def _(spark, sf):
    return quality.blank_rows(st.businesses(spark, sf), "address").select("business_id", "address")


@query("duplicate_keys", """
    SELECT count(*) AS total, count(DISTINCT (l_orderkey, l_linenumber)) AS unique_keys,
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""")
def _(spark, sf):
    return quality.duplicate_keys(st.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_combos", f"""
    SELECT count(*) AS n_distinct FROM (SELECT DISTINCT useful, funny, cool FROM ({st.REVIEWS}))""")
def _(spark, sf):
    return quality.distinct_count(st.reviews(spark, sf), ["useful", "funny", "cool"])


@query("distinct_stars", f"SELECT DISTINCT stars FROM ({st.REVIEWS})")
def _(spark, sf):
    return quality.distinct_values(st.reviews(spark, sf), "stars")


def _summary_sql(col: str, source: str) -> str:
    return f"""
        SELECT '{col}' AS "column", count({col}) AS count, round(avg({col}), 6) AS mean,
               round(stddev_samp({col}), 6) AS stddev, CAST(min({col}) AS VARCHAR) AS min,
               CAST(quantile_disc({col}, 0.25) AS VARCHAR) AS p25, CAST(quantile_disc({col}, 0.5) AS VARCHAR) AS p50,
               CAST(quantile_disc({col}, 0.75) AS VARCHAR) AS p75, CAST(max({col}) AS VARCHAR) AS max
        FROM ({source})"""


@query("summary_stats", " UNION ALL ".join(
    _summary_sql(c, st.BUSINESSES) for c in ("stars", "review_count", "longitude")))
def _(spark, sf):
    cols = ["stars", "review_count", "longitude"]
    return rounded(quality.summarize(st.businesses(spark, sf), cols), "mean", "stddev")


@query("min_check", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS VARCHAR) AS min FROM ({st.REVIEWS})"""
    for c in ("useful", "funny", "cool")))
def _(spark, sf):
    return quality.summarize(st.reviews(spark, sf), ["useful", "funny", "cool"], ("min",))


@query("value_counts", f"SELECT useful, count(*) AS n FROM ({st.REVIEWS}) GROUP BY useful")
def _(spark, sf):
    return quality.value_counts(st.reviews(spark, sf), "useful")


@query("valid_rate", f"""
    SELECT count(sentiment_score) AS n_valid, count(*) AS n_total,
           round((count(*) - count(sentiment_score)) / count(*) * 100, 2) AS invalid_pct
    FROM ({st.SCORED})""")
def _(spark, sf):
    return quality.valid_rate(st.scores(spark, sf), "sentiment_score")


# ---------------------------------------------------------------- cleaning and imputation


@query("fix_sentinel", f"""
    SELECT review_id, l_linenumber, CASE WHEN useful = -1 THEN 0 ELSE useful END AS useful,
           CASE WHEN funny = -1 THEN 0 ELSE funny END AS funny FROM ({st.REVIEWS})""")
def _(spark, sf):
    fixed = clean.replace_sentinel(st.reviews(spark, sf), ["useful", "funny"])
    return fixed.select("review_id", "l_linenumber", "useful", "funny")


@query("valid_names", f"""
    SELECT user_id, name FROM ({st.USERS}) WHERE name IS NOT NULL AND name <> '' AND name <> 'None'""")
def _(spark, sf):
    return clean.drop_invalid_strings(st.users(spark, sf), "name").select("user_id", "name")


@query("require_nonempty", f"""
    SELECT business_id, categories, postal_code FROM ({st.BUSINESSES})
    WHERE categories IS NOT NULL AND categories <> '' AND postal_code <> ''""")
def _(spark, sf):
    kept = clean.require_nonempty(st.businesses(spark, sf), ["categories", "postal_code"], nan=True)
    return kept.select("business_id", "categories", "postal_code")


@query("impute_address", f"""
    SELECT business_id, CASE WHEN address IS NULL OR address = '' THEN concat_ws(', ', city, postal_code)
                             ELSE address END AS address
    FROM ({st.BUSINESSES})""")
def _(spark, sf):
    filled = clean.impute_concat(st.businesses(spark, sf), "address", ["city", "postal_code"])
    return filled.select("business_id", "address")


@query("left_join_fill", f"""
    SELECT user_id, coalesce(name, '') AS name, coalesce(n, 0) AS user_tip_count
    FROM ({st.USERS}) LEFT JOIN (SELECT user_id, count(*) AS n FROM ({st.TIPS}) GROUP BY user_id)
    USING (user_id)""")
def _(spark, sf):
    counts = tip_counts(st.tips(spark, sf), "user_id", "user_tip_count")
    joined = st.users(spark, sf).select("user_id", "name").join(counts, "user_id", "left")
    return clean.fill_defaults(joined, {"name": "", "user_tip_count": 0})


@query("empty_array_fill", f"""
    SELECT business_id, CASE WHEN categories IS NULL THEN 0
           ELSE CAST(len(string_split(categories, ', ')) AS INTEGER) END AS n_categories
    FROM ({st.BUSINESSES})""")
def _(spark, sf):
    tags = st.businesses(spark, sf).withColumn("categories", split_list(F.col("categories")))
    filled = clean.fill_empty_array(tags, "categories")
    return filled.select("business_id", F.size("categories").alias("n_categories"))


@query("name_like", f"SELECT business_id, name FROM ({st.BUSINESSES}) WHERE name LIKE '%gear%'")
def _(spark, sf):
    return clean.name_like(st.businesses(spark, sf), "%gear%").select("business_id", "name")


# ---------------------------------------------------------------- scalar functions


@query("date_parts", """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def _(spark, sf):
    return date_parts(st.table(spark, sf, "events"), "ts").select("event_id", "year", "month", "hour")


@query("split_size", "SELECT doc_id, CAST(len(string_split(text, ', ')) AS INTEGER) AS n_items FROM documents")
def _(spark, sf):
    return st.table(spark, sf, "documents").select("doc_id", item_count(F.col("text")).alias("n_items"))


@query("text_features", """
    SELECT doc_id, CAST(length(text) AS INTEGER) AS review_length,
           CAST(length(text) - length(replace(text, '!', '')) AS INTEGER) AS num_exclamations,
           CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS INTEGER) AS num_caps
    FROM documents""")
def _(spark, sf):
    featured = text_features(st.table(spark, sf, "documents"))
    return featured.select("doc_id", "review_length", "num_exclamations", "num_caps")


@query("sentiment_label", f"""
    SELECT review_id, l_linenumber,
           CASE WHEN stars >= 4 THEN 'Positive' WHEN stars <= 2 THEN 'Negative' ELSE 'Neutral' END AS label,
           CASE WHEN stars >= 4 THEN 'positive' WHEN stars <= 2 THEN 'negative' END AS polarity,
           CASE WHEN stars <= 2 THEN 0 WHEN stars = 3 THEN 1 ELSE 2 END AS code,
           CAST(CAST(stars AS INTEGER) AS VARCHAR) || '★' AS star_label
    FROM ({st.REVIEWS})""")
def _(spark, sf):
    stars = F.col("stars")
    return st.reviews(spark, sf).select(
        "review_id", "l_linenumber", sentiment_label(stars).alias("label"),
        polarity(stars).alias("polarity"), sentiment_code(stars).alias("code"),
        star_label(stars).alias("star_label"),
    )


@query("user_features", f"""
    SELECT user_id, review_count + fans AS user_activity, useful + funny + cool AS user_engagement
    FROM ({st.USERS})""")
def _(spark, sf):
    users = clean.prefix_columns(st.users(spark, sf), ["review_count", "useful", "funny", "cool"], "user_")
    return user_features(users).select("user_id", "user_activity", "user_engagement")


@query("human_format", """
    SELECT o_orderkey, CASE WHEN n >= 1000000 THEN format('{:.1f}M', n / 1000000.0::DOUBLE)
                            WHEN n >= 1000 THEN format('{:.1f}K', n / 1000.0::DOUBLE)
                            ELSE CAST(n AS VARCHAR) END AS label,
           CASE WHEN n >= 1000000 THEN format('{:.1f}M', n / 1000000.0::DOUBLE)
                ELSE format('{:.0f}k', n / 1000.0::DOUBLE) END AS axis_label
    FROM (SELECT o_orderkey, CAST(floor(o_totalprice * 10) AS BIGINT) AS n FROM orders)""")
def _(spark, sf):
    n = F.floor(F.col("o_totalprice") * 10)
    return st.table(spark, sf, "orders").select(
        "o_orderkey", human_format(n).alias("label"), axis_format(n).alias("axis_label"))


# ---------------------------------------------------------------- categories


@query("tag_counts", f"""
    SELECT trim(tag) AS category_word, count(*) AS count
    FROM (SELECT unnest(string_split(categories, ',')) AS tag FROM ({st.CLEAN_BUSINESSES}))
    GROUP BY 1""")
def _(spark, sf):
    return agg.tag_counts(shops(spark, sf))


@query("assign_category", f"SELECT business_id, categories, main_category FROM ({st.CLEAN_BUSINESSES})")
def _(spark, sf):
    return shops(spark, sf).select("business_id", "categories", "main_category")


def _top_sql(col: str, source: str, k: int = 10, out: str = "n") -> str:
    return f"""SELECT {col}, count(*) AS {out} FROM ({source}) GROUP BY {col}
               ORDER BY {out} DESC, {col} LIMIT {k}"""


for _name, _col in (("top_main_categories", "main_category"), ("top_cities", "city"),
                    ("top_raw_categories", "categories")):
    @query(_name, _top_sql(_col, st.CLEAN_BUSINESSES))
    def _(spark, sf, col=_col):
        return rank.top_groups(shops(spark, sf), col)


# ---------------------------------------------------------------- joins


_REVIEWED = f"""
    SELECT main_category, count(*) AS review_count FROM ({st.REVIEWS})
    JOIN ({st.CLEAN_BUSINESSES}) USING (business_id)
    GROUP BY main_category ORDER BY review_count DESC, main_category LIMIT 10"""


@query("top_reviewed_categories", _REVIEWED.replace("review_count", "reviews").replace(
    "AS reviews", "AS review_count").replace("ORDER BY reviews", "ORDER BY review_count"))
def _(spark, sf):
    return agg.reviews_by_category(st.reviews(spark, sf), shops(spark, sf))


@query("top_reviewed_categories_sql", ORACLE["top_reviewed_categories"])
def _(spark, sf):
    register_views(spark, reviews=st.reviews(spark, sf), businesses=shops(spark, sf))
    return agg.reviews_by_category_sql(spark)


_CATEGORY_SENTIMENT = f"""
    SELECT *, round("Negative" / total * 100, 1) AS negative_pct,
           round("Neutral" / total * 100, 1) AS neutral_pct,
           round("Positive" / total * 100, 1) AS positive_pct
    FROM (SELECT main_category, count(*) FILTER (WHERE r.stars <= 2) AS "Negative",
                 count(*) FILTER (WHERE r.stars > 2 AND r.stars < 4) AS "Neutral", count(*) FILTER (WHERE r.stars >= 4) AS "Positive",
                 count(*) AS total
          FROM ({st.REVIEWS}) r JOIN ({st.CLEAN_BUSINESSES}) b USING (business_id) GROUP BY main_category)
    WHERE total >= {MIN_CATEGORY}"""


@query("category_sentiment", _CATEGORY_SENTIMENT)
def category_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    counts = agg.category_sentiment_counts(st.reviews(spark, sf), shops(spark, sf))
    return agg.category_sentiment(counts, MIN_CATEGORY)


for _name, _by in (("most_negative_categories", "negative_pct"), ("most_positive_categories", "positive_pct")):
    @query(_name, f"""SELECT main_category, total, positive_pct, negative_pct FROM ({_CATEGORY_SENTIMENT})
                      ORDER BY {_by} DESC, main_category LIMIT 10""")
    def _(spark, sf, by=_by):
        return agg.extreme_categories(category_sentiment(spark, sf), by)


@query("category_sentiment_counts", f"""
    SELECT main_category, CASE WHEN r.stars >= 4 THEN 'Positive' WHEN r.stars <= 2 THEN 'Negative'
                               ELSE 'Neutral' END AS sentiment_label, count(*) AS count
    FROM ({st.REVIEWS}) r JOIN ({st.CLEAN_BUSINESSES}) b USING (business_id) GROUP BY 1, 2""")
def _(spark, sf):
    return agg.category_sentiment_counts(st.reviews(spark, sf), shops(spark, sf))


@query("wide_features", f"""
    SELECT r.review_id, r.l_linenumber, r.business_id, r.user_id,
           CASE WHEN r.stars <= 2 THEN 0 WHEN r.stars = 3 THEN 1 ELSE 2 END AS label,
           CAST(length(r.text) AS INTEGER) AS review_length,
           CAST(length(regexp_replace(r.text, '[^A-Z]', '', 'g')) AS INTEGER) AS num_caps,
           round(u.average_stars, 6) AS average_stars, u.review_count AS user_review_count, u.fans,
           u.review_count + u.fans AS user_activity, u.useful + u.funny + u.cool AS user_engagement,
           b.stars AS business_stars, b.review_count AS business_review_count, b.is_open, b.state,
           CAST(coalesce(len(string_split(b.categories, ', ')), 0) AS INTEGER) AS n_categories,
           coalesce(CAST(len(string_split(c.date, ', ')) AS INTEGER), 0) AS checkin_count,
           coalesce(ut.n, 0) AS user_tip_count, coalesce(bt.n, 0) AS business_tip_count,
           CAST(year(r.date) AS INTEGER) AS year, CAST(month(r.date) AS INTEGER) AS month
    FROM ({st.REVIEWS}) r LEFT JOIN ({st.BUSINESSES}) b USING (business_id)
    LEFT JOIN ({st.USERS}) u USING (user_id) LEFT JOIN ({st.CHECKINS}) c USING (business_id)
    LEFT JOIN (SELECT user_id, count(*) AS n FROM ({st.TIPS}) GROUP BY 1) ut USING (user_id)
    LEFT JOIN (SELECT business_id, count(*) AS n FROM ({st.TIPS}) GROUP BY 1) bt USING (business_id)""")
def _(spark, sf):
    return wide_columns(ml.wide_table(spark, sf, st.reviews(spark, sf), LINE, st.review_hot_keys(spark, sf)))


LINE = ["review_id", "l_linenumber"]


def wide_columns(wide: DataFrame) -> DataFrame:
    cols = ("review_id l_linenumber business_id user_id label review_length num_caps average_stars "
            "user_review_count fans user_activity user_engagement business_stars business_review_count "
            "is_open state n_categories checkin_count user_tip_count business_tip_count year month").split()
    if "n_categories" not in wide.columns:
        wide = wide.withColumn("n_categories", F.size("categories"))
    return rounded(wide.select(*cols), "average_stars")


@query("wide_features_stored", ORACLE["wide_features"])
def _(spark, sf):
    """The same rows from reviews and businesses that are stored by business first."""
    buckets = row_buckets(st.table(spark, sf, "lineitem"))
    layout = Layout(spark, ml.shared_folder(spark, sf, "star"), "star", "business_id", buckets)
    tagged = st.businesses(spark, sf).withColumn("categories", split_list(F.col("categories")))
    # Counted once a business, so that the tags need not travel with every review to its user.
    tagged = tagged.withColumn("n_categories", F.coalesce(F.array_size("categories"), F.lit(0)))
    tips = st.tips(spark, sf)
    hot = hot_keys_scanned(st.line_reviews(spark, sf), "business_id", buckets)
    store_star(layout, st.reviews(spark, sf), tagged, st.checkins(spark, sf), tips, LINE, hot)
    wide = feature_table(wide_from_star(layout, st.users(spark, sf), tips, LINE))
    return wide_columns(wide.withColumn("n_categories", F.coalesce("n_categories", F.lit(0))))


# ---------------------------------------------------------------- reading and writing


def _as_json(spark, sf, name: str, df: DataFrame) -> DataFrame:
    """The rows written as JSON lines and read back under the table's fixed schema."""
    folder = ml.shared_folder(spark, sf, f"{name}_json")
    df.write.mode("overwrite").json(folder)
    return read_table(spark, folder, name).select(*df.columns)


def _text(*cols: str) -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in cols]


@query("read_reviews", f"""
    SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(business_id AS VARCHAR) AS business_id,
           CAST(user_id AS VARCHAR) AS user_id, stars, useful, funny, cool, text,
           strftime(date, '%Y-%m-%d %H:%M:%S') AS date FROM ({st.REVIEWS})""")
def _(spark, sf):
    rows = st.reviews(spark, sf).select(
        *_text("review_id", "business_id", "user_id"), "stars", "useful", "funny", "cool", "text",
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"))
    return _as_json(spark, sf, "review", rows)


@query("read_businesses", f"""
    SELECT CAST(business_id AS VARCHAR) AS business_id, {", ".join(_BUSINESS_COLS[1:])} FROM ({st.BUSINESSES})""")
def _(spark, sf):
    return _as_json(spark, sf, "business", st.businesses(spark, sf).select(*_text("business_id"), *_BUSINESS_COLS[1:]))


@query("read_users", f"""
    SELECT CAST(user_id AS VARCHAR) AS user_id, name, review_count, useful, funny, cool, fans, average_stars
    FROM ({st.USERS})""")
def _(spark, sf):
    rows = st.users(spark, sf).select(
        *_text("user_id"), "name", "review_count", "useful", "funny", "cool", "fans", "average_stars")
    return _as_json(spark, sf, "user", rows)


@query("read_checkins", f"SELECT CAST(business_id AS VARCHAR) AS business_id, date FROM ({st.CHECKINS})")
def _(spark, sf):
    return _as_json(spark, sf, "checkin", st.checkins(spark, sf).select(*_text("business_id"), "date"))


@query("read_tips", f"""
    SELECT CAST(business_id AS VARCHAR) AS business_id, CAST(user_id AS VARCHAR) AS user_id, text, compliment_count
    FROM ({st.TIPS})""")
def _(spark, sf):
    rows = st.tips(spark, sf).select(*_text("business_id", "user_id"), "text", "compliment_count")
    return _as_json(spark, sf, "tip", rows)


@query("reloaded_features", ORACLE["wide_features"])
def _(spark, sf):
    """The wide table written as Parquet and reloaded."""
    folder = ml.shared_folder(spark, sf, "wide")
    write_features(ml.wide_table(spark, sf, st.reviews(spark, sf), LINE, st.review_hot_keys(spark, sf)), folder)
    return wide_columns(read_features(spark, folder))


@query("exported_tag_counts", ORACLE["tag_counts"])
def _(spark, sf):
    """Tag counts exported as CSV with a header and read back."""
    folder = ml.shared_folder(spark, sf, "tag_counts")
    export_counts(agg.tag_counts(shops(spark, sf)), folder)
    return read_counts(spark, folder, "category_word string, count bigint")


# ---------------------------------------------------------------- aggregates


@query("reviews_by_year", f"""
    SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS review_count FROM ({st.REVIEWS}) GROUP BY 1""")
def _(spark, sf):
    dated = date_parts(st.reviews(spark, sf), "date", ("year",))
    return agg.group_count(dated, ["year"], "review_count").orderBy("year")


@query("reviews_by_month", f"""
    SELECT CAST(month(date) AS INTEGER) AS month, count(*) AS n FROM ({st.REVIEWS}) GROUP BY 1""")
def _(spark, sf):
    dated = date_parts(st.reviews(spark, sf), "date", ("month",))
    return agg.group_count(dated, ["month"]).orderBy("month")


# Dates as text: one in eleven is not a date, one in thirteen is empty, one in seventeen has no time of day.
_DATE_TEXT = """CASE WHEN event_id % 11 = 0 THEN 'not a date' WHEN event_id % 13 = 0 THEN ''
                     WHEN event_id % 17 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""


@query("parse_dates", f"""
    SELECT event_id, try_cast({_DATE_TEXT} AS TIMESTAMP) AS date FROM events""")
def _(spark, sf):
    number, ts = F.col("event_id"), F.col("ts")
    text = (
        F.when(number % 11 == 0, "not a date").when(number % 13 == 0, "")
        .when(number % 17 == 0, F.date_format(ts, "yyyy-MM-dd")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    return parse_ts(st.table(spark, sf, "events").select("event_id", text.alias("date")), "date").withColumn(
        "date", F.col("date").cast("timestamp_ntz"))


@query("events_by_hour", "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    dated = date_parts(st.table(spark, sf, "events"), "ts", ("hour",))
    return agg.group_count(dated, ["hour"]).orderBy("hour")


@query("star_distribution", f"SELECT stars, count(*) AS n FROM ({st.REVIEWS}) GROUP BY 1")
def _(spark, sf):
    return agg.group_count(st.reviews(spark, sf), ["stars"]).orderBy("stars")


@query("share_of_total", f"""
    SELECT stars, n, round(n / sum(n) OVER () * 100, 1) AS pct
    FROM (SELECT stars, count(*) AS n FROM ({st.REVIEWS}) GROUP BY 1)""")
def _(spark, sf):
    return agg.share_of_total(agg.group_count(st.reviews(spark, sf), ["stars"]))


@query("business_status", f"""
    SELECT business_status, n, round(n / sum(n) OVER () * 100, 2) AS percentage
    FROM (SELECT CASE WHEN is_open = 1 THEN 'Open' ELSE 'Closed' END AS business_status, count(*) AS n
          FROM ({st.CLEAN_BUSINESSES}) GROUP BY 1)""")
def _(spark, sf):
    status = shops(spark, sf).withColumn("business_status", open_status(F.col("is_open")))
    return agg.share_of_total(agg.group_count(status, ["business_status"]), digits=2, out="percentage")


@query("label_distribution", f"""
    SELECT label, n, round(n / sum(n) OVER () * 100, 2) AS percentage
    FROM (SELECT label, count(*) AS n FROM ({st.PREDICTIONS}) GROUP BY 1)""")
def _(spark, sf):
    counts = agg.group_count(st.predictions(spark, sf), ["label"])
    return agg.share_of_total(counts, digits=2, out="percentage")


for _name, _category in (("city_stats", "Hardware"), ("city_stats_second", "Compact")):
    @query(_name, f"""
        SELECT city, count(business_id) AS total_businesses, round(avg(stars), 6) AS avg_rating,
               CAST(sum(review_count) AS BIGINT) AS total_reviews
        FROM ({st.CLEAN_BUSINESSES}) WHERE main_category = '{_category}' GROUP BY city""")
    def _(spark, sf, category=_category):
        return rounded(agg.city_stats(shops(spark, sf), category), "avg_rating")


@query("length_by_group", """
    SELECT lang, round(avg(length(text)), 6) AS avg_length,
           CAST(quantile_disc(length(text), 0.5) AS INTEGER) AS median_length
    FROM documents GROUP BY lang""")
def _(spark, sf):
    docs = text_features(st.table(spark, sf, "documents"))
    return rounded(agg.length_by_group(docs, "lang"), "avg_length")


@query("tip_counts_by_user", f"SELECT user_id, count(*) AS tip_count FROM ({st.TIPS}) GROUP BY 1")
def _(spark, sf):
    return tip_counts(st.tips(spark, sf), "user_id")


@query("tip_counts_by_business", f"SELECT business_id, count(*) AS tip_count FROM ({st.TIPS}) GROUP BY 1")
def _(spark, sf):
    return tip_counts(st.tips(spark, sf), "business_id")


@query("avg_by_category", f"""
    SELECT main_category, round(avg_stars, 6) AS avg_stars, round(avg(avg_stars) OVER (), 6) AS overall_mean
    FROM (SELECT main_category, avg(stars) AS avg_stars FROM ({st.CLEAN_BUSINESSES}) GROUP BY 1)""")
def _(spark, sf):
    return rounded(agg.avg_by_group(shops(spark, sf)), "avg_stars", "overall_mean")


_CORR_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey")


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) + 0.0 AS r FROM lineitem"
    for x in _CORR_COLS for y in _CORR_COLS))
def _(spark, sf):
    matrix = agg.correlation_matrix(st.table(spark, sf, "lineitem"), list(_CORR_COLS))
    return matrix.withColumn("r", F.round("r", 6) + F.lit(0.0))


@query("geo_density", f"""
    SELECT floor(latitude / 0.5) * 0.5::DOUBLE AS latitude_cell, floor(longitude / 0.5) * 0.5::DOUBLE AS longitude_cell,
           count(*) AS n FROM ({st.CLEAN_BUSINESSES}) GROUP BY 1, 2""")
def _(spark, sf):
    return agg.grid_density(shops(spark, sf), step=0.5)


# ---------------------------------------------------------------- top-k


def _business_top_sql(category: str, direction: str, cols: str = "business_id, name, ") -> str:
    return f"""SELECT {cols}city, review_count, stars AS avg_rating FROM ({st.CLEAN_BUSINESSES})
               WHERE main_category = '{category}'
               ORDER BY review_count {direction}, stars {direction}, business_id LIMIT 10"""


@query("top_businesses", _business_top_sql("Hardware", "DESC"))
def _(spark, sf):
    return rank.top_businesses(shops(spark, sf), "Hardware")


@query("top_businesses_second", _business_top_sql("Compact", "DESC", "business_id, name, categories, "))
def _(spark, sf):
    return rank.top_businesses(shops(spark, sf), "Compact", extra=("categories",))


@query("top_businesses_sql", _business_top_sql("Hardware", "DESC", "name, "))
def _(spark, sf):
    register_views(spark, businesses=shops(spark, sf))
    return rank.top_businesses_sql(spark, "Hardware")


@query("bottom_businesses", _business_top_sql("Hardware", "ASC"))
def _(spark, sf):
    return rank.bottom_businesses(shops(spark, sf), "Hardware")


@query("top_users", f"""
    SELECT user_id, name, review_count FROM ({st.USERS})
    WHERE name IS NOT NULL AND name <> '' AND name <> 'None'
    ORDER BY review_count DESC, user_id LIMIT 10""")
def _(spark, sf):
    named = clean.drop_invalid_strings(st.users(spark, sf), "name")
    return rank.top_users(named, cols=("user_id", "name", "review_count"))


# ---------------------------------------------------------------- words

_WORDS = rf"""
    SELECT business_id, sentiment, CASE word WHEN 'ordered' THEN 'order' WHEN 'came' THEN 'come' ELSE word END AS word
    FROM (SELECT business_id, CASE WHEN stars >= 4 THEN 'positive' WHEN stars <= 2 THEN 'negative' END AS sentiment,
                 unnest(regexp_split_to_array(lower(text), '\s')) AS word
          FROM ({st.TEXT_REVIEWS}) WHERE stars >= 4 OR stars <= 2)
    WHERE length(word) > 2 AND word NOT IN ({quoted(STOP_WORDS + NOISE_WORDS)})
      AND NOT regexp_matches(word, '[^a-zA-Z]')"""


@query("top_words", f"""
    SELECT * FROM (SELECT sentiment, word, count,
                          CAST(row_number() OVER (PARTITION BY sentiment ORDER BY count DESC, word) AS INTEGER) AS rank
                   FROM (SELECT sentiment, word, count(*) AS count FROM ({_WORDS}) GROUP BY 1, 2))
    WHERE rank <= 20""")
def _(spark, sf):
    return rank.top_words(word_table(st.text_reviews(spark, sf)))


@query("word_table", f"SELECT business_id, sentiment, word, count(*) AS count FROM ({_WORDS}) GROUP BY ALL")
def _(spark, sf):
    return agg.group_count(word_table(st.text_reviews(spark, sf)), ["business_id", "sentiment", "word"], "count")


for _name, _dir, _pick in (("topk_business_words", "DESC", rank.top_businesses),
                           ("bottomk_business_words", "ASC", rank.bottom_businesses)):
    @query(_name, f"""
        WITH shop AS (SELECT *, {st.CATEGORY} AS main_category FROM ({st.TEXT_BUSINESSES})),
             ids AS (SELECT business_id FROM shop WHERE main_category = 'Hardware'
                     ORDER BY review_count {_dir}, stars {_dir}, business_id LIMIT 5)
        SELECT word, count(*) AS count FROM ({_WORDS}) WHERE business_id IN (SELECT business_id FROM ids)
        GROUP BY word ORDER BY count DESC, word LIMIT 20""")
    def _(spark, sf, pick=_pick):
        shop = assign_category(st.text_businesses(spark, sf), rules=st.RULES)
        return words_for_businesses(st.text_reviews(spark, sf), pick(shop, "Hardware", 5))


# Empty tokens at the end do not count; text of white space alone has none, empty or missing text has one.
_TOKENS = r"""CASE WHEN text <> '' AND regexp_matches(text, '^\s+$') THEN CAST([] AS VARCHAR[])
                   ELSE regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '\s+$', ''), '\s') END"""


@query("token_counts", rf"""
    SELECT doc_id, CAST(len(words) AS INTEGER) AS n_tokens,
           CAST(len(list_filter(words, lambda w: w NOT IN ({quoted(STOP_WORDS)}))) AS INTEGER) AS n_kept
    FROM (SELECT doc_id, {_TOKENS} AS words FROM documents)""")
def _(spark, sf):
    docs = remove_stopwords(tokenize(st.table(spark, sf, "documents")))
    return docs.select("doc_id", F.size("raw_words").alias("n_tokens"), F.size("filtered_words").alias("n_kept"))


@query("term_statistics", rf"""
    SELECT term, count(*) AS n_total, count(DISTINCT doc_id) AS n_docs,
           CASE WHEN count(DISTINCT doc_id) >= 5
                THEN round(ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(DISTINCT doc_id) + 1.0::DOUBLE)), 6)
                ELSE 0.0::DOUBLE END AS idf
    FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents)
    WHERE term NOT IN ({quoted(STOP_WORDS)}) GROUP BY term""")
def _(spark, sf):
    return rounded(term_statistics(st.table(spark, sf, "documents")), "idf")


# ---------------------------------------------------------------- sampling


def _uniform(purpose: str, seed: int, *key: str) -> str:
    text = f"concat_ws(':', '{purpose}', '{seed}', {', '.join(key)})"
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


_KEY = ["review_id", "l_linenumber", "business_id"]


@query("balance_classes", f"""
    WITH rows AS (SELECT {', '.join(_KEY)}, CASE WHEN stars <= 2 THEN 0 WHEN stars = 3 THEN 1 ELSE 2 END AS label
                  FROM ({st.REVIEWS})),
         sizes AS (SELECT label, count(*) AS n FROM rows GROUP BY label)
    SELECT rows.* FROM rows JOIN sizes USING (label)
    WHERE label = 1 OR {_uniform('balance', 42, *_KEY)}
                       < least(1.0::DOUBLE, (SELECT n FROM sizes WHERE label = 1)::DOUBLE / n)""")
def _(spark, sf):
    labelled = st.reviews(spark, sf).select(*_KEY, sentiment_code(F.col("stars")).alias("label"))
    return sampling.balance_classes(labelled, key=_KEY)


@query("sample_frac", f"""
    SELECT {', '.join(_KEY)} FROM ({st.REVIEWS}) WHERE {_uniform('sample', 42, *_KEY)} < 0.02::DOUBLE""")
def _(spark, sf):
    return sampling.sample_fraction(st.reviews(spark, sf).select(*_KEY), 0.02, 42, _KEY)


@query("train_test_split", f"""
    SELECT {', '.join(_KEY)}, CASE WHEN {_uniform('split', 25, *_KEY)} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part
    FROM ({st.REVIEWS})""")
def _(spark, sf):
    rows = st.reviews(spark, sf).select(*_KEY)
    train, test = sampling.split(rows, [0.8, 0.2], 25, _KEY)
    return sampling.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


@query("class_weights", f"""
    SELECT label, n, round(sum(n) OVER () / (3.0::DOUBLE * n), 6) AS weight
    FROM (SELECT label, count(*) AS n FROM ({st.PREDICTIONS}) GROUP BY label)""")
def _(spark, sf):
    weighted = add_class_weights(st.predictions(spark, sf))
    groups = weighted.groupBy("label", F.round("classWeight", 6).alias("weight"))
    return groups.agg(F.count(F.lit(1)).alias("n")).select("label", "n", "weight")


# ---------------------------------------------------------------- evaluation

_PER_CLASS = f"""
    SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS hit, count(*) FILTER (WHERE label = c) AS truth,
           count(*) FILTER (WHERE prediction = c) AS said, count(*) AS n
    FROM ({st.PREDICTIONS}), (VALUES (0), (1), (2)) AS classes(c) GROUP BY c"""


@query("classification_metrics", f"""
    SELECT CAST(max(n) AS BIGINT) AS n_rows, round(sum(hit) / max(n), 6) AS accuracy,
           round(sum(truth / n * (2 * (hit / said) * (hit / truth) / (hit / said + hit / truth))), 6) AS f1,
           round(sum(truth / n * (hit / said)), 6) AS weighted_precision,
           round(sum(truth / n * (hit / truth)), 6) AS weighted_recall
    FROM ({_PER_CLASS})""")
def _(spark, sf):
    return rounded(ev.evaluate(st.predictions(spark, sf)), *ev.METRICS)


@query("per_class_recall", f"""
    SELECT label, count(*) FILTER (WHERE label = prediction) AS correct, count(*) AS total,
           round(count(*) FILTER (WHERE label = prediction) / count(*), 6) AS recall
    FROM ({st.PREDICTIONS}) GROUP BY label""")
def _(spark, sf):
    return rounded(ev.per_class_recall(st.predictions(spark, sf)), "recall")


@query("confusion_matrix", f"""
    SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label) * 100, 1) AS row_pct
    FROM (SELECT label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n
          FROM ({st.PREDICTIONS}) GROUP BY 1, 2)""")
def _(spark, sf):
    return ev.confusion_matrix(st.predictions(spark, sf))


@query("confusion_table", f"""
    SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1,
           count(*) FILTER (WHERE prediction = 2) AS predicted_2 FROM ({st.PREDICTIONS}) GROUP BY label""")
def _(spark, sf):
    return ev.confusion_table(ev.confusion_matrix(st.predictions(spark, sf)))


# ---------------------------------------------------------------- reputation

_REPUTATION = f"""
    SELECT business_id, categories, count(*) AS total_reviews, avg(sentiment_score) AS avg_sentiment_score,
           avg(pos_prob) AS avg_pos_prob, avg(neg_prob) AS avg_neg_prob, avg(label) AS avg_label,
           count(*) FILTER (WHERE prediction = 2 AND sentiment_score IS NOT NULL) AS n_positive,
           count(*) FILTER (WHERE prediction = 0 AND sentiment_score IS NOT NULL) AS n_negative,
           max(business_stars) AS avg_stars, max(is_open) AS is_open, max(state) AS state,
           round(count(*) FILTER (WHERE prediction = 2 AND sentiment_score IS NOT NULL) / count(*) * 100, 1) AS positive_pct,
           round(count(*) FILTER (WHERE prediction = 0 AND sentiment_score IS NOT NULL) / count(*) * 100, 1) AS negative_pct
    FROM ({st.SCORED}) GROUP BY business_id, categories HAVING count(*) >= {MIN_BUSINESS}"""


def reputation(spark: SparkSession, sf: str) -> DataFrame:
    return rep.business_reputation(st.scored_reviews(spark, sf), MIN_BUSINESS)


# Ten digits: the mean of some dozen two-decimal scores can lie exactly between two six-digit numbers.
_REP_COLS = ("business_id, array_to_string(categories, ', ') AS categories, total_reviews, round(avg_sentiment_score, 10) AS avg_sentiment_score, "
             "round(avg_pos_prob, 10) AS avg_pos_prob, round(avg_neg_prob, 10) AS avg_neg_prob, "
             "round(avg_label, 10) AS avg_label, n_positive, n_negative, avg_stars, is_open, state, "
             "positive_pct, negative_pct")


@query("business_reputation", f"SELECT {_REP_COLS} FROM ({_REPUTATION})")
def _(spark, sf):
    result = reputation(spark, sf).withColumn("categories", F.array_join("categories", ", "))
    return rounded(result, "avg_sentiment_score", "avg_pos_prob", "avg_neg_prob", "avg_label", digits=10)


@query("score_star_corr", f"""
    SELECT round(corr(avg_sentiment_score, avg_stars), 6) AS correlation,
           count(*) FILTER (WHERE avg_sentiment_score IS NOT NULL AND avg_stars IS NOT NULL) AS n_used,
           count(*) FILTER (WHERE avg_sentiment_score IS NULL OR avg_stars IS NULL) AS n_excluded
    FROM ({_REPUTATION})""")
def _(spark, sf):
    return rounded(rep.score_star_corr(reputation(spark, sf)), "correlation")


@query("reputation_sample", f"""
    SELECT business_id, round(avg_sentiment_score, 10) AS avg_sentiment_score, avg_stars
    FROM ({_REPUTATION})
    WHERE avg_sentiment_score IS NOT NULL AND total_reviews BETWEEN 20 AND 500
      AND {_uniform('sample', 42, 'business_id')} < 0.05::DOUBLE""")
def _(spark, sf):
    sample = rep.reputation_sample(reputation(spark, sf))
    return rounded(sample.select("business_id", "avg_sentiment_score", "avg_stars"), "avg_sentiment_score", digits=10)


for _name, _share, _dir in (("reputation_top", "positive_pct", "DESC"), ("reputation_bottom", "negative_pct", "ASC")):
    @query(_name, f"""
        SELECT business_id, array_to_string(categories, ', ') AS categories, total_reviews,
               round(avg_sentiment_score, 10) AS avg_sentiment_score, {_share}, avg_stars
        FROM ({_REPUTATION}) WHERE avg_sentiment_score IS NOT NULL AND total_reviews >= {MIN_RANKED}
        ORDER BY round(avg_sentiment_score, 9) {_dir}, business_id LIMIT 10""")
    def _(spark, sf, best=_dir == "DESC"):
        ranked = rep.rank_reputation(reputation(spark, sf), MIN_RANKED, best=best)
        ranked = ranked.withColumn("categories", F.array_join("categories", ", "))
        return rounded(ranked, "avg_sentiment_score", digits=10)


@query("sentiment_by_year", f"""
    SELECT year, round(avg_sentiment, 6) AS avg_sentiment, review_count, round(avg_pos_prob, 6) AS avg_pos_prob,
           round(avg(avg_sentiment) OVER (), 6) AS mean_of_years, year IN (1998, 1999) AS is_marked
    FROM (SELECT year, avg(sentiment_score) AS avg_sentiment, count(*) AS review_count, avg(pos_prob) AS avg_pos_prob
          FROM ({st.SCORED}) WHERE sentiment_score IS NOT NULL AND year BETWEEN {YEARS[0]} AND {YEARS[1]}
          GROUP BY year HAVING count(*) >= {MIN_YEAR})""")
def _(spark, sf):
    table = rep.sentiment_by_year(st.scores(spark, sf), YEARS, MIN_YEAR, marked=(1998, 1999))
    return rounded(table, "avg_sentiment", "avg_pos_prob", "mean_of_years")


@query("sentiment_by_state", f"""
    SELECT state, review_count, round(avg_sentiment, 6) AS avg_sentiment, round(pct_positive, 6) AS pct_positive,
           avg_sentiment >= avg(avg_sentiment) OVER () AS above_mean
    FROM (SELECT state, count(*) AS review_count, avg(sentiment_score) AS avg_sentiment, avg(pos_prob) AS pct_positive
          FROM ({st.SCORED}) WHERE state IS NOT NULL AND sentiment_score IS NOT NULL
          GROUP BY state HAVING count(*) >= {MIN_STATE})""")
def _(spark, sf):
    table = rep.sentiment_by_state(st.scored_reviews(spark, sf), MIN_STATE)
    return rounded(table, "avg_sentiment", "pct_positive")


@query("open_closed", f"""
    SELECT is_open, count(*) AS n_businesses, round(avg(avg_sentiment_score), 6) AS mean_sentiment,
           round(avg(avg_stars), 6) AS mean_stars, round(avg(positive_pct), 6) AS mean_positive_pct
    FROM ({_REPUTATION}) WHERE avg_sentiment_score IS NOT NULL AND is_open IS NOT NULL GROUP BY is_open""")
def _(spark, sf):
    table = rep.open_closed(reputation(spark, sf))
    return rounded(table, "mean_sentiment", "mean_stars", "mean_positive_pct")


@query("score_histogram", """
    WITH edges AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
                          avg(l_extendedprice) AS mean FROM lineitem),
         binned AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 50.0::DOUBLE)) AS BIGINT), 49) AS bin
                    FROM lineitem, edges)
    SELECT g.bin, coalesce(b.n, 0) AS n, round(lo + g.bin * ((hi - lo) / 50.0::DOUBLE), 6) AS bin_start,
           round(mean, 6) AS mean
    FROM (SELECT range AS bin FROM range(50)) g
    LEFT JOIN (SELECT bin, count(*) AS n FROM binned GROUP BY bin) b USING (bin), edges""")
def _(spark, sf):
    return rounded(agg.histogram(st.table(spark, sf, "lineitem"), "l_extendedprice"), "bin_start", "mean")


@query("reputation_histogram", f"""
    WITH scores AS (SELECT round(avg_sentiment_score, 9) AS v FROM ({_REPUTATION})
                    WHERE avg_sentiment_score IS NOT NULL),
         edges AS (SELECT min(v) AS lo, max(v) AS hi, avg(v) AS mean FROM scores),
         binned AS (SELECT least(CAST(floor((v - lo) / ((hi - lo) / 50.0::DOUBLE)) AS BIGINT), 49) AS bin
                    FROM scores, edges)
    SELECT g.bin, coalesce(b.n, 0) AS n, round(lo + g.bin * ((hi - lo) / 50.0::DOUBLE), 6) AS bin_start,
           round(mean, 6) AS mean
    FROM (SELECT range AS bin FROM range(50)) g
    LEFT JOIN (SELECT bin, count(*) AS n FROM binned GROUP BY bin) b USING (bin), edges""")
def _(spark, sf):
    scores = rounded(reputation(spark, sf), "avg_sentiment_score", digits=9)
    return rounded(agg.histogram(scores, "avg_sentiment_score"), "bin_start", "mean")


# ---------------------------------------------------------------- fitted pipeline

_LABELLED = f"""
    SELECT r.review_id, length(r.text) AS review_length,
           length(r.text) - length(replace(r.text, '!', '')) AS num_exclamations,
           length(regexp_replace(r.text, '[^A-Z]', '', 'g')) AS num_caps,
           coalesce(u.average_stars, 0) AS average_stars, coalesce(u.review_count, 0) AS user_review_count,
           coalesce(u.fans, 0) AS fans, coalesce(u.review_count, 0) + coalesce(u.fans, 0) AS user_activity,
           u.useful + u.funny + u.cool AS user_engagement, coalesce(b.stars, 0) AS business_stars,
           coalesce(b.review_count, 0) AS business_review_count, coalesce(b.is_open, 0) AS is_open,
           coalesce(len(string_split(c.date, ', ')), 0) AS checkin_count, coalesce(ut.n, 0) AS user_tip_count,
           year(r.date) AS year, month(r.date) AS month, b.categories
    FROM ({st.TEXT_REVIEWS}) r LEFT JOIN ({st.BUSINESSES}) b USING (business_id)
    LEFT JOIN ({st.USERS}) u USING (user_id) LEFT JOIN ({st.CHECKINS}) c USING (business_id)
    LEFT JOIN (SELECT user_id, count(*) AS n FROM ({st.TIPS}) GROUP BY 1) ut USING (user_id)
    WHERE r.stars IS NOT NULL"""

# Undersampled to the size of the middle class by a hash of the review, as the models' rows are.
_BALANCED = f"""
    WITH rows AS (SELECT *, CASE WHEN stars <= 2 THEN 0 WHEN stars = 3 THEN 1 ELSE 2 END AS label
                  FROM ({_LABELLED.replace('SELECT r.review_id,', 'SELECT r.review_id, r.stars,')})),
         sizes AS (SELECT label, count(*) AS n FROM rows GROUP BY label)
    SELECT rows.* FROM rows JOIN sizes USING (label)
    WHERE label = 1 OR {_uniform('balance', 42, 'review_id')}
                       < least(1.0::DOUBLE, (SELECT n FROM sizes WHERE label = 1)::DOUBLE / n)"""
_TRAIN = f"SELECT * FROM ({_BALANCED}) WHERE {_uniform('split', 25, 'review_id')} < 0.8::DOUBLE"

_TEXTS = _LABELLED.replace("WHERE r.stars IS NOT NULL", "").replace("SELECT r.review_id,", """
    SELECT r.stars, u.useful AS user_useful, u.funny AS user_funny, u.cool AS user_cool,
           CASE WHEN r.stars <= 2 THEN 0 WHEN r.stars = 3 THEN 1 ELSE 2 END AS label,""")


def _correlations(cols: tuple[str, ...]) -> str:
    cells = ", ".join(f"{{'x': '{x}', 'y': '{y}', 'r': corr({x}, {y})}}" for x in cols for y in cols)
    value = "CASE WHEN NOT isnan(c.r) THEN round(c.r, 6) + 0.0 END"  # a constant column has no correlation
    return f"SELECT c.x, c.y, {value} AS r FROM (SELECT unnest([{cells}]) AS c FROM ({_TEXTS}))"


for _name, _cols in (
    ("review_correlations", ("stars", "user_useful", "user_funny", "user_cool", "review_length",
                             "user_review_count", "fans")),
    ("feature_correlations", ("label", *NUMERIC_FEATURES)),
):
    @query(_name, _correlations(_cols))
    def _(spark, sf, cols=_cols):
        matrix = agg.correlation_matrix(ml.text_wide(spark, sf), list(cols))
        return matrix.withColumn("r", F.round("r", 6) + F.lit(0.0))


@query("scalar_feature_scale", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(stddev_samp(coalesce({c}, 0)), 6) AS stddev FROM ({_TRAIN})"
    for c in NUMERIC_FEATURES))
def _(spark, sf):
    fitted = ml.trained(spark, sf).pipeline.stages[-1].std.toArray()[-len(NUMERIC_FEATURES):]
    rows = [(name, round(float(std), 6)) for name, std in zip(NUMERIC_FEATURES, fitted)]
    return from_rows(spark, rows, "feature string, stddev double")


@query("category_vocabulary", f"""
    SELECT tag FROM (SELECT DISTINCT review_id, unnest(string_split(categories, ', ')) AS tag FROM ({_TRAIN}))
    GROUP BY tag HAVING count(*) >= 3
    ORDER BY count(*) DESC, tag LIMIT 200""")
def _(spark, sf):
    vocabulary = ml.trained(spark, sf).pipeline.stages[4].vocabulary
    return from_rows(spark, [(tag,) for tag in vocabulary], "tag string")


# ---------------------------------------------------------------- models (SQL in model_sql.py)


@query("feature_pipeline")
def _(spark, sf):
    parts = F.unwrap_udt("features")
    return ml.trained(spark, sf).features.select(
        "review_id", "label", "classWeight",
        F.coalesce(parts["size"], F.size(parts["values"])).alias("n_features"),
        F.size(F.filter(parts["values"], lambda v: v != 0)).alias("n_nonzero"),
    )


@query("feature_vectors")
def _(spark, sf):
    fit = ml.trained(spark, sf)
    names = tables.feature_table(spark, fit.pipeline).drop("scale")
    rows = tables.feature_rows(fit.features, ["review_id"]).join(names, "position")
    return rows.select("review_id", "position", "feature", "kind", F.round("value", 6).alias("value"))


@query("score_lr_by_table")
def _(spark, sf):
    fit = ml.trained(spark, sf)
    weights = tables.linear_table(spark, fit.lr())
    scored = tables.linear_scores(tables.feature_rows(fit.test, ["review_id"]), weights, ["review_id"], len(ev.CLASSES))
    return rounded(scored, *[f"probability_{c}" for c in ev.CLASSES])


@query("feature_names")
def _(spark, sf):
    names = ev.feature_names(ml.trained(spark, sf).pipeline)
    return from_rows(spark, [(i, *pair) for i, pair in enumerate(names)], "position int, feature string, kind string")


@query("training_split", f"""
    SELECT review_id, label, CASE WHEN {_uniform('split', 25, 'review_id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END
               AS part
    FROM ({_BALANCED})""")
def _(spark, sf):
    train, test = ml.parts(spark, sf)
    rows = [p.select("review_id", "label").withColumn("part", F.lit(n)) for n, p in (("train", train), ("test", test))]
    return sampling.union_all(*rows)


# Three texts as one would type them in, with the other features of the average review.
_TYPED = ("the of and to in is that with for was", "loser stupid worthless garbage hate", "word | word | word")


@query("score_given_rows")
def _(spark, sf):
    fit = ml.trained(spark, sf)
    means = fit.rows.agg(*[F.avg(c).alias(c) for c in NUMERIC_FEATURES])
    rows = means.select("*", F.explode(F.array(*map(F.lit, _TYPED))).alias("text"), F.array(F.lit("None")).alias("categories"))
    scored = score_rows(fit.pipeline, fit.lr(), rows, 6)
    return scored.select("text", "prediction", *[
        F.get("probability", F.lit(c)).alias(f"probability_{c}") for c in ev.CLASSES])


for _name in ("lr", "rf", "mlp"):
    @query(f"score_{_name}")
    def _(spark, sf, name=_name):
        rounded_probs = F.transform(vector_to_array(F.col("probability")), lambda p: F.round(p, 6))
        scored = ml.held_out_predictions(spark, sf, name)
        return scored.select("review_id", "label", "prediction", *[
            F.get(rounded_probs, F.lit(c)).alias(f"probability_{c}") for c in ev.CLASSES])


    @query(f"reloaded_{_name}")
    def _(spark, sf, name=_name):
        """Held-out documents anew from their texts, by the feature pipeline and the model saved and loaded."""
        fit, folder = ml.trained(spark, sf), ml.shared_folder(spark, sf, "models")
        save_models({"features": fit.pipeline, name: getattr(fit, name)()}, folder)
        loaded = load_models(folder, ("features", name))
        rounded_probs = F.transform(vector_to_array(F.col("probability")), lambda p: F.round(p, 6))
        scored = score(loaded[name], featurize(loaded["features"], ml.parts(spark, sf)[1]))
        return scored.select("review_id", "label", "prediction", *[
            F.get(rounded_probs, F.lit(c)).alias(f"probability_{c}") for c in ev.CLASSES])


@query("sentiment_scores")
def _(spark, sf):
    scored = ml.scored_texts(spark, sf)
    cols = ("review_id", "business_id", "prediction", "pos_prob", "neg_prob", "sentiment_score")
    return rounded(scored.select(*cols), "pos_prob", "neg_prob", "sentiment_score")


@query("sentiment_reputation")
def _(spark, sf):
    return rep.business_reputation(ml.scored_texts(spark, sf), MIN_BUSINESS)


@query("compare_models")
def _(spark, sf):
    names = {"Logistic Regression": "lr", "Random Forest": "rf", "MLP": "mlp"}
    return ev.compare_models({k: ml.held_out_predictions(spark, sf, v) for k, v in names.items()})


@query("lr_importance")
def _(spark, sf):
    fit = ml.trained(spark, sf)
    return rounded(ev.lr_importance(spark, fit.pipeline, fit.lr()), "importance")


@query("rf_importance")
def _(spark, sf):
    fit = ml.trained(spark, sf)
    return rounded(ev.rf_importance(spark, fit.pipeline, fit.rf()), "importance")


for _name, _class in (("negative_drivers", 0), ("positive_drivers", 2)):
    @query(_name)
    def _(spark, sf, cls=_class):
        fit = ml.trained(spark, sf)
        return ev.class_drivers(spark, fit.pipeline, fit.lr(), cls)
