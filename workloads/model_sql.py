"""SQL for the queries that rest on fitted models.

Vectors are computed anew from the given tables. Of a fit, SQL takes what only the fit can say, from the tables that it
has written: which words and tags the vector holds, and the models' parameters.
"""

from __future__ import annotations

from reviewlens.operators.features import NUMERIC_FEATURES
from reviewlens.operators.words import STOP_WORDS
from workloads import registry
from workloads.models import model_folder

_TEST = f"{registry._uniform('split', 25, 'review_id')} >= 0.8::DOUBLE"


def _table(name: str) -> str:
    return f"(SELECT * FROM read_parquet('{model_folder()}/{name}/*.parquet'))"


def _rows(name: str = "rows") -> str:
    """Balanced labelled texts with `test`, as the models' rows are, and those to train on."""
    return f"""
        {name} AS (SELECT *, {_TEST} AS test FROM ({registry._BALANCED.replace('SELECT r.review_id, r.stars,',
                 'SELECT r.review_id, r.text, r.stars,')})),
        train AS (SELECT * FROM {name} WHERE NOT test)"""


def _all_texts() -> str:
    """Every text as a row to score, and the models' rows to take statistics from."""
    every = registry._LABELLED.replace("WHERE r.stars IS NOT NULL", "").replace(
        "SELECT r.review_id,", "SELECT r.review_id, r.business_id, r.text,")
    return _rows("fitted") + f""",
        rows AS ({every})"""


def _vectors(rows: str) -> str:
    """CTEs up to `vectors`: review_id, position and scaled value of what is not zero, of the rows of `rows` and `train`."""
    scalars = " UNION ALL ".join(
        f"SELECT review_id, '{c}' AS feature, CAST(coalesce({c}, 0) AS DOUBLE) AS v FROM source" for c in NUMERIC_FEATURES)

    def raw(name: str, source: str) -> str:
        return f"""
        {name}_terms AS (SELECT review_id, term AS feature, count(*) AS tf
             FROM (SELECT review_id, unnest({registry._TOKENS}) AS term FROM {source})
             WHERE term NOT IN ({registry.quoted(STOP_WORDS)}) GROUP BY 1, 2),
        {name}_tags AS (SELECT review_id, feature, count(*) AS tf
             FROM (SELECT review_id, unnest(string_split(categories, ', ')) AS feature FROM {source}) GROUP BY 1, 2),
        {name}_scalars AS ({scalars.replace('source', source)})"""

    def values(name: str) -> str:
        return f"""
            SELECT review_id, position, tf * idf AS v FROM {name}_terms JOIN idf USING (feature)
            UNION ALL SELECT review_id, position, CAST(tf AS DOUBLE) FROM {name}_tags JOIN names USING (feature) WHERE kind = 'category'
            UNION ALL SELECT review_id, position, v FROM {name}_scalars JOIN names USING (feature) WHERE kind = 'scalar'"""

    return f"""{rows},
        names AS (SELECT position, feature, kind FROM {_table('feature')}),
        n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM train), {raw('fit', 'train')}, {raw('given', 'rows')},
        idf AS (SELECT position, feature, CASE WHEN df >= 5 THEN ln((n + 1) / (df + 1)) ELSE 0.0::DOUBLE END AS idf
                FROM (SELECT feature, count(*) AS df FROM fit_terms GROUP BY 1) JOIN names USING (feature), n WHERE kind = 'text'),
        seen AS ({values('fit')}),
        scales AS (SELECT position, CASE WHEN s > 0 THEN 1 / s ELSE 0 END AS scale FROM (
             SELECT position, sqrt((sum((v - m) * (v - m)) + (max(n) - count(*)) * max(m) * max(m)) / (max(n) - 1)) AS s
             FROM seen JOIN (SELECT position, sum(v) / max(n) AS m FROM seen, n GROUP BY 1) USING (position), n GROUP BY 1)),
        vectors AS (SELECT review_id, position, v * scale AS value FROM ({values('given')}) JOIN scales USING (position)
                    WHERE v * scale <> 0)"""


_SHARES = ", ".join(f"round(CAST(p[{c + 1}] AS DOUBLE), 6) AS probability_{c}" for c in (0, 1, 2))
_BEST = "CAST(list_position(p, list_max(p)) - 1 AS DOUBLE)"
_SOFTMAX = """
        shifted AS (SELECT review_id, list_transform(m, lambda x: exp(x - list_max(m))) AS e FROM margins),
        scored AS (SELECT review_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM shifted)"""


def _linear() -> str:
    return f"""
        weights AS (SELECT * FROM {_table('linear')}),
        sums AS (SELECT review_id, class, sum(value * weight) AS s FROM vectors JOIN weights USING (position) GROUP BY 1, 2),
        margins AS (SELECT review_id, list(s + weight ORDER BY class) AS m
                    FROM sums JOIN weights USING (class) WHERE position = -1 GROUP BY 1), {_SOFTMAX}"""


def _forest() -> str:
    return f"""
        forest AS (SELECT * FROM {_table('forest')}),
        walk AS (SELECT r.review_id, tree, 0 AS node FROM rows r, (SELECT DISTINCT tree FROM forest) WHERE r.test
                 UNION ALL
                 SELECT w.review_id, w.tree, CASE WHEN coalesce(v.value, 0) <= f.threshold THEN f.left ELSE f.right END
                 FROM walk w JOIN forest f ON f.tree = w.tree AND f.node = w.node AND f.position IS NOT NULL
                 LEFT JOIN vectors v ON v.review_id = w.review_id AND v.position = f.position),
        votes AS (SELECT review_id, list_transform(counts, lambda x: x / list_sum(counts)) AS share
                  FROM walk JOIN forest USING (tree, node) WHERE position IS NULL),
        scored AS (SELECT review_id, [avg(share[1]), avg(share[2]), avg(share[3])] AS p FROM votes GROUP BY 1)"""


def _network() -> str:
    return f"""
        network AS (SELECT * FROM {_table('network')}),
        inputs AS (SELECT review_id, position, value FROM vectors UNION ALL SELECT review_id, -1, 1.0 FROM rows),
        hidden AS (SELECT review_id, output, 1 / (1 + exp(-sum(value * weight))) AS value
                   FROM inputs JOIN network ON layer = 0 AND input = position GROUP BY 1, 2),
        outer_inputs AS (SELECT * FROM hidden UNION ALL SELECT review_id, -1, 1.0 FROM rows),
        sums AS (SELECT h.review_id, n.output, sum(value * weight) AS s
                 FROM outer_inputs h JOIN network n ON layer = 1 AND input = h.output GROUP BY 1, 2),
        margins AS (SELECT review_id, list(s ORDER BY output) AS m FROM sums GROUP BY 1), {_SOFTMAX}"""


_MODELS = {"lr": _linear, "rf": _forest, "mlp": _network}


def _held_out(model: str) -> str:
    return f"""WITH RECURSIVE {_vectors(_rows())}, {_MODELS[model]()}
        SELECT review_id, label, {_BEST} AS prediction, {_SHARES} FROM scored JOIN rows USING (review_id) WHERE test"""


def _metrics(model: str, name: str) -> str:
    return f"""
        SELECT '{name}' AS model, CAST(max(n) AS BIGINT) AS n_rows, round(sum(hit) / max(n), 4) AS accuracy,
               round(sum(coalesce(truth / n * 2 * (hit / said) * (hit / truth) / nullif(hit / said + hit / truth, 0), 0)), 4) AS f1,
               round(sum(coalesce(truth / n * (hit / said), 0)), 4) AS weighted_precision,
               round(sum(coalesce(truth / n * (hit / truth), 0)), 4) AS weighted_recall
        FROM (SELECT c, CAST(count(*) FILTER (label = c AND prediction = c) AS DOUBLE) AS hit,
                     nullif(CAST(count(*) FILTER (label = c) AS DOUBLE), 0) AS truth,
                     nullif(CAST(count(*) FILTER (prediction = c) AS DOUBLE), 0) AS said, CAST(count(*) AS DOUBLE) AS n
              FROM ({_held_out(model)}), (SELECT unnest([0, 1, 2]) AS c) GROUP BY c)"""


def _drivers(cls: int) -> str:
    return f"""SELECT position, feature, kind, weight FROM {_table('linear')} JOIN {_table('feature')} USING (position)
               WHERE class = {cls} ORDER BY weight DESC, position LIMIT 20"""


def oracle_sql() -> dict[str, str]:
    """SQL of each query that rests on a fit, over the tables that the session's fits write."""
    return {
        "feature_pipeline": f"""WITH {_vectors(_rows())},
            sizes AS (SELECT label, count(*) AS c FROM train GROUP BY 1),
            filled AS (SELECT review_id, count(*) AS n_nonzero FROM vectors GROUP BY 1)
            SELECT review_id, label, n / (3.0::DOUBLE * c) AS "classWeight",
                   CAST((SELECT count(*) FROM names) AS INTEGER) AS n_features,
                   CAST(coalesce(n_nonzero, 0) AS INTEGER) AS n_nonzero
            FROM train JOIN sizes USING (label) LEFT JOIN filled USING (review_id), n""",
        "feature_vectors": f"""WITH {_vectors(_rows())}
            SELECT review_id, position, feature, kind, round(value, 6) AS value
            FROM vectors JOIN names USING (position) WHERE review_id IN (SELECT review_id FROM train)""",
        **{f"{how}_{model}": _held_out(model) for how in ("score", "reloaded") for model in _MODELS},
        "score_lr_by_table": _held_out("lr").replace("review_id, label,", "review_id,"),
        "compare_models": " UNION ALL ".join(
            _metrics(m, n) for m, n in (("lr", "Logistic Regression"), ("rf", "Random Forest"), ("mlp", "MLP"))),
        "sentiment_scores": f"""WITH {_vectors(_all_texts())}, {_linear()}
            SELECT review_id, business_id, {_BEST} AS prediction, round(CAST(p[3] AS DOUBLE), 6) AS pos_prob,
                   round(CAST(p[1] AS DOUBLE), 6) AS neg_prob, round(CAST(p[3] - p[1] AS DOUBLE), 6) AS sentiment_score
            FROM scored JOIN rows USING (review_id)""",
        "lr_importance": f"""
            SELECT position, feature, kind, round(avg(abs(weight)), 6) AS importance
            FROM {_table('linear')} JOIN {_table('feature')} USING (position) GROUP BY 1, 2, 3
            ORDER BY avg(abs(weight)) DESC, position LIMIT 25""",
        "rf_importance": f"""
            WITH gains AS (SELECT tree, position, sum(gain * list_sum(counts)) AS g FROM {_table('forest')}
                           WHERE position IS NOT NULL GROUP BY 1, 2),
            shares AS (SELECT position, g / sum(g) OVER (PARTITION BY tree) AS share FROM gains),
            whole AS (SELECT position, sum(share) / (SELECT sum(share) FROM shares) AS importance FROM shares GROUP BY 1)
            SELECT position, feature, kind, round(coalesce(importance, 0), 6) AS importance
            FROM {_table('feature')} LEFT JOIN whole USING (position) ORDER BY coalesce(importance, 0) DESC, position LIMIT 25""",
        "negative_drivers": _drivers(0),
        "positive_drivers": _drivers(2),
    }
