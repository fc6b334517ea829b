"""Feature pipeline, class weights, the three classifiers, and scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    StandardScaler,
    StopWordsRemover,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import nan_to_null, tokens
from reviewlens.operators.clean import fill_empty_array, fill_zero
from reviewlens.operators.features import NUMERIC_FEATURES
from reviewlens.operators.sampling import class_counts
from reviewlens.operators.words import STOP_WORDS

CLASSES = (0, 1, 2)


@dataclass(frozen=True)
class ModelConfig:
    """Parameters of the pipeline and of the classifiers."""

    vocab_size: int = 2000
    min_doc_freq: int = 5
    category_vocab: int = 200
    category_min_df: float = 3.0
    lr_iterations: int = 100
    lr_regularisation: float = 0.01
    rf_trees: int = 50
    rf_depth: int = 15
    rf_min_instances: int = 10
    rf_subset: str = "sqrt"
    rf_memory_mb: int = 512
    mlp_hidden: int = 64
    mlp_iterations: int = 100
    mlp_block: int = 512
    seed: int = 42


def build_feature_pipeline(cfg: ModelConfig = ModelConfig()) -> Pipeline:
    """TF-IDF of the text, category counts and the scalar features in one vector of unit variance.

    Vectors stay sparse: nothing is centred.
    """
    return Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="filtered"),
            CountVectorizer(inputCol="filtered", outputCol="term_counts", vocabSize=cfg.vocab_size),
            IDF(inputCol="term_counts", outputCol="text_features", minDocFreq=cfg.min_doc_freq),
            CountVectorizer(
                inputCol="categories",
                outputCol="category_features",
                vocabSize=cfg.category_vocab,
                minDF=cfg.category_min_df,
            ),
            VectorAssembler(
                inputCols=["text_features", "category_features", *NUMERIC_FEATURES],
                outputCol="features_raw",
                handleInvalid="keep",
            ),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=False),
        ]
    )


def featurize(pipeline: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply the fitted pipeline and drop its intermediate columns, which would swell every cache."""
    return pipeline.transform(df).drop(
        "words", "filtered", "term_counts", "text_features", "category_features", "features_raw"
    )


def term_statistics(df: DataFrame, text: str = "text", min_doc_freq: int = 5) -> DataFrame:
    """Per term: occurrences, documents that hold it, and the inverse document frequency.

    The statistics behind the text half of the vector, over the whole vocabulary: a document counts a
    term once, and a term in fewer than `min_doc_freq` documents has weight 0. Each document gives its
    words twice, once all of them and once each distinct one, so the text is read once and nothing but
    (term, counts) is shuffled.
    """
    words = tokens(F.col(text))
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    counts = (
        df.select(words.alias("words"))
        .select(F.posexplode(F.array("words", F.array_distinct("words"))).alias("once", "words"))
        .select("once", F.explode("words").alias("term"))
        .filter(~F.col("term").isin(*STOP_WORDS))
        .groupBy("term")
        .agg(F.count_if(F.col("once") == 0).alias("n_total"), F.count_if(F.col("once") == 1).alias("n_docs"))
    )
    weight = F.log((n_docs + F.lit(1.0)) / (F.col("n_docs") + F.lit(1.0)))
    return counts.withColumn("idf", F.when(F.col("n_docs") >= min_doc_freq, weight).otherwise(F.lit(0.0)))


def add_class_weights(
    df: DataFrame, label: str = "label", classes: tuple[int, ...] = CLASSES, out: str = "classWeight"
) -> DataFrame:
    """Weight each row by n / (number of classes * rows of its class). A row of no listed class gets 1."""
    counts = class_counts(df, label, classes)
    total = counts.agg(F.sum("n_class")).scalar()
    weights = counts.select(label, (total / (F.lit(float(len(classes))) * F.col("n_class"))).alias(out))
    return df.join(F.broadcast(weights), label, "left").fillna({out: 1.0})


def train_lr(df: DataFrame, cfg: ModelConfig = ModelConfig()) -> LogisticRegressionModel:
    """Multinomial logistic regression with L2 regularisation on weighted rows."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="classWeight",
        maxIter=cfg.lr_iterations,
        regParam=cfg.lr_regularisation,
        elasticNetParam=0.0,
        family="multinomial",
    ).fit(df)


def train_rf(df: DataFrame, cfg: ModelConfig = ModelConfig()) -> RandomForestClassificationModel:
    return RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        numTrees=cfg.rf_trees,
        maxDepth=cfg.rf_depth,
        minInstancesPerNode=cfg.rf_min_instances,
        featureSubsetStrategy=cfg.rf_subset,
        maxMemoryInMB=cfg.rf_memory_mb,
        seed=cfg.seed,
    ).fit(df)


def train_mlp(
    df: DataFrame, input_size: int, cfg: ModelConfig = ModelConfig()
) -> MultilayerPerceptronClassificationModel:
    """One hidden layer; `input_size` is the length of the feature vector (see `vector_size`)."""
    return MultilayerPerceptronClassifier(
        featuresCol="features",
        labelCol="label",
        layers=[input_size, cfg.mlp_hidden, len(CLASSES)],
        maxIter=cfg.mlp_iterations,
        blockSize=cfg.mlp_block,
        solver="l-bfgs",
        seed=cfg.seed,
    ).fit(df)


def vector_size(pipeline: PipelineModel) -> int:
    """Length of the feature vector, read from the fitted scaler without a job."""
    return pipeline.stages[-1].std.size


def score(model, featurized: DataFrame) -> DataFrame:
    """Add `prediction` and `probability`; the raw scores are dropped."""
    return model.transform(featurized).drop("rawPrediction")


def class_probability(cls: int):
    """Probability of one class as a double; null where the model gave none."""
    return nan_to_null(F.get(vector_to_array(F.col("probability")), F.lit(cls)))


def score_rows(pipeline: PipelineModel, model, rows: DataFrame, digits: int = 2) -> DataFrame:
    """Score rows given by hand: text, prediction and the rounded probability of each class."""
    scored = score(model, featurize(pipeline, rows))
    rounded = F.transform(vector_to_array(F.col("probability")), lambda p: F.round(p, digits))
    return scored.select("text", "prediction", rounded.alias("probability"))


def sentiment_scores(pipeline: PipelineModel, model, df: DataFrame) -> DataFrame:
    """Score every row: `pos_prob`, `neg_prob` and `sentiment_score` = positive - negative in [-1, 1].

    Numeric gaps are filled before scoring, since a missing feature would otherwise turn into a NaN
    probability and the prediction 0. A row without a valid probability has a null score.
    """
    filled = fill_empty_array(fill_zero(df.fillna({"text": ""}), list(NUMERIC_FEATURES)), "categories")
    scored = score(model, featurize(pipeline, filled))
    scored = scored.withColumns({"pos_prob": class_probability(2), "neg_prob": class_probability(0)})
    return scored.withColumn("sentiment_score", F.col("pos_prob") - F.col("neg_prob")).drop(
        "features", "probability"
    )
