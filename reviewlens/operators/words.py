"""Word tables of review text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import normalise_words, polarity, tokens
from reviewlens.operators.joins import restrict_to_keys
from reviewlens.operators.ranking import top_groups

# Words that carry no sentiment in reviews, and forms that count as one word.
NOISE_WORDS = (
    "get", "got", "told", "called", "said", "call", "came", "even",
    "back", "one", "really", "also", "still", "it.", "take",
)
# The English stop words of Spark's own remover.
STOP_WORDS = tuple((
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out "
    "on off over under again further then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll "
    "she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's "
    "who's why's would"
).split())
NORMAL_FORMS = {"ordered": "order", "came": "come"}


def stop_words() -> list[str]:
    """Spark's English stop words."""
    return list(STOP_WORDS)


def tokenize(df: DataFrame, col: str = "text", out: str = "raw_words") -> DataFrame:
    return df.withColumn(out, tokens(F.col(col)))


def remove_stopwords(df: DataFrame, col: str = "raw_words", out: str = "filtered_words") -> DataFrame:
    stop = stop_words()
    return df.withColumn(out, F.filter(F.col(col), lambda word: ~word.isin(stop)))


def explode_words(
    df: DataFrame,
    text: str,
    keep: list[str],
    noise: tuple[str, ...] = NOISE_WORDS,
    min_len: int = 3,
    forms: dict[str, str] | None = None,
) -> DataFrame:
    """One row per kept word of `text`, beside the `keep` columns.

    Kept are lower-cased tokens of at least `min_len` letters that are neither stop words nor noise and
    consist of letters a-z only.
    """
    word = F.col("word")
    dropped = [*stop_words(), *noise]
    words = df.select(*keep, F.explode(tokens(F.col(text))).alias("word")).filter(
        (F.length(word) >= min_len) & ~word.isin(dropped) & ~word.rlike("[^a-zA-Z]")
    )
    return words.withColumn("word", normalise_words(word, NORMAL_FORMS if forms is None else forms))


def word_table(reviews: DataFrame, text: str = "text", keys: tuple[str, ...] = ("business_id",)) -> DataFrame:
    """Word-grain table of the positive and the negative reviews: keys, `sentiment`, `word`."""
    labelled = reviews.select(*keys, text, polarity(F.col("stars")).alias("sentiment"))
    return explode_words(labelled.filter(F.col("sentiment").isNotNull()), text, [*keys, "sentiment"])


def words_for_businesses(reviews: DataFrame, ids: DataFrame, k: int = 20) -> DataFrame:
    """Most frequent words in the reviews of a short list of businesses.

    The list cuts the reviews down before their text is split.
    """
    chosen = restrict_to_keys(reviews, ids, "business_id")
    return top_groups(word_table(chosen), "word", k, "count")
