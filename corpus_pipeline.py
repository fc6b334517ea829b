"""From raw documents to packed training sequences: language, quality, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and gives a table, which is written as Parquet and read again as the documents
of the next one. All but the last give rows with the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import binpack, crf, jaccard, langspans
from reviewlens.llm.common import free_name, read, stored

#: A document stays if its languages, each weighed by its letters, are found at least this surely.
LEAST_LANGUAGE = 0.35
#: A document stays if it is at least this likely to be good.
LEAST_QUALITY = 0.7
SEQUENCE_TOKENS, END_ID = 4096, 1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without letters, or whose languages are doubtful, go."""
    lang, score, sure = (free_name(docs, name) for name in ("found_lang", "found_score", "found_sure"))
    found = langspans.identify(docs, langspans.fit(docs), out=lang, score=score, spans=None, certainty=sure)
    return found.filter((F.col(lang) != langspans.UNDETERMINED) & (F.col(sure) >= LEAST_LANGUAGE)).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, fitted to the quality labels, finds good."""
    score = free_name(docs, "found_quality")
    scored = crf.classify(docs, crf.fit(docs, read(spark, sf_dir, "labels")), out=score, lines=None)
    return scored.filter(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by a shingle similarity of 0.8 or more."""
    return jaccard.deduplicate(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in as few sequences as the search finds."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = binpack.tokenize(docs, tokenizer, SEQUENCE_TOKENS, END_ID)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return binpack.pack(digests, ["doc_id", "piece"], SEQUENCE_TOKENS)


STAGES = [
    ("language id", known_language),
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", no_near_duplicates),
    ("best-fit packing", packed_sequences),
]

#: The stages are models and joins that SQL cannot say; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
