"""Importance resampling towards a target distribution, by hashed n-gram features.

A document's weight is the sum, over its features, of the log ratio of target and raw feature probabilities; Gumbel
noise from a hash of its key turns the highest sums into a draw without replacement. Features are runs of 1 to `grams`
consecutive words, hashed into `buckets`.

Texts are read by batch concatenation: a batch's texts are joined with separators, one pass of one regular expression
finds all words, their document comes from a search of their places in the sorted offsets of the texts, runs over
the end of a document are masked by it, and counts and sums are one `bincount` each.

Bucket counts (`buckets` numbers) are all that reaches the driver from the texts. Ranks come from a range partitioned
sort with one offset for each partition, so no task sees more than its range.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.llm.common import free_name, nullable, stored

SEPARATOR = b"\n"
BATCH_BYTES = 1 << 20
#: Words in UTF-8 whose A-Z are lower-cased: digits, a-z and every byte beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOUND = np.dtype([("start", np.int64), ("end", np.int64), ("crc", np.uint32)])


@dataclass(frozen=True)
class ResampleConfig:
    grams: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: str = "2024"


@dataclass(frozen=True)
class Batch:
    """Features of a batch of texts: the document (its place in the batch) and bucket of each, words per document."""

    documents: np.ndarray
    buckets: np.ndarray
    words: np.ndarray


def batch_features(texts: list[str | None], cfg: ResampleConfig) -> Batch:
    """All features of the texts; a null text is empty and has none."""
    encoded = [(text or "").encode().lower() for text in texts]
    offsets = np.fromiter(accumulate((len(e) + len(SEPARATOR) for e in encoded), initial=0), np.int64)
    joined = SEPARATOR.join(encoded)
    found = np.fromiter(((*m.span(), crc32(m.group())) for m in _WORD.finditer(joined)), _FOUND)
    document = np.searchsorted(offsets, found["start"], side="right") - 1
    documents, hashes, run = [document], [found["crc"]], found["crc"]
    for k in range(1, cfg.grams):
        # A run of k + 1 words goes on from the hash of its first k.
        later = zip(run[: len(found) - k].tolist(), found["start"][k:].tolist(), found["end"][k:].tolist())
        run = np.fromiter((crc32(joined[a:b], crc32(b" ", c)) for c, a, b in later), np.uint32)
        within = document[: len(run)] == document[k : k + len(run)]
        documents.append(document[: len(run)][within])
        hashes.append(run[within])
    return Batch(np.concatenate(documents), np.concatenate(hashes).astype(np.int64) % cfg.buckets,
                 np.bincount(document, minlength=len(texts)))


def _batches(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of some `BATCH_BYTES`, each batch with the row it begins at."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > BATCH_BYTES:
            yield start, column.slice(start, row - start).to_pylist()
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, column.slice(start).to_pylist()


def count_buckets(docs: DataFrame, cfg: ResampleConfig, text: str = "text") -> np.ndarray:
    """Number of features in each bucket, over the whole texts; tasks add up before one row a bucket is shuffled."""

    def run(batches):
        total = np.zeros(cfg.buckets, np.int64)
        for batch in batches:
            for _, texts in _batches(batch.column(0)):
                total += np.bincount(batch_features(texts, cfg).buckets, minlength=cfg.buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(cfg.buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


@dataclass(frozen=True)
class ResampleModel:
    """Gain of each bucket: 1000 times the log ratio of its smoothed shares in target and raw texts, rounded down."""

    cfg: ResampleConfig
    gains: np.ndarray


def fit(docs: DataFrame, target: DataFrame, cfg: ResampleConfig = ResampleConfig(), *, text: str = "text",
        target_text: str = "text") -> ResampleModel:
    """Gains from all texts of both tables; empty tables count as no features (all gains are then of the other's)."""
    raw, wanted = count_buckets(docs, cfg, text), count_buckets(target, cfg, target_text)
    raw_all, wanted_all = float(raw.sum() + cfg.buckets), float(wanted.sum() + cfg.buckets)
    return ResampleModel(cfg, np.array([
        math.floor(1000 * math.log((t + 1) * raw_all / ((s + 1) * wanted_all)))
        for s, t in zip(raw.tolist(), wanted.tolist())], np.int64))


def gumbel(seed: str, key) -> int:
    """1000 times the Gumbel noise of a key, rounded down; a null key counts as an empty one."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORES = ("n_words", "n_features", "weight", "score")


def score(docs: DataFrame, model: ResampleModel, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `n_words`, `n_features`, `weight` and `score` (weight plus noise), all long, behind its columns.

    A name that is taken gets underscores in front. Null and empty texts have no features and weight 0; repeated rows
    stay repeated and have equal scores. An empty table gives an empty one.
    """
    cfg, gains = model.cfg, model.gains.astype(np.float64)
    # The key as text, as SQL says it, and the text come last and go again; all else is handed on.
    rows = docs.select("*", F.col(key).cast("string").alias(free_name(docs, "key_text")),
                       F.col(text).cast("string").alias(free_name(docs, "whole_text")))
    kept = len(docs.columns)

    def run(batches):
        for batch in batches:
            keys = batch.column(kept)
            for start, texts in _batches(batch.column(kept + 1)):
                found, n = batch_features(texts, cfg), len(texts)
                features = np.bincount(found.documents, minlength=n)
                # Sums of whole numbers below 2**53 are exact in doubles.
                weight = np.bincount(found.documents, weights=gains[found.buckets], minlength=n).astype(np.int64)
                noise = np.fromiter((gumbel(cfg.seed, k) for k in keys.slice(start, n).to_pylist()), np.int64, n)
                part = batch.slice(start, n)
                added = [pa.array(a, pa.int64()) for a in (found.words, features, weight, weight + noise)]
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *added], names=names)

    fields = list(nullable(docs.schema).fields)
    for wish in SCORES:
        fields.append(T.StructField(free_name(docs, wish), T.LongType()))
    names = [f.name for f in fields]
    return rows.mapInArrow(run, T.StructType(fields))


def draw(scored: DataFrame, cfg: ResampleConfig = ResampleConfig(), *, key: str = "doc_id", words: str = "n_words",
         score: str = "score", out: str = "rank") -> DataFrame:
    """`scored` with `out`: 1, 2, 3... for the drawn rows in falling order of score, null for all others.

    Of the N rows with at least `least_words` words, floor(percent * N / 100) with the highest scores are drawn; ties
    go to the smaller key, null keys last. Of rows that are repeated altogether any may be drawn, they are the same.
    A table without such rows has no drawn ones. The rows are written once, so ranks fit them after a lost executor.
    """
    spark = scored.sparkSession
    rows = stored(scored, "scored")
    able = F.coalesce(F.col(words) >= cfg.least_words, F.lit(False))
    order = [F.col(score).desc_nulls_last(), F.col(key).asc_nulls_last()]
    row, place, part, before = (free_name(scored, n) for n in ("row", "place", "part", "before"))
    # The row number parts rows that are repeated altogether; written rows always have the same one.
    numbered = rows.filter(able).withColumn(row, F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*order, F.col(row)).sortWithinPartitions(*order, F.col(row)).drop(row)
    placed = stored(ranged.withColumn(place, F.monotonically_increasing_id()), "ranked")
    placed = placed.select("*", F.shiftright(place, 33).alias(part)).withColumn(
        place, F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    # One row for each partition of the sort.
    counts = sorted((r[part], r["n"]) for r in placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect())
    drawn = cfg.percent * sum(n for _, n in counts) // 100
    starts = list(accumulate((n for _, n in counts), initial=0))
    table = spark.createDataFrame(
        [(p, s) for (p, _), s in zip(counts, starts)], T.StructType([
            T.StructField(part, T.LongType()), T.StructField(before, T.LongType())]))
    rank = F.col(before) + F.col(place) + 1
    ranks = placed.join(F.broadcast(table), part).select(*scored.columns, F.when(rank <= drawn, rank).alias(out))
    return ranks.unionByName(rows.filter(~able).select("*", F.lit(None).cast("long").alias(out)))


def resample(docs: DataFrame, target: DataFrame, cfg: ResampleConfig = ResampleConfig(), *, key: str = "doc_id",
             text: str = "text", target_text: str = "text") -> DataFrame:
    """The drawn rows of `docs`, with its columns."""
    words, total, rank = (free_name(docs, n) for n in ("n_words", "score", "rank"))
    scored = score(docs, fit(docs, target, cfg, text=text, target_text=target_text), key=key, text=text)
    ranked = draw(scored, cfg, key=key, words=words, score=total, out=rank)
    return ranked.filter(F.col(rank).isNotNull()).select(*docs.columns)
