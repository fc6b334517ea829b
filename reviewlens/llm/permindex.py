"""Approximate nearest neighbours with a permutation index.

Pivots are chosen from a bounded sample. A vector is represented by its nearest pivots in order; the index is cut into
shards by a hash, and a shard posts its vectors in one inverted file per pivot, with the pivot's place in each. A query
walks the files of its own nearest pivots, which gives the footrule distance of every vector that shares one of them;
the best share of a shard by footrule is then ranked by true distance. Shards and blocks of queries meet in groups of
bounded size, and each group gives its nearest few per query, of which the nearest are taken over all shards.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import vectors
from reviewlens.llm.common import slices, stored
from reviewlens.llm.covertree import far_apart


@dataclass(frozen=True)
class IndexConfig:
    """`sample` vectors at most are read to choose the `pivots`; every vector is indexed.

    Of a vector the `prefix` nearest pivots are kept. `share` of each shard, and at least `least` vectors, are ranked
    by true distance, with all that tie with the last of them, and all whose pivots come in nearly the query's order: those
    that save `alike` of what an equal order saves. Of a large group of near copies the pivots can say no more.
    """

    pivots: int = 128
    sample: int = 4000
    prefix: int = 64
    share: float = 0.2
    least: int = 400
    alike: float = 0.9
    shard: int = 4096
    query_block: int = 2048


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the nearest pivots of each vector, nearest first; ties go to the lower number."""
    away = (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T
    return np.argsort(away, axis=1, kind="stable")[:, :prefix].astype(np.int16)


def inverted_files(near: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the vectors that have it among their nearest, and its place there."""
    order = np.argsort(near.ravel(), kind="stable")
    cuts = np.searchsorted(near.ravel()[order], np.arange(pivots + 1))
    prefix = near.shape[1]
    return [(order[a:b] // prefix, order[a:b] % prefix) for a, b in zip(cuts[:-1], cuts[1:])]


def footrule_gain(files: list, near: np.ndarray, n: int) -> np.ndarray:
    """By how much sharing pivots brings each vector nearer to the query than the greatest footrule distance, halved.

    A pivot that one of two prefixes of length k lacks counts as if at place k there. Against a vector that shares
    nothing, a shared pivot at places r and s then saves 2 * (k - max(r, s)).
    """
    gain, k = np.zeros(n, dtype=np.int32), len(near)
    for r, pivot in enumerate(near.tolist()):
        rows, places = files[pivot]
        gain[rows] += k - np.maximum(places, r)
    return gain


def search_shard(x: np.ndarray, near: np.ndarray, queries: np.ndarray, query_near: np.ndarray, k: int,
                 cfg: IndexConfig, pivots: int):
    """For each query the rows of the shard nearest by true distance among the best by footrule, and the distances."""
    files, n = inverted_files(near, pivots), len(x)
    wanted = min(n, max(cfg.least, int(np.ceil(cfg.share * n))))
    equal = near.shape[1] * (near.shape[1] + 1) / 2 if n else 0
    for query, own in zip(queries, query_near):
        if wanted < n:
            gain = footrule_gain(files, own, n)
            last = np.partition(gain, n - wanted)[n - wanted]
            rows = np.flatnonzero(gain >= min(last, cfg.alike * equal))
        else:
            rows = np.arange(n)
        away = np.sqrt(((x[rows] - query) ** 2).sum(1))
        best = np.argsort(away, kind="stable")
        # All rows as near as the k-th stay, so that ties can be decided by id.
        if len(best) > k:
            best = best[away[best] <= away[best[k - 1]]]
        yield rows[best], away[best]


def search(table: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           cfg: IndexConfig = IndexConfig()) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: the `k` nearest rows found for each row that `is_query` names.

    `score` is the Euclidean distance in double precision; ties go to the smaller key. A query's candidates are all
    rows but those with its own key. Vectors that are null, empty, zero or hold null or non-finite components take no
    part, nor do rows with a null key or with another dimension than the most frequent one. Rows that repeat both key
    and vector are one row, as query and as candidate; a key with several vectors asks once for each of them and may be
    given once for each. With fewer than `k` candidates all are given; an empty table gives no rows.
    """
    rows = table.select(
        F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter(F.col("key").isNotNull() & vectors.usable(F.col("vector")))
    rows = rows.withColumn("print", vectors.fingerprint(F.col("vector"))).groupBy("key", "print").agg(
        F.first("vector").alias("vector"), F.bool_or("is_query").alias("is_query"))
    rows = stored(rows, "vectors")
    dimension = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dimension is None:
        return _empty(table, key)
    rows = rows.filter(F.size("vector") == dimension["dim"])
    # Equal vectors are one entry. Of their keys, those that a query can ever be given are the first k and its own.
    by_key = Window.partitionBy("print").orderBy("key")
    entries = rows.withColumn("nth", F.row_number().over(by_key)).filter(F.col("nth") <= k + 1)
    keys = stored(entries.select("print", "key"), "keys")
    one = entries.filter("nth = 1").select("print", "vector")
    pivots = far_apart(vectors.sample(one, F.xxhash64("print"), cfg.sample, "vector"), cfg.pivots)
    n_pivots, prefix = len(pivots), min(cfg.prefix, len(pivots))

    def index(batches):
        for batch in slices(batches, 1024):
            near = nearest_pivots(vectors.matrix(batch["vector"]), pivots, prefix)
            yield pa.record_batch([*batch.columns, pa.array([r.tobytes() for r in near], pa.binary())],
                                  names=[*batch.schema.names, "near"])

    def indexed(df: DataFrame) -> DataFrame:
        return df.mapInArrow(index, df.withColumn("near", F.lit(b"")).schema)

    entry = stored(indexed(one), "index")
    asked = stored(indexed(rows.filter("is_query").select("key", "print", "vector")
                            .withColumnRenamed("print", "asks")), "queries")
    shards = max(1, -(-entry.count() // cfg.shard))
    blocks = max(1, -(-asked.count() // cfg.query_block))
    shard = F.pmod(F.xxhash64("print"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("key", "asks"), F.lit(blocks)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    no_key, no_print = F.lit(None).cast(asked.schema["key"].dataType), F.lit(None).cast(entry.schema["print"].dataType)
    met = entry.select(shard.alias("shard"), every(blocks).alias("block"), no_key.alias("key"), no_print.alias("asks"), "print",
                       "vector", "near").unionByName(asked.select(every(shards).alias("shard"), block.alias("block"), "key",
                                                  "asks", no_print.alias("print"), "vector", "near"))
    kind = asked.schema["key"].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        is_entry = np.asarray(group["print"].is_valid())
        x, near = vectors.matrix(group["vector"]), np.frombuffer(
            b"".join(group["near"].to_pylist()), dtype=np.int16).reshape(len(group), prefix)
        own, ask = np.flatnonzero(is_entry), np.flatnonzero(~is_entry)
        who, what, away = [], [], []
        # A query's own vector is no candidate if no other row has it, so one more is kept.
        found = search_shard(x[own], near[own], x[ask], near[ask], k + 1, cfg, n_pivots) if len(own) else ()
        for query, (nearest, distance) in zip(ask, found):
            who.append(np.full(len(nearest), query))
            what.append(own[nearest])
            away.append(distance)
        none = [np.zeros(0, dtype=np.int64)]
        return pa.table({
            "query_id": group["key"].take(pa.array(np.concatenate(who or none))),
            "asks": group["asks"].take(pa.array(np.concatenate(who or none))),
            "print": group["print"].take(pa.array(np.concatenate(what or none))),
            "score": pa.array(np.concatenate(away or none).astype(np.float64))})

    digest = entry.schema["print"].dataType.simpleString()
    shape = f"query_id {kind}, asks {digest}, print {digest}, score double"
    found = met.groupBy("shard", "block").applyInArrow(run, shape)
    # Nearest entries first; their keys are joined to those that can still be among the first k.
    nearest = Window.partitionBy("query_id", "asks").orderBy("score")
    near = found.withColumn("nth", F.rank().over(nearest)).filter(F.col("nth") <= k + 1).drop("nth")
    pairs = near.join(keys, "print").filter(F.col("key") != F.col("query_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "asks").orderBy("score", "key")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("key").alias("vec_id"), "score")


def _empty(table: DataFrame, key: str) -> DataFrame:
    none = table.filter(F.lit(False))
    return none.select(F.col(key).alias("query_id"), F.lit(0).alias("rank"), F.col(key).alias("vec_id"),
                       F.lit(0.0).alias("score"))
