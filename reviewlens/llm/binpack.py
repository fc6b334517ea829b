"""Best-fit packing of token pieces into sequences: bin completion by branch and bound on the length histogram.

Pieces of one length are alike, so the search works on how many pieces of each length there are: at most `capacity`
numbers, whatever the size of the corpus. It repeats a filling as often as its lengths last, so its work is bounded
too. The pieces themselves never leave Spark: they are ranked within their length, and the plan says which place the
r-th piece of a length takes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.chunks import packed, word_chunks, word_table
from reviewlens.llm.common import free_name, slices, stored


@dataclass(frozen=True)
class SearchConfig:
    """Bounds of the search. Every piece is placed in any case.

    `width` fillings are tried around a piece, found in at most `steps` steps; once there is a plan, `nodes` more
    fillings are tried to better it.
    """

    width: int = 4
    steps: int = 200
    nodes: int = 1_500


def tokenize(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text"):
    """Pieces of each document: `key`, `piece` (from 0), `start`, `length`, `ids` (little-endian 32-bit, in bytes).

    A document is the ids of its whole text and `end_id`; a null text has only the latter. Documents above `capacity`
    are cut into pieces of that length and a last one. Repeated rows stay repeated; an empty table gives no pieces.
    """
    end = packed([end_id])

    def run(batches):
        table, step = word_table(tokenizer), 4 * capacity
        for batch in slices(batches):
            joined = table.join([word_chunks(t or "") for t in batch.column(1).to_pylist()])
            rows, pieces, starts, lengths, data = [], [], [], [], []
            for row, ids in enumerate(joined):
                whole = ids + end
                for start in range(0, len(whole), step):
                    part = whole[start : start + step]
                    rows.append(row)
                    pieces.append(start // step)
                    starts.append(start // 4)
                    lengths.append(len(part) // 4)
                    data.append(part)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(data, pa.binary())],
                names=["key", "piece", "start", "length", "ids"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids binary").withColumnRenamed(
        "key", key)


# ---------------------------------------------------------------- the plan

Filling = tuple[int, ...]
Pattern = tuple[int, Filling]  # how often, and the lengths of one sequence


def lower_bound(counts: np.ndarray) -> int:
    """No packing needs fewer sequences: by the sum of lengths, and since no two above half fit together."""
    capacity = len(counts) - 1
    total = int((counts * np.arange(capacity + 1)).sum())
    return max(-(-total // capacity), int(counts[capacity // 2 + 1 :].sum()))


def fillings(counts: np.ndarray, room: int, slack: int, steps: int) -> Iterator[tuple[int, Filling]]:
    """Undominated ways to fill `room`, as (waste, lengths): largest lengths first, at most `steps` of them tried.

    A length that fills the rest exactly dominates all others, so nothing else is tried there. A filling is also
    dominated, and left out, if one of its lengths could be a longer one within the waste.
    """
    lengths = np.flatnonzero(counts[: room + 1])
    lengths = lengths[lengths > 0].tolist()
    used: Counter[int] = Counter()
    left = steps

    def longer_fits(x: int, waste: int) -> bool:
        return any(counts[y] > used[y] for y in range(x + 1, x + waste + 1)) if waste < 64 else True

    def search(top: int, rest: int, chosen: Filling) -> Iterator[tuple[int, Filling]]:
        nonlocal left
        if rest <= room and rest > 0 and counts[rest] > used[rest] and (not chosen or rest <= chosen[-1]):
            yield 0, (*chosen, rest)
            return
        i = int(np.searchsorted(lengths, min(top, rest), side="right")) - 1
        fitted = False
        while i >= 0 and left > 0:
            x = lengths[i]
            if used[x] < counts[x]:
                left -= 1
                fitted = True
                used[x] += 1
                yield from search(x, rest - x, (*chosen, x))
                used[x] -= 1
            i -= 1
        if not fitted and rest <= slack and (chosen or not lengths):
            if not any(longer_fits(x, rest) for x in set(chosen)):
                yield rest, chosen

    yield from search(room, room, ())


def best_fit(counts: np.ndarray, room: int) -> tuple[int, Filling]:
    """The longest length that fits, again and again."""
    left, chosen, taken = room, [], Counter()
    while left > 0:
        fitting = np.flatnonzero(counts[: left + 1])
        fitting = [x for x in fitting[::-1][: len(taken) + 1].tolist() if x and counts[x] > taken[x]]
        if not fitting:
            break
        chosen.append(fitting[0])
        taken[fitting[0]] += 1
        left -= fitting[0]
    return left, tuple(chosen)


def options(counts: np.ndarray, slack: int, cfg: SearchConfig) -> list[tuple[int, Filling]]:
    """The sequences to try around the largest piece left, least waste first; best fit is always among them."""
    largest = int(np.flatnonzero(counts)[-1])
    room = len(counts) - 1 - largest
    counts[largest] -= 1
    found = {best_fit(counts, room)}
    for waste, filling in fillings(counts, room, slack, cfg.steps):
        found.add((waste, filling))
        if len(found) > cfg.width and min(found)[0] == 0:
            break
    counts[largest] += 1
    ranked = sorted(found, key=lambda f: (f[0], len(f[1]), tuple(-x for x in f[1])))
    return [(waste, (largest, *filling)) for waste, filling in ranked if waste <= slack][: cfg.width]


def repeats(counts: np.ndarray, lengths: Filling) -> int:
    return min(int(counts[x]) // k for x, k in Counter(lengths).items())


def complete_bins(lengths: dict[int, int], capacity: int, cfg: SearchConfig = SearchConfig()) -> list[Pattern]:
    """Pack pieces, given as their number by length (1 to `capacity`), into few sequences.

    Depth first: take the largest piece left, complete its sequence in the undominated ways, least waste first. A
    branch is cut once its waste is more than a plan with fewer sequences than the best one yet can have. The first
    descent is a best-fit plan, the incumbent; the search ends when the lower bound is met or the nodes are used up.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in lengths.items():
        counts[length] += n
    total = int((counts * np.arange(capacity + 1)).sum())
    if not total:
        return []
    bound, best, best_bins = lower_bound(counts), [], None
    allowed, waste, bins, nodes = capacity * int(counts.sum()), 0, 0, 0
    path: list[Pattern] = []
    stack = [iter(options(counts, allowed, cfg))]
    wastes: list[int] = []
    while stack:
        choice = next(stack[-1], None)
        if choice is None:
            stack.pop()
            if path:
                times, filling = path.pop()
                np.add.at(counts, list(filling), times)
                waste -= wastes.pop()
                bins -= times
            continue
        lost, filling = choice
        times = repeats(counts, filling)
        if lost and waste + lost * times > allowed:
            times = (allowed - waste) // lost
        if times < 1:
            continue
        nodes += best_bins is not None
        np.subtract.at(counts, list(filling), times)
        path.append((times, filling))
        wastes.append(lost * times)
        waste += lost * times
        bins += times
        if not counts.any():
            if best_bins is None or bins < best_bins:
                best, best_bins = list(path), bins
                allowed = (best_bins - 1) * capacity - total
            if best_bins == bound:
                break
            stack.append(iter(()))
        elif nodes > cfg.nodes:
            break
        else:
            stack.append(iter(options(counts, allowed - waste, cfg)))
    return best


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Runs of ranks: the pieces of `length` from rank `first` on take `copies` places each in the sequences from
    `sequence` on, at `offset` and every `length` behind it."""
    runs, taken, sequence = [], Counter(), 0
    for times, filling in patterns:
        offset = 0
        for length, copies in sorted(Counter(filling).items(), reverse=True):
            runs.append((length, taken[length], copies, sequence, offset))
            taken[length] += times * copies
            offset += length * copies
        sequence += times
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T))


# ---------------------------------------------------------------- the pieces


def ranked(pieces: DataFrame, order: list[str], length: str, rank: str) -> DataFrame:
    """Number the rows of each length from 0, without bringing a frequent length together in one task.

    Rows are ranked within a bucket of their length, by a hash of the ordering columns, and the sizes of the buckets
    before are added.
    """
    spark = pieces.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket, before = free_name(pieces, "bucket"), free_name(pieces, "before")
    rows = pieces.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy(length, bucket).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(length).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy(length, bucket).orderBy(*order)) - 1
    return rows.withColumn(rank, within).join(sizes, [length, bucket]).withColumn(
        rank, F.col(rank) + F.col(before)).drop(bucket, before)


def pack(pieces: DataFrame, order: list[str], capacity: int, length: str = "length",
         cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """Add `sequence_id` (from 0) and `offset` (gapless from 0) to every piece; no sequence exceeds `capacity`.

    `order` are columns that tell pieces apart; rows that they do not tell apart take places of their own in any
    order. A piece whose length is null, below 1 or above `capacity` has no place (nulls). Further columns stay,
    also those named like the new ones, which are replaced. An empty table stays empty.
    """
    rows = stored(pieces.drop("sequence_id", "offset"), "pieces")
    fits = F.coalesce(F.col(length).between(1, capacity), F.lit(False))
    histogram = rows.filter(fits).groupBy(length).count().collect()  # at most `capacity` rows
    plan = places(complete_bins({r[0]: r[1] for r in histogram}, capacity, cfg))
    plan_key = (plan["length"] << 44) + plan["first"]
    rank = free_name(rows, "rank")
    placed = ranked(rows.filter(fits), order, length, rank)

    def assign(batches):
        for batch in batches:
            size = np.asarray(batch[length].cast(pa.int64()))
            nth = np.asarray(batch[rank].cast(pa.int64()))
            run = np.searchsorted(plan_key, (size << 44) + nth, side="right") - 1
            nth = nth - plan["first"][run]
            copies = plan["copies"][run]
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != rank]
            yield pa.record_batch(
                [*columns, pa.array(plan["sequence"][run] + nth // copies),
                 pa.array(plan["offset"][run] + nth % copies * size)],
                names=[*(n for n in batch.schema.names if n != rank), "sequence_id", "offset"],
            )

    kept = placed.drop(rank)
    schema = kept.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    out = placed.select(*kept.columns, rank).mapInArrow(assign, schema)
    none = F.lit(None).cast("long")
    return out.unionByName(rows.filter(~fits).withColumns({"sequence_id": none, "offset": none})).select(
        *rows.columns, "sequence_id", "offset")


def sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences: `sequence_id` and the `ids` of its pieces, joined by offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    return (
        placed.filter(F.col("sequence_id").isNotNull())
        .groupBy("sequence_id")
        .agg(F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))
    )
