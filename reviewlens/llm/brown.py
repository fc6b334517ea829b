"""Brown class-based n-gram scoring: exchange clustering of the words, class transitions, word emissions.

P(text) is the product over its tokens, the closing end token among them, of

    P(class of token | class of token before) * P(token | its class).

What grows with the corpus stays in Spark: the counts of all words are one table, and a text meets the counts of its
rarer words in a join, and the pair counts of neighbouring entries are one table too. Entries are the `head` most
frequent words, one by one, and for all other words, seen or not, the `shapes` most frequent endings (the last two
bytes), one entry for any other ending, and the end.

Exchange clustering has two steps. The `core` most frequent words and the endings are exchanged one by one on the
driver, which needs their pair counts alone. Then rounds over the stored pairs move every other entry at once: tasks
count the classes before and after each entry and move it to the class under which these are likeliest, the class
pairs of the round before being given. Counts travel and are stored as lists, many to a row: a row for each would cost
more than all arithmetic on it. A round that does not raise the likelihood of the whole table is undone and
is the last. The driver and the tasks hold only what is bounded by parameters: the head, and one class for each entry.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import blake2b
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import free_name, slices, stored

ADDED = 0.1
END = b""
LONGEST = 64
_FLUSH = 400_000
_PAIRS_AT_ONCE = 2_000_000
_PAIRS_IN_ROW = 64
_ROWS_AT_ONCE = 8192
_TOKENS_A_PART = 250_000
_PARTS = 16_384
_ENTRIES_A_PART = 128

Judge = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class BrownConfig:
    head: int = 65_536
    core: int = 1024
    shapes: int = 128
    classes: int = 64
    sweeps: int = 8
    rounds: int = 3
    context_weight: float = 50.0


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words between ASCII white space, in bytes; only A-Z are lower-cased. A null text has none."""
    return (text or "").encode().lower().split()


def word_key(word: bytes) -> bytes:
    """The word, or a 128-bit digest and the ending of one above `LONGEST` bytes: keys are short whatever texts hold."""
    return word if len(word) <= LONGEST else b"\0" + blake2b(word, digest_size=16).digest() + word[-2:]


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """`word`, `c`: occurrences of each word over the whole texts, and of the end token under the empty word.

    Tasks count before anything is shuffled, so a frequent word is one row from each. A null text has only its end.
    """

    def run(batches):
        counts: Counter[bytes] = Counter()
        known = 0

        def rows():
            batch = pa.record_batch(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"])
            counts.clear()
            return batch

        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                counts.update(words_of(value))
            counts[END] += batch.num_rows
            new = islice(reversed(counts), max(len(counts) - known, 0))  # a counter keeps the order of its words
            for word in [w for w in new if len(w) > LONGEST]:
                counts[word_key(word)] += counts.pop(word)
            if len(counts) > _FLUSH:
                yield rows()
            known = len(counts)
        yield rows()

    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


# ---------------------------------------------------------------- counts in lists


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """`values` cut into lists of `sizes`."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, pa.int64()))


def _flat(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The numbers of a column, or those of its lists, one list after the other."""
    return np.asarray(pc.list_flatten(column) if pa.types.is_list(column.type) else column)


def _by_part(part: np.ndarray, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row for each part, with the keys that belong there and their counts. There are at most `_PARTS` parts."""
    order = np.argsort(part.astype(np.uint16), kind="stable")  # numbers of two bytes are sorted by radix
    sizes = np.bincount(part)
    parts = np.flatnonzero(sizes)
    return pa.record_batch(
        [pa.array(parts, pa.int32()), _lists(keys[order], sizes[parts]), _lists(n[order], sizes[parts])],
        names=["part", "pair", "n"])


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of the lists `pair`, in order, and the sums of their counts."""
    keys, n = _flat(table["pair"]), _flat(table["n"])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(n[order], starts)


# ---------------------------------------------------------------- classes


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each entry, by exchange clustering of the pair counts; the last entry, the end, keeps its own class.

    Each entry in turn moves to the class that gives the class pairs the highest likelihood, until nothing moves or
    `sweeps` are over. Entries come in order of frequency; entry i begins in class i modulo `classes`.
    """
    n = len(pairs) - 1
    own = np.arange(n + 1) % classes
    own[n] = classes
    one_hot = np.zeros((n + 1, classes + 1))
    one_hot[np.arange(n + 1), own] = 1
    table = one_hot.T @ pairs @ one_hot
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            after = np.bincount(own, weights=pairs[w], minlength=classes + 1)
            before = np.bincount(own, weights=pairs[:, w], minlength=classes + 1)
            twice, old = pairs[w, w], own[w]
            if not after.any() and not before.any():
                continue
            after[old] -= twice
            before[old] -= twice

            def place(k: int, sign: int) -> None:
                table[k] += sign * after
                table[:, k] += sign * before
                table[k, k] += sign * twice

            place(old, -1)
            rows, cols = table.sum(1), table.sum(0)
            joined, diagonal = table + after, np.diag(table)
            gain = (_xlogx(joined) - _xlogx(table)).sum(1) + (
                _xlogx(table.T + before) - _xlogx(table.T)).sum(1)
            gain -= (_xlogx(diagonal + after) - _xlogx(diagonal)) + (_xlogx(diagonal + before) - _xlogx(diagonal))
            gain += _xlogx(diagonal + after + before + twice) - _xlogx(diagonal)
            out_sum, in_sum = after.sum() + twice, before.sum() + twice
            gain -= _xlogx(rows + out_sum) - _xlogx(rows) + _xlogx(cols + in_sum) - _xlogx(cols)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            place(best, 1)
            own[w] = best
            moved += best != old
        if not moved:
            break
    return own


def class_table(pairs: DataFrame, own: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes, the pairs of entries being `pair` (first * entries + second) and `n`.

    A row of `pairs` has one pair and its count, or lists of pairs and of their counts.
    With the entries' own numbers as classes this is the whole pair table; tasks send one row for each pair of classes.
    """
    size, wide = len(own), int(own.max()) + 1
    shared = pairs.sparkSession.sparkContext.broadcast(own.astype(np.int64))

    def run(batches):
        own, total = shared.value, np.zeros(wide * wide, dtype=np.int64)
        for batch in slices(batches, _ROWS_AT_ONCE):
            pair, n = _flat(batch.column(0)), _flat(batch.column(1))
            np.add.at(total, own[pair // size] * wide + own[pair % size], n)
        keys = np.flatnonzero(total)
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(total[keys], pa.int64())], names=["pair", "n"])

    found = pairs.select("pair", "n").mapInArrow(run, "pair long, n long")
    found = found.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(wide * wide)
    table[np.asarray(found["pair"])] = np.asarray(found["n"])
    return table.reshape(wide, wide)


def likelihood(table: np.ndarray) -> float:
    """What the classes add to the log likelihood of the pairs: the mutual information of neighbours, times pairs."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def contexts(pairs: DataFrame, own: np.ndarray, judge: Judge | None = None) -> DataFrame:
    """`entry`, `seen`: how often each class comes after an entry (slot: the class) and before it (slot: K + class).

    An entry has at most two slots a class, so no group is large, however frequent a word is. A task counts all its
    pairs before it sends them in a row for each part; parts are dealt by remainder, so frequent words lie apart.
    With `judge` the result is `entry`, `k`: the entries that it returns of each part's entries and their counts by slot,
    and their classes. It is called where the counts meet, so they need no second Python worker.
    """
    size, wide = len(own), int(own.max()) + 1
    slots, parts = 2 * wide, min(size // _ENTRIES_A_PART + 1, _PARTS)
    shared = pairs.sparkSession.sparkContext.broadcast(own.astype(np.int64))

    def run(batches):
        own, total = shared.value, np.zeros(size * slots, dtype=np.int64)
        for batch in slices(batches, _ROWS_AT_ONCE):
            pair, n = _flat(batch.column(0)), _flat(batch.column(1))
            first, second = pair // size, pair % size
            np.add.at(total, first * slots + own[second], n)
            np.add.at(total, second * slots + wide + own[first], n)
        for start in range(0, len(total), _PAIRS_AT_ONCE):
            keys = np.flatnonzero(total[start : start + _PAIRS_AT_ONCE]) + start
            if len(keys):
                yield _by_part(keys // slots % parts, keys, total[keys])

    def meet(table: pa.Table) -> pa.Table:
        keys, n = _summed(table)
        entries, row, sizes = np.unique(keys // slots, return_inverse=True, return_counts=True)
        if judge is not None:
            dense = np.zeros((len(entries), slots))
            dense[row, keys % slots] = n
            moved, k = judge(entries, dense)
            return pa.table({"entry": pa.array(moved, pa.int32()), "k": pa.array(k, pa.int32())})
        seen = pa.StructArray.from_arrays([pa.array(keys % slots, pa.int32()), pa.array(n)], names=["slot", "n"])
        ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        return pa.table({"entry": pa.array(entries, pa.int32()), "seen": pa.ListArray.from_arrays(ends, seen)})

    found = pairs.select("pair", "n").mapInArrow(run, "part int, pair array<long>, n array<long>")
    kind = "seen array<struct<slot: int, n: bigint>>" if judge is None else "k int"
    return found.groupBy("part").applyInArrow(meet, f"entry int, {kind}")


def best_classes(entries: np.ndarray, seen: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of each of the `entries` under which its neighbours' classes, its row of `seen`, are likeliest.

    The class pairs are given by `table`, from which an entry's own counts are taken before its old class is judged.
    An entry stays where no class is better; of equally good ones it goes to the first. The end's class takes none.
    """
    wide = len(table)
    after, before, old = seen[:, :wide], seen[:, wide:], own[entries]
    n_after, n_before = after.sum(1), before.sum(1)

    def logs(x: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(x, 0) + ADDED)

    rows, cols = table.sum(1), table.sum(0)
    value = after @ logs(table).T + before @ logs(table)
    value -= n_after[:, None] * logs(rows) + n_before[:, None] * logs(cols)
    stay = (after * logs(table[old] - after)).sum(1) + (before * logs(table.T[old] - before)).sum(1)
    stay -= n_after * logs(rows[old] - n_after) + n_before * logs(cols[old] - n_before)
    value[np.arange(len(old)), old] = stay
    best = np.argmax(value[:, : wide - 1], axis=1)
    return np.where(value[np.arange(len(old)), best] > stay + 1e-9, best, old)


def exchange_rounds(pairs: DataFrame, own: np.ndarray, fixed: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all entries and their pair table, after at most `rounds` in which all but `fixed` entries may move.

    The `fixed` first entries and the last one, the end, stay. Tasks send one class for each entry that moves.
    """
    spark = pairs.sparkSession
    table = class_table(pairs, own)
    for _ in range(rounds):
        shared, last = spark.sparkContext.broadcast((own, table)), len(own) - 1

        def judge(entries, seen):
            own, table = shared.value
            best = best_classes(entries, seen, own, table)
            moved = (best != own[entries]) & (entries >= fixed) & (entries < last)
            return entries[moved], best[moved]

        moves = contexts(pairs, own, judge).toArrow()  # one row an entry at most
        if not moves.num_rows:
            break
        after = own.copy()
        after[np.asarray(moves["entry"])] = np.asarray(moves["k"])
        counted = class_table(pairs, after)
        if likelihood(counted) <= likelihood(table):
            break
        own, table = after, counted
    return own, table


@dataclass
class BrownModel:
    """Counts of all words as a table; of the head, the classes and their probabilities as arrays.

    `own` has the class of each entry: the head in its order, the endings, any other ending, the end.
    """

    counts: DataFrame
    tokens: int
    types: int
    head: dict[bytes, int]
    head_count: np.ndarray
    shapes: dict[bytes, int]
    own: np.ndarray
    move: np.ndarray
    spread: np.ndarray


def _endings(head: list[tuple[bytes, int]], cfg: BrownConfig) -> list[bytes]:
    """The most frequent endings of the head's words that are not in the core, ties in byte order."""
    endings: Counter[bytes] = Counter()
    for word, n in head[cfg.core :]:
        endings[word[-2:]] += n
    return sorted(endings, key=lambda e: (-endings[e], e))[: cfg.shapes]


def _pair_counts(docs: DataFrame, head: dict[bytes, int], shapes: dict[bytes, int], size: int, tokens: int) -> DataFrame:
    """Lists `pair`, `n`: counts of neighbouring entries over the whole texts; the end stands on both sides of a text.

    Each pair is in one list, and a list has at most 64. Pairs meet in parts, dealt by their remainder, one for each
    250,000 `tokens`, 16,384 at most: a frequent word's pairs are spread over all of them.
    """
    other, end = size - 2, size - 1
    parts = min(tokens // _TOKENS_A_PART + 1, _PARTS)
    shared = docs.sparkSession.sparkContext.broadcast((head, shapes))

    def run(batches):
        entries, endings = shared.value
        waiting, held = [], 0

        def rows():
            keys, found = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return _by_part(keys % parts, keys, found)

        for batch in slices(batches):
            line = [end]
            for text in batch.column(0).to_pylist():
                for w in words_of(text):
                    e = entries.get(w)
                    if e is None:
                        key = word_key(w)
                        e = entries.get(key)
                        if e is None:
                            e = endings.get(key[-2:], other)
                    line.append(e)
                line.append(end)
            ids = np.array(line, dtype=np.int64)
            waiting.append(ids[:-1] * size + ids[1:])
            held += len(ids)
            if held > _PAIRS_AT_ONCE:
                held = 0
                yield rows()
        if waiting:
            yield rows()

    def meet(table: pa.Table) -> pa.Table:
        keys, n = _summed(table)
        sizes = np.diff(np.append(np.arange(0, len(keys), _PAIRS_IN_ROW), len(keys)))
        return pa.table({"pair": _lists(keys, sizes), "n": _lists(n, sizes)})

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        run, "part int, pair array<long>, n array<long>")
    return found.groupBy("part").applyInArrow(meet, "pair array<long>, n array<long>")


def fit(docs: DataFrame, text: str = "text", cfg: BrownConfig = BrownConfig()) -> BrownModel:
    """Learn from the whole texts of `docs`. An empty table gives a model in which every word is unknown."""
    docs = docs.select(F.col(text).alias("text"))
    counts = stored(count_words(docs), "words")
    total = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    tokens, types = total[0] or 0, total[1]
    words = counts.filter(F.col("word") != END)
    top = words.orderBy(F.desc("c"), "word").limit(cfg.head).toArrow()
    head = [(w, int(n)) for w, n in zip(top["word"].to_pylist(), top["c"].to_pylist())]
    ranked = _endings(head, cfg)
    shapes = {ending: len(head) + i for i, ending in enumerate(ranked)}
    size = len(head) + len(shapes) + 2
    pairs = stored(_pair_counts(docs, {w: i for i, (w, _) in enumerate(head)}, shapes, size, tokens), "pairs")

    # The core's entries: its words, the endings (of all other words, those of the head included), the end.
    core = min(cfg.core, len(head))
    small = core + len(shapes) + 2
    to_core = np.array([
        *range(core), *(shapes.get(w[-2:], size - 2) - len(head) + core for w, _ in head[core:]), *range(core, small)])
    own = exchange(class_table(pairs, to_core), cfg.classes, cfg.sweeps)[to_core]
    own, table = exchange_rounds(pairs, own, core, cfg.rounds)

    # Distinct words of each class: those of the head, and the others by their ending.
    types_of = np.zeros(cfg.classes + 1)
    np.add.at(types_of, own[: len(head)], 1)
    types_of[cfg.classes] = 1
    ending = F.expr("CASE WHEN length(word) <= 2 THEN word ELSE substring(word, -2, 2) END")
    by_ending = {bytes(r[0]): r[1] for r in words.groupBy(ending).count().collect()}  # two bytes: at most 65,793 rows
    for word, _ in head:
        by_ending[word[-2:]] -= 1
    for e, n in by_ending.items():
        types_of[own[shapes.get(e, size - 2)]] += n

    into = table.sum(0)
    share = (into + 1) / (into.sum() + len(into))
    move = (table + cfg.context_weight * share) / (table.sum(1, keepdims=True) + cfg.context_weight)
    return BrownModel(
        counts, int(tokens), int(types), {w: i for i, (w, _) in enumerate(head)},
        np.array([n for _, n in head], dtype=np.float64), shapes, own,
        np.log10(move), np.log10(into + ADDED * (types_of + 1)),
    )


def score(docs: DataFrame, model: BrownModel, keep: list[Column], text: str = "text") -> DataFrame:
    """The `keep` columns and `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of each whole text.

    `score` is the log10 probability of the text by classes, `base_score` by single words; both add 0.1 to every
    count and give all unknown words together (of a class) one further share. A null text is its end token alone.
    Each row of `docs` gives one row, repeated ones too.
    """
    spark = docs.sparkSession
    other = len(model.own) - 2
    end_class = int(model.own[-1])
    end_count = model.counts.filter(F.col("word") == END).first()
    end_count = end_count["c"] if end_count else 0
    shared = spark.sparkContext.broadcast((
        model.head, np.append(np.log10(model.head_count + ADDED), 0.0),
        np.append(model.own[: len(model.head)], 0).astype(np.int64),
        {e: int(model.own[i]) for e, i in model.shapes.items()}, int(model.own[other]), model.move, model.spread))

    def run(batches):
        head, log_count, head_class, shape_class, other_class, move, spread = shared.value
        for batch in slices(batches):
            ids, classes, sizes, known, tails = [], [], [], [], []
            for value in batch.column(1).to_pylist():
                words = words_of(value)
                found = np.fromiter(map(head.get, words, repeat(-1)), np.int64, len(words))
                own = head_class[found]
                missing = np.flatnonzero(found < 0).tolist()
                tail: Counter[bytes] = Counter()
                for i in missing:
                    key = word_key(words[i])
                    at = head.get(key, -1) if key is not words[i] else -1
                    if at >= 0:
                        found[i], own[i] = at, head_class[at]
                    else:
                        own[i] = shape_class.get(key[-2:], other_class)
                        tail[key] += 1
                ids += [found, [-1]]
                classes += [own, [end_class]]
                sizes.append(len(words) + 1)
                known.append(len(words) - tail.total())
                tails.append(tail)
            seen = np.concatenate([[end_class], *classes]).astype(np.int64)
            step = move[seen[:-1], seen[1:]] - spread[seen[1:]]
            logs = log_count[np.concatenate(ids).astype(np.int64)]
            starts = np.cumsum([0, *sizes[:-1]])
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(np.add.reduceat(logs, starts)), pa.array(np.add.reduceat(step, starts)),
                 pa.array([list(t) for t in tails], pa.list_(pa.binary())),
                 pa.array([list(t.values()) for t in tails], pa.list_(pa.int64()))],
                names=["row", "n_tokens", "n_head", "head_logs", "steps", "words", "times"],
            )

    names = docs.select(*keep).columns
    id_name = free_name(docs.select(*keep), "id")
    numbered = docs.select(
        F.struct(F.monotonically_increasing_id().alias(id_name), *keep).alias("row"), F.col(text).cast("string"))
    kind = numbered.schema["row"].dataType.simpleString()
    parts = stored(numbered.mapInArrow(
        run, f"row {kind}, n_tokens long, n_head long, head_logs double, steps double, words array<binary>, "
             "times array<long>"), "scored")
    tail = parts.select(F.col("row").getField(id_name).alias("id"), F.explode(F.arrays_zip("words", "times")).alias("w"))
    tail = tail.select("id", F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    met = tail.join(model.counts, "word", "left").groupBy("id").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_tail"),
        F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + ADDED)).alias("tail_logs"),
    )
    logs = (
        F.col("head_logs") + F.coalesce("tail_logs", F.lit(0.0)) + F.log10(F.lit(float(end_count)) + ADDED)
    )
    spread_all = float(np.log10(model.tokens + ADDED * (model.types + 1)))
    return parts.join(met.withColumnRenamed("id", "_id"), F.col("row").getField(id_name) == F.col("_id"), "left").select(
        *[F.col("row").getField(c).alias(c) for c in names],
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0)) + F.lit(int(end_count > 0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(spread_all)).alias("base_score"),
        (logs + F.col("steps")).alias("score"),
    )
