"""Spelling variants: words one edit from a far more frequent word, found through two-way full-text indexes.

The vocabulary is a table, counted over whole texts with a sum in each task before the shuffle. A word is a query
under its first half and under its second half, and is posted under every half that a query one letter shorter, as
long or one longer would ask for. Halves are dealt into shards; a half that more than `hot_rows` words are posted
under is cut into blocks, and its queries go to each block. A shard holds the index of its posted words (see
`fmindex`), and gives one row for each of its queries: how many words are near, and the most frequent of them. So no
pairs leave a shard, and no word is lost to a hot half.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import slices, stored
from reviewlens.llm.fmindex import Reader, one_error

_FLUSH = 400_000
_QUERIES_AT_ONCE = 8192
_LEAST_SHARD = 2000
_HOT_HALVES_SENT = 100_000


@dataclass(frozen=True)
class VariantConfig:
    least_letters: int = 7
    least_count: int = 2
    factor: int = 10
    damage: int = 31
    shard_rows: int = 40_000
    hot_rows: int = 16_000


def _damaged(word: bytes, key: str, every: int) -> bytes:
    """The word without one letter, where `every` divides its hash: the given rule for words that are to be found."""
    h = crc32(f"{key}:{word.decode('latin-1')}".encode())
    if h % every:
        return word
    gone = h % len(word)
    return word[:gone] + word[gone + 1 :]


def vocabulary(docs: DataFrame, cfg: VariantConfig = VariantConfig(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word`, `n`: the distinct words of at least `least_letters` letters and `least_count` occurrences overall.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF whose A-Z become lower case, damaged by the rule of
    `_damaged` (never, if `damage` is 0). Null texts have none; a null key counts as an empty one.
    """
    # In Latin-1 every such letter is one byte, and everything beyond becomes a sign that is no letter.
    long_run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % cfg.least_letters)

    def run(batches):
        counts: Counter[bytes] = Counter()

        def rows():
            words = [word.decode("latin-1") for word in counts]
            batch = pa.record_batch([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in slices(batches):
            for name, value in zip(*(column.to_pylist() for column in batch.columns)):
                if not value:
                    continue
                for word, n in Counter(long_run.findall(value.encode("latin-1", "replace").lower())).items():
                    if cfg.damage:
                        word = _damaged(word, name or "", cfg.damage)
                    if len(word) >= cfg.least_letters:
                        counts[word] += n
                if len(counts) > _FLUSH:
                    yield rows()
        yield rows()

    rows = docs.select(F.col(key).cast("string"), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= cfg.least_count)


def _by_half(words: DataFrame, posted: bool, least: int) -> DataFrame:
    """`side`, `half`, `word`, `n`: each word under its own halves, or under those that words one edit away may have."""
    size = F.length("word")
    lengths = F.array(size - 1, size, size + 1) if posted else F.array(size)
    asking = F.filter(lengths, lambda k: k >= least)
    firsts = F.array_distinct(F.transform(asking, lambda k: F.floor(k / 2).cast("int")))
    seconds = F.array_distinct(F.transform(asking, lambda k: (k - F.floor(k / 2)).cast("int")))

    def side(name: str, sizes, half):
        return F.transform(sizes, lambda k: F.struct(F.lit(name).alias("side"), half(k).alias("half")))

    halves = F.concat(side("first", firsts, lambda k: F.left("word", k)), side("second", seconds, lambda k: F.right("word", k)))
    return words.select("word", "n", F.explode(halves).alias("at")).select("at.side", "at.half", "word", "n")


def _sharded(words: DataFrame, cfg: VariantConfig) -> DataFrame:
    """`shard`, `side`, `letters` (of the half), `word`, `n`, `asks`: postings and queries, dealt so that a query meets all
    postings of its half."""
    spark = words.sparkSession
    posted, asking = _by_half(words, True, cfg.least_letters), _by_half(words, False, cfg.least_letters)
    halves = stored(posted.groupBy("side", "half").agg(F.count(F.lit(1)).alias("rows")), "halves")
    hot = halves.filter(F.col("rows") > cfg.hot_rows).select(
        "side", "half", F.ceil(F.col("rows") / cfg.hot_rows).cast("int").alias("blocks"))
    total, n_hot = halves.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count_if(F.col("rows") > cfg.hot_rows)).first()
    if n_hot <= _HOT_HALVES_SENT:
        hot = F.broadcast(hot)
    parallel = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-total // cfg.shard_rows), min(parallel, total // _LEAST_SHARD))

    def dealt(rows: DataFrame, asks: bool, block) -> DataFrame:
        cut = rows.join(hot, ["side", "half"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        shard = F.pmod(F.xxhash64("side", "half", "block"), F.lit(shards)).cast("int")
        return cut.select("side", "half", "word", "n", block.alias("block")).select(
            shard.alias("shard"), "side", F.length("half").alias("letters"), "word", "n", F.lit(asks).alias("asks"))

    return dealt(posted, False, F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).unionByName(
        dealt(asking, True, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))


def _near_in_shard(rows: pa.Table) -> pa.Table:
    """`word`, `n`, `n_near`, `near`, `near_n` of each query of a shard: its near words, and the most frequent of them."""
    found: dict[str, list] = {name: [] for name in ("word", "n", "n_near", "near", "near_n")}
    sides, asks = np.asarray(rows["side"].to_pylist()), np.asarray(rows["asks"].to_pylist())
    for side in ("first", "second"):
        mine = sides == side
        first = side == "first"
        turn = 1 if first else -1
        posted, asked = rows.filter(pa.array(mine & ~asks)), rows.filter(pa.array(mine & asks))
        # Two blocks of a half may meet in one shard: a query asks there once, as all postings are in one index.
        asking = dict(sorted(zip(asked["word"].to_pylist(), asked["n"].to_pylist())))
        queries = [w.encode("latin-1")[::turn] for w in asking]
        counts: dict[bytes, int] = {}
        halves: dict[bytes, set[int]] = {}
        for w, n, letters in zip(*(posted[c].to_pylist() for c in ("word", "n", "letters"))):
            counts[turned := w.encode("latin-1")[::turn]] = n
            halves.setdefault(turned, set()).add(letters)
        reader = Reader(list(counts))
        names = [w[::turn] for w in reader.words]
        under = np.array([[min(halves[w]), max(halves[w])] for w in reader.words], np.int64).reshape(-1, 2)
        frequency = np.fromiter((counts[w] for w in reader.words), np.int64, len(names))
        alphabetic = np.empty(len(names), np.int64)
        alphabetic[np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)] = np.arange(len(names))
        for begin in range(0, len(queries), _QUERIES_AT_ONCE):
            some = queries[begin : begin + _QUERIES_AT_ONCE]
            lengths = np.fromiter(map(len, some), np.int64, len(some))
            exact = lengths // 2 if first else lengths - lengths // 2
            query, word = one_error(reader, some, exact)
            # A word may be here under another half (it has two at most), and be met under this one in another shard.
            kept = (under[word] == exact[query][:, None]).any(axis=1)
            if not first:
                # The first search has what begins with the query's first half.
                kept &= np.fromiter((not names[w].startswith(some[q][::-1][: lengths[q] // 2])
                                     for q, w in zip(query.tolist(), word.tolist())), bool, len(query))
            query, word = query[kept], word[kept]
            best = np.lexsort((alphabetic[word], -frequency[word], query))
            top = best[np.unique(query[best], return_index=True)[1]]
            near: list = [None] * len(some)
            near_n: list = [None] * len(some)
            for q, w in zip(query[top].tolist(), word[top].tolist()):
                near[q], near_n[q] = names[w].decode("latin-1"), int(frequency[w])
            found["n_near"].append(np.bincount(query, minlength=len(some)))
            found["near"] += near
            found["near_n"] += near_n
        found["word"] += asking.keys()
        found["n"] += asking.values()
    counted = np.concatenate(found["n_near"]) if found["n_near"] else np.zeros(0, np.int64)
    return pa.table({
        "word": pa.array(found["word"], pa.string()), "n": pa.array(found["n"], pa.int64()),
        "n_near": pa.array(counted, pa.int64()), "near": pa.array(found["near"], pa.string()),
        "near_n": pa.array(found["near_n"], pa.int64())})


def forms(words: DataFrame, cfg: VariantConfig = VariantConfig()) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n` of a vocabulary (`word` distinct and not null, `n`).

    `n_near` is the number of words one inserted, deleted or replaced letter away; `form` is the most frequent of them
    (ties: the smallest in code-point order), if it is at least `factor` times as frequent as the word, else null.
    Words of fewer than `least_letters` letters are nobody's neighbours and not in the result. An empty vocabulary
    gives an empty result.
    """
    able = words.filter(F.length("word") >= cfg.least_letters).select("word", "n")
    near = _sharded(able, cfg).groupBy("shard").applyInArrow(
        _near_in_shard, "word string, n long, n_near long, near string, near_n long")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    whole = near.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    formed = -F.col("best.less") >= F.col("n") * cfg.factor
    return whole.select("word", "n", "n_near", F.when(formed, F.col("best.near")).alias("form"),
                        F.when(formed, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """`formed` with `root`: from the word along its forms to the last one; the word itself if it has none.

    A form is more frequent than its word, so there are no circles. Each round doubles the steps gone; a chain grows
    `factor` times more frequent with each step, so a few rounds do.
    """
    links = stored(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "links")
    going = True
    while going:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "links")
        going = links.filter("moved").limit(1).count() > 0
        links = links.select("word", "root")
    return formed.join(links, "word", "left").select(*formed.columns, F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, cfg: VariantConfig = VariantConfig(), *, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n`, `root` of the words of the whole texts, see `vocabulary`, `forms`, `roots`.

    Other columns of `docs` are ignored, whatever their names; repeated rows count again. No words give no rows.
    """
    words = stored(vocabulary(docs, cfg, key=key, text=text), "vocabulary")
    return roots(stored(forms(words, cfg), "forms"))
