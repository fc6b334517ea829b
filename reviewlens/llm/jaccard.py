"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are compared as sets of shingles of five words. Texts with the same set are one class. Classes that agree in a
band of MinHash values are candidates, and all that hang together through such agreements form a cluster. Within a
cluster, pairs are compared MinHash values at a time; a pair is dropped once the posterior probability that its
similarity reaches the threshold, under a uniform prior, falls below the tolerance. The others are verified exactly.

A large cluster is cut into blocks, and each two of its blocks meet in a group of their own. A group does not give its
pairs but, for each class, how many documents it links with there and the smallest class it hangs together with, so
rows never grow with the square of a group of copies while every link counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import free_name, slices, stored
from reviewlens.llm.components import components


@dataclass(frozen=True)
class JaccardConfig:
    """A block of a cluster has about `block` classes, and fewer where their sets together would have more than
    `block_shingles` shingles, so a group fits a task however long the texts are."""

    words: int = 5
    threshold: float = 0.8
    values: int = 128
    band_values: int = 4
    step: int = 16
    tolerance: float = 1e-7
    block: int = 256
    block_shingles: int = 1_000_000


# ---------------------------------------------------------------- shingles and their MinHash values


class _WordHashes(dict):
    """The 64-bit hash of each word met, emptied when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = _WordHashes()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `words` words of the lower-case text.

    A text with fewer words has one shingle of all of them; a null text and one of white space have none.
    """
    tokens = (text or "").lower().encode().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
    span = min(words, len(tokens))
    h = np.zeros(len(tokens) - span + 1, dtype=np.uint64)
    for i in range(span):
        h = h * _ODD + hashes[i : i + len(h)]
    return np.unique(_mix(h + np.uint64(span)))


@cache
def _permutations(values: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240613)
    return rng.integers(0, 2**63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(
        0, 2**63, values, dtype=np.uint64)


def minhash(shingle: np.ndarray, values: int) -> np.ndarray:
    a, b = _permutations(values)
    least = np.full(values, 2**32 - 1, dtype=np.uint32)
    for start in range(0, len(shingle), 1024):
        h = (shingle[start : start + 1024, None] * a + b) >> np.uint64(32)
        least = np.minimum(least, h.min(0).astype(np.uint32))
    return least


def _print(shingle: np.ndarray) -> bytes:
    return blake2b(shingle.tobytes(), digest_size=16).digest()


# ---------------------------------------------------------------- comparing


@cache
def least_matches(cfg: JaccardConfig) -> list[tuple[int, int]]:
    """(values compared, matches needed): with fewer, P(similarity >= threshold | matches) is below the tolerance.

    After m matches of k the similarity has the density Beta(m + 1, k - m + 1), and it reaches t with the probability
    that at most m of k + 1 trials of chance t succeed.
    """
    t, needed = cfg.threshold, []
    for k in range(cfg.step, cfg.values + 1, cfg.step):
        total, m = 0.0, -1
        while total < cfg.tolerance:
            m += 1
            total += comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
        needed.append((k, m))
    return needed


def surviving(sigs: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, cfg: JaccardConfig):
    """Index pairs, one from `left` and one from `right` (the same array: each pair once), that are not dropped."""
    one, two = sizes[left][:, None], sizes[right][None, :]
    fit = np.minimum(one, two) >= cfg.threshold * np.maximum(one, two) - 1e-9
    if left is right:
        fit &= np.arange(len(left))[:, None] < np.arange(len(left))[None, :]
    first, needed = least_matches(cfg)[0]
    matches = np.zeros(fit.shape, dtype=np.int16)
    for k in range(first):
        matches += sigs[left, k][:, None] == sigs[right, k][None, :]
    i, j = np.nonzero(fit & (matches >= needed))
    matches = matches[i, j]
    i, j = left[i], right[j]
    done = first
    for upto, needed in least_matches(cfg)[1:]:
        for start in range(0, len(i), 65_536):
            part = slice(start, start + 65_536)
            matches[part] += (sigs[i[part], done:upto] == sigs[j[part], done:upto]).sum(1, dtype=np.int16)
        keep = matches >= needed
        i, j, matches, done = i[keep], j[keep], matches[keep], upto
    return i, j


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least the threshold, exactly."""
    used = np.unique(np.concatenate([i, j]))
    flat, number = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True)
    sizes = np.array([len(sets[u]) for u in used])
    ends = np.cumsum(sizes)
    own = {int(u): number[e - s : e] for u, s, e in zip(used, sizes, ends)}
    ok = np.zeros(len(i), dtype=bool)
    order = np.argsort(i, kind="stable")
    marked = np.zeros(len(flat), dtype=bool)
    cuts = np.flatnonzero(np.diff(i[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        rows = order[a:b]
        mine = own[int(i[rows[0]])]
        marked[mine] = True
        for start in range(0, len(rows), 512):
            part = rows[start : start + 512]
            others = [own[int(x)] for x in j[part]]
            lengths = np.array([len(o) for o in others])
            common = np.add.reduceat(marked[np.concatenate(others)], np.cumsum(lengths) - lengths, dtype=np.int64)
            ok[part] = common >= threshold * (len(mine) + lengths - common) - 1e-9
        marked[mine] = False
    return ok


def links(ids: np.ndarray, copies: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray], block: np.ndarray,
          cfg: JaccardConfig) -> tuple[np.ndarray, np.ndarray]:
    """Per class: how many documents it links with, and the smallest class (index) it hangs together with.

    Classes of two different blocks are compared across the blocks only; those of one block with each other.
    """
    sizes = np.array([len(s) for s in sets])
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    i, j = surviving(sigs, sizes, left, left if block.min() == block.max() else right, cfg)
    if len(i):
        ok = verified(sets, i, j, cfg.threshold)
        i, j = i[ok], j[ok]
    linked = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(
        j, weights=copies[i], minlength=len(ids))
    root = np.argsort(np.argsort(ids))  # places in the order of the ids, so the smallest is the smallest id
    while len(i):
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            break
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
    return linked.astype(np.int64), np.sort(ids)[root]


# ---------------------------------------------------------------- on Spark


def _sketches(docs: DataFrame, cfg: JaccardConfig) -> DataFrame:
    def run(batches):
        for batch in slices(batches):
            sets = [shingles(t, cfg.words) for t in batch.column(2).to_pylist()]
            sigs = [minhash(s, cfg.values).tobytes() if len(s) else None for s in sets]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([_print(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary())],
                names=["row", "key", "print", "n", "sig"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"row long, key {kind}, print binary, n long, sig binary")


def _candidate_clusters(classes: DataFrame, cfg: JaccardConfig) -> DataFrame:
    """`node` (a class) and `root` (its cluster) of all classes that agree with another one in a band."""
    width, bands = 4 * cfg.band_values, cfg.values // cfg.band_values
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.substr("sig", i * width + 1, F.lit(width))))
    rows = classes.select("rep", F.explode(keys).alias("band"))
    centres = rows.groupBy("band").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    edges = rows.join(centres, "band").filter("rep != centre").select(F.col("rep").alias("a"), F.col("centre").alias("b"))
    return components(edges.distinct())


def _compared(groups, cfg: JaccardConfig) -> DataFrame:
    """Links and local roots of the classes of each group; a group holds whole small clusters or two blocks of one."""

    def run(table: pa.Table) -> pa.Table:
        rep = np.asarray(table["rep"])
        _, once = np.unique(rep, return_index=True)
        table = table.take(pa.array(once))
        rep, copies = np.asarray(table["rep"]), np.asarray(table["copies"])
        cluster, block = np.asarray(table["cluster"]), np.asarray(table["block"])
        sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), dtype=np.uint32).reshape(len(rep), cfg.values)
        data = table["shingles"].to_pylist()
        linked, root = np.zeros(len(rep), dtype=np.int64), rep.copy()
        order = np.argsort(cluster, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            if len(own) > 1:
                sets = [np.frombuffer(data[k], dtype=np.uint64) for k in own]
                linked[own], root[own] = links(rep[own], copies[own], sigs[own], sets, block[own], cfg)
        hit = linked > 0
        return pa.table({"rep": rep[hit], "linked": linked[hit], "root": root[hit]})

    return groups.applyInArrow(run, "rep long, linked long, root long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    cfg: JaccardConfig = JaccardConfig()) -> DataFrame:
    """`key`, `class_id`, `n_links`, `kept` for each row of `docs`.

    Two rows are linked if the Jaccard similarity of their shingle sets is at least the threshold. `n_links` counts the
    other rows that a row is linked with, copies among them; `class_id` is the smallest key that can be reached over
    links, the row's own included; one row of each class is `kept`, that of the smallest key. Texts without words
    (null, empty, white space) are linked with nothing. Rows may repeat a key; a null key counts as the smallest. Whole
    texts are used, other columns are dropped, and an empty table gives an empty result.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
                       F.col(text).cast("string").alias("text"))
    sketches = stored(_sketches(rows, cfg), "sketches")
    classes = stored(
        sketches.filter(F.col("print").isNotNull()).groupBy("print").agg(
            F.min("row").alias("rep"), F.min_by("key", "row").alias("key"), F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    clusters = _candidate_clusters(classes, cfg)
    found = classes.join(clusters.withColumnRenamed("node", "rep"), "rep")
    full = F.greatest(F.count(F.lit(1)) / cfg.block, F.sum("n") / cfg.block_shingles)
    sizes = found.groupBy("root").agg(F.ceil(full).alias("blocks"))
    wanted = stored(
        found.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "wanted")
    bins = wanted.agg(F.ceil(full)).first()[0] or 1

    def with_sets(batches):
        """Shingles of the rows whose set is that of the class; a key may stand on rows with other texts too."""
        for batch in slices(batches):
            sets = [shingles(t, cfg.words) for t in batch["text"].to_pylist()]
            same = [_print(s) == p for s, p in zip(sets, batch["print"].to_pylist())]
            columns = [batch[c] for c in ("rep", "cluster", "copies", "blocks", "block", "sig")]
            data = pa.array([s.tobytes() for s in sets], pa.binary())
            out = pa.record_batch([*columns, data],
                                  names=["rep", "cluster", "copies", "blocks", "block", "sig", "shingles"])
            yield out.filter(pa.array(same))

    texts = rows.select("key", "text").join(
        wanted.select(F.col("key").alias("key2"), "rep", F.col("root").alias("cluster"), "copies", "blocks", "block",
                      "sig", "print"), F.col("key").eqNullSafe(F.col("key2")))
    members = texts.mapInArrow(
        with_sets, "rep long, cluster long, copies long, blocks long, block int, sig binary, shingles binary")
    # A class of a large cluster goes to each pair of blocks that has its own; small clusters share groups.
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    placed = members.withColumn("other", other).select(
        "rep", "cluster", "copies", "block", "sig", "shingles",
        F.when(F.col("blocks") > 1, F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("g"),
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    found = stored(_compared(placed.groupBy("g", "lo", "hi"), cfg), "found")
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_class = (
        classes.select("print", "rep", "copies")
        .join(linked, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    )
    whole = stored(
        sketches.select("row", "key", "print").join(of_class, "print", "left").select(
            "row", "key", "copies", "linked", F.coalesce("root", "rep", F.col("row")).alias("top")), "members")
    # Stored, so that a class with very many rows is a skewed join that Spark can split, not part of an aggregate.
    least = stored(whole.groupBy("top").agg(F.min(F.struct("key", "row")).alias("least")), "least")
    return whole.join(least, "top").select(
        F.col("key").alias(key),
        F.col("least.key").alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        (F.col("row") == F.col("least.row")).alias("kept"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text",
                cfg: JaccardConfig = JaccardConfig()) -> DataFrame:
    """The rows of `docs` without near duplicates: of each class the row with the smallest key, with all its columns.

    Rows are told apart by key and text. Of rows alike in both one stays, texts without words among them.
    """
    mark, place = free_name(docs, "mark"), free_name(docs, "place")
    both = F.concat_ws("\0", F.coalesce(F.col(key).cast("string"), F.lit("\1")), F.col(text).cast("string"))
    marked = docs.withColumn(mark, F.md5(both))
    found = near_duplicates(marked.select(F.struct(key, mark).alias("_both"), F.col(text)), "_both", text, cfg)
    kept = found.filter("kept").select(F.col("_both").getField(mark).alias(mark))
    first = F.row_number().over(Window.partitionBy(mark).orderBy(*[F.col(c).asc_nulls_first() for c in docs.columns]))
    return marked.join(kept.distinct(), mark, "left_semi").withColumn(place, first).filter(
        F.col(place) == 1).select(*docs.columns)
