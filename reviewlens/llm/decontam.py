"""Benchmark decontamination: a hash set of the test texts' n-grams, scanned over all windows of the documents.

Test texts and documents are normalised alike: A-Z become lower case, words are runs of digits, a-z and anything
beyond ASCII. A test text gives its windows of `words` consecutive words; one with fewer words, but not none, gives
a single shorter window. The distinct windows are the set. Every window of every document is looked up by a 64-bit
hash, each hit is verified against the window's words, and what is hit is reported or removed.

Only DataFrame functions are used. The hash of a window is an expression over array elements after `explode`, so it
is compiled and builds no arrays. The set is broadcast only if its measured bytes are within `broadcast_bytes`;
beyond that, windows and set are shuffled by hash and text. Only windows that are hit, and one row for each document,
are grouped, by key and text digest: copies and a key with many rows are summed up before the shuffle.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import free_name

_WORD = r"0-9A-Za-z\x{80}-\x{10FFFF}"
#: Rows that one `explode` gives at most when repeated documents are laid out again.
_COPIES_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class DecontamConfig:
    words: int = 10
    broadcast_bytes: int = 64 << 20


def words_of(text: Column) -> Column:
    """Normalised words of a text in order; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(f"[{_WORD}]+"), F.lit(0))


def _hash(words: Column, place: Column, size: int) -> Column:
    """Hash of `size` words from `place` (from 1) on; words behind the end of the array count for nothing."""
    return F.xxhash64(*[F.get(words, place + (k - 1)) for k in range(size)])


def _said(words: Column, place: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, place, size), " ")


def benchmark_windows(benchmark: DataFrame, cfg: DecontamConfig, item: str = "item_id", text: str = "text") -> DataFrame:
    """`hash`, `gram`, `size` of each distinct window of the test texts, and `owners`, the ids (as text) that have it.

    Null texts and texts without words have no windows. A null id's windows count, but no owner is named for them;
    rows that repeat an id belong to one item.
    """
    items = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text).cast("string")).alias("ws"))
    last = F.greatest(F.size("ws") - (cfg.words - 1), F.lit(1))
    windows = items.filter(F.size("ws") > 0).select("item", "ws", F.explode(F.sequence(F.lit(1), last)).alias("at"))
    size = F.least(F.size("ws"), F.lit(cfg.words))
    return (
        windows.select(
            "item", _hash(F.col("ws"), F.col("at"), cfg.words).alias("hash"),
            _said(F.col("ws"), F.col("at"), size).alias("gram"), size.alias("size"))
        .groupBy("hash", "gram", "size")
        .agg(F.collect_set("item").alias("owners"))
    )


def _windows(docs: DataFrame, sizes: list[int], key: str, text: str) -> DataFrame:
    """All windows of the given sizes, as `key`, `print`, `ws`, `n`, `at`, `size`, `hash`.

    Each document also has a row at place 0, without a hash, whatever its length.
    """
    value = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("key"), F.md5(F.coalesce(value, F.lit(""))).alias("print"), words_of(value).alias("ws"))
    shortest = min(sizes, default=1)
    last = F.greatest(F.size("ws") - (shortest - 1), F.lit(0)) if sizes else F.lit(0)
    placed = rows.select("key", "print", "ws", F.size("ws").alias("n"), F.explode(F.sequence(F.lit(0), last)).alias("at"))
    if len(sizes) > 1:
        fitting = F.array(*[F.when((F.col("at") + (s - 1) <= F.col("n")) & (F.col("at") > 0), F.lit(s)) for s in sizes])
        here = F.when(F.col("at") == 0, F.array(F.lit(shortest))).otherwise(F.array_compact(fitting))
        placed = placed.select("*", F.explode(here).alias("size"))
    else:
        placed = placed.select("*", F.lit(shortest).alias("size"))
    digest = F.lit(None).cast("long")
    for s in sizes:
        digest = F.when(F.col("size") == s, _hash(F.col("ws"), F.col("at"), s)).otherwise(digest)
    return placed.select("*", F.when(F.col("at") > 0, digest).alias("hash"))


def _hits(windows: DataFrame, grams: DataFrame, small: bool) -> DataFrame:
    """Windows that are in the set, with `owners`, and every row at place 0 (without owners)."""
    said = _said(F.col("ws"), F.col("at"), F.col("w.size"))
    out = ["key", "print", "n", "at", "w.size", "owners"]
    if small:
        # As a range, the verification is no join key: it is computed for equal hashes only.
        verified = (F.col("w.hash") == F.col("g.hash")) & (F.col("w.size") == F.col("g.size")) & said.between(
            F.col("gram"), F.col("gram"))
        both = windows.alias("w").join(F.broadcast(grams.alias("g")), verified, "left")
        return both.filter((F.col("at") == 0) | F.col("gram").isNotNull()).select(*out)
    rows = windows.alias("w").filter("at > 0").select("key", "print", "n", "at", "size", "hash", said.alias("gram"))
    hit = rows.alias("w").join(grams.alias("g"), ["hash", "gram"]).select(*out)
    none = F.lit(None).cast(grams.schema["owners"].dataType)
    first = windows.filter("at = 0").select("key", "print", "n", "at", "size", none.alias("owners"))
    return hit.unionByName(first)


def _merged(hits: Column, words: int) -> Column:
    """Union of the windows `(at, size)`, sorted, as disjoint spans (`from`, `to`), word places from 1, `to` exclusive.

    Windows have `words` words at most, so what ended latest before a window is among the `words` + the number of
    sizes at one place, all within a slice of bounded length.
    """
    reach = words * words

    def end(window: Column) -> Column:
        return window["at"] + window["size"]

    def latest(i: Column, count: Column) -> Column:
        """Latest end of the windows before position i (from 0)."""
        start = F.greatest(i - reach, F.lit(0))
        return F.coalesce(F.array_max(F.transform(F.slice(hits, start + 1, count - start), end)), F.lit(0))

    opens = F.filter(hits, lambda w, i: w["at"] > latest(i, i))
    closes = F.filter(
        F.transform(hits, lambda w, i: F.struct(latest(i + 1, i + 1).alias("end"), F.get(hits, i + 1)["at"].alias("next"))),
        lambda c: c["next"].isNull() | (c["next"] > c["end"]))
    return F.zip_with(opens, closes, lambda o, c: F.struct(o["at"].alias("from"), c["end"].alias("to")))


def _scan(docs: DataFrame, benchmark: DataFrame, cfg: DecontamConfig, key: str, text: str, item: str,
          item_text: str) -> DataFrame:
    """`key`, `print`, `copies`, `n_words`, `spans`, `items` of each distinct (key, text)."""
    grams = benchmark_windows(benchmark, cfg, item, item_text)
    width = F.length("gram") + 48 + F.coalesce(F.aggregate("owners", F.lit(0), lambda n, o: n + F.length(o) + 16), F.lit(0))
    measured = grams.groupBy("size").agg(F.sum(width).alias("bytes")).collect()  # one row for each size up to `words`
    small = sum(row.bytes for row in measured) <= cfg.broadcast_bytes
    windows = _windows(docs, sorted(row.size for row in measured), key, text)
    window = F.when(F.col("at") > 0, F.struct("at", "size"))
    return (
        _hits(windows, grams, small)
        .groupBy("key", "print")
        .agg(
            F.count_if(F.col("at") == 0).alias("copies"),
            F.max("n").cast("long").alias("n_words"),
            F.array_sort(F.collect_set(window)).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("owners")))).alias("items"),
        )
        .select("key", "print", "copies", "n_words", _merged(F.col("hits"), cfg.words).alias("spans"), "items")
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, cfg: DecontamConfig = DecontamConfig(), *, key: str = "doc_id",
    text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """For every row of `docs`: `key`, `n_words`, `spans` and `items`.

    `spans` are the maximal runs of words inside any occurrence of a window of the test texts, as (`from`, `to`) word
    places from 1, `to` exclusive; `items` the ids, as text and sorted, whose windows occur. Null and empty texts have
    no words, spans or items; a null key is a key. Repeated rows stay repeated. Other columns are dropped, whatever
    their names. An empty table gives an empty one; an empty test table gives no spans.
    """
    found = _scan(docs, benchmark, cfg, key, text, item, item_text)
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / _COPIES_AT_ONCE)))
    here = F.least(F.lit(_COPIES_AT_ONCE), F.col("copies") - F.col("block") * _COPIES_AT_ONCE)
    return (
        found.select("*", blocks.alias("block"))
        .select("*", F.explode(F.sequence(F.lit(1), here.cast("int"))).alias("copy"))
        .select(F.col("key").alias(key), "n_words", "spans", "items")
    )


def hit_words(spans: Column) -> Column:
    """Number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans, each with the signs and gaps before it; all else stays as it is."""
    units = F.regexp_extract_all(text, F.lit(f"[^{_WORD}]*[{_WORD}]+"), F.lit(0))
    rest = F.regexp_extract(text, f"[^{_WORD}]*$", 0)
    starts = F.concat(F.array(F.lit(1)), F.transform(spans, lambda s: s["to"]))
    stops = F.concat(F.transform(spans, lambda s: s["from"]), F.array(F.size(units) + 1))
    kept = F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(units, a, b - a)))
    return F.concat(F.array_join(kept, ""), rest)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, cfg: DecontamConfig = DecontamConfig(), *, remove: str = "spans",
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """`docs` without what is contaminated: its words (`remove="spans"`), or its rows (`remove="documents"`).

    All columns and all clean rows stay as they are, null and empty texts and repeated rows among them.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    found = _scan(docs, benchmark, cfg, key, text, item, item_text).filter(F.size("spans") > 0)
    mark, spans = free_name(docs, "text_print"), free_name(docs, "hit_spans")
    owner = free_name(docs, "hit_key")
    hit = found.select(F.col("key").alias(owner), F.col("print").alias(f"{mark}_hit"), F.col("spans").alias(spans))
    marked = docs.withColumn(mark, F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    same = F.col(key).eqNullSafe(F.col(owner)) & (F.col(mark) == F.col(f"{mark}_hit"))
    if remove == "documents":
        return marked.join(hit, same, "left_anti").select(*docs.columns)
    cut = F.when(F.col(spans).isNull(), F.col(text)).otherwise(without_spans(F.col(text).cast("string"), F.col(spans)))
    return marked.join(hit, same, "left").select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])
