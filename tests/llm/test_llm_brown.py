from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import __spark_entry__ as contract
import numpy as np
from llm_helpers import SMALL, empty_documents, odd_documents, table
from pyspark.sql import functions as F
from reviewlens.llm import brown

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def test_base_scores_equal_brute_force(spark):
    docs = table("documents")
    got = contract.queries()["op1_brown_scores"](spark, SMALL).toPandas().set_index("doc_id")
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in docs.doc_id}
    counts: Counter = Counter()
    for d, text in zip(docs.doc_id, docs.text):
        if not held[d]:
            counts.update(tokens(text))
    n, v = counts.total(), len(counts)
    for d, text in zip(docs.doc_id, docs.text):
        own, row = tokens(text), got.loc[d]
        want = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert row.base_score == np.float64(want) or abs(row.base_score - want) < 1e-8 * abs(want)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), n)
        assert row.held_out == held[d]
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum() and len(got) == len(docs)


def classes_of_pairs(pairs, own):
    table = np.zeros((own.max() + 1, own.max() + 1))
    np.add.at(table, (own[:, None], own[None, :]), pairs)
    return table


def likelihood(pairs, own):
    table = classes_of_pairs(pairs, own)
    f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return f(table) - f(table.sum(0)) - f(table.sum(1))


def test_exchange_finds_planted_classes_and_never_loses():
    rng = np.random.default_rng(3)
    n, k = 40, 4
    truth = rng.integers(0, k, n)
    pairs = np.zeros((n + 1, n + 1))
    for i in range(n):
        for j in range(n):
            pairs[i, j] = rng.poisson(60 if truth[j] == (truth[i] + 1) % k else 1)
    start = np.append(np.arange(n) % k, k)
    own = brown.exchange(pairs, k, 10)
    assert likelihood(pairs, own) > likelihood(pairs, start)
    assert likelihood(pairs, own) >= likelihood(pairs, np.append(truth, k)) - 1e-6
    assert own[n] == k
    assert (brown.exchange(np.zeros((1, 1)), k, 3) == [k]).all()


def planted(n, k, seed):
    rng = np.random.default_rng(seed)
    truth = rng.integers(0, k, n)
    rate = np.where(truth[None, :] == (truth[:, None] + 1) % k, 20.0, 0.3)
    pairs = np.zeros((n + 1, n + 1), dtype=int)
    pairs[:n, :n] = rng.poisson(rate)
    return truth, pairs


def test_rounds_move_all_other_words_to_their_planted_class(spark):
    n, k, core = 300, 4, 60
    truth, pairs = planted(n, k, 5)
    at = np.argwhere(pairs)
    rows = [(int(a * (n + 1) + b), int(pairs[a, b])) for a, b in at]
    table = spark.createDataFrame(rows, "pair long, n long").repartition(3)
    start = np.append(np.where(np.arange(n) < core, truth, np.arange(n) % k), k)
    own, counted = brown.exchange_rounds(table, start, core, 5)
    assert (own[:n] == truth).all() and own[n] == k
    assert (counted == classes_of_pairs(pairs, own)).all()
    assert (brown.class_table(table, np.arange(n + 1)) == pairs).all()
    assert np.isclose(brown.likelihood(counted), likelihood(pairs, own))
    # no round is allowed, or nothing can move: the classes stay
    assert (brown.exchange_rounds(table, start, core, 0)[0] == start).all()
    assert (brown.exchange_rounds(table, start, n, 3)[0] == start).all()


def test_contexts_count_classes_on_both_sides(spark):
    n, k = 30, 3
    truth, pairs = planted(n, k, 8)
    rows = [(int(a * (n + 1) + b), int(pairs[a, b])) for a, b in np.argwhere(pairs)]
    own = np.append(truth, k)
    got = np.zeros((n + 1, 2 * (k + 1)))
    for row in brown.contexts(spark.createDataFrame(rows, "pair long, n long"), own).collect():
        for slot, count in row.seen:
            got[row.entry, slot] += count
    hot = np.eye(k + 1)[own]
    assert (got == np.hstack([pairs @ hot, pairs.T @ hot])).all()


def test_long_words_of_every_slice_are_keyed(spark):
    texts = [f"a{i % 300} {'x' * (60 + i % 10)} {'y' * (70 + i % 3)}" for i in range(700)]  # three slices
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    want = Counter(brown.word_key(w) for t in texts for w in brown.words_of(t)) + Counter({brown.END: len(texts)})
    rows = brown.count_words(docs).collect()
    assert {bytes(r.word): r.c for r in rows} == want and len(rows) == len(want)
    assert max(len(r.word) for r in rows) <= 64


def test_pairs_meet_and_are_stored_in_lists(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").unionByName(
        odd_documents(spark).select("text")).repartition(3)
    texts = [brown.words_of(r.text) for r in docs.collect()]
    head = {w: i for i, (w, _) in enumerate(Counter(w for t in texts for w in t).most_common(300))}
    shapes = {b"ed": 300, b"ng": 301}
    size = 304
    want: Counter = Counter()
    for text in texts:
        line = [303, *(head.get(w, shapes.get(brown.word_key(w)[-2:], 302)) for w in text), 303]
        want.update(a * size + b for a, b in zip(line, line[1:]))
    for tokens in (0, 3_000_000):  # one part, thirteen parts
        lists = brown._pair_counts(docs, head, shapes, size, tokens).persist()
        rows = lists.collect()
        pairs = [(p, n) for r in rows for p, n in zip(r.pair, r.n, strict=True)]
        assert len(pairs) == len(want) and dict(pairs) == want  # no pair twice
        assert max(len(r.pair) for r in rows) <= 64 and len(rows) <= len(pairs) / 64 + 13
        flat = spark.createDataFrame(pairs, "pair long, n long").repartition(3)
        own = np.append(np.arange(size - 1) % 5, 5)
        assert (brown.class_table(lists, own) == brown.class_table(flat, own)).all()
        seen = [{r.entry: sorted(r.seen) for r in brown.contexts(table, own).collect()} for table in (lists, flat)]
        assert seen[0] == seen[1] and max(len(s) for s in seen[0].values()) <= 12  # a slot once, before and after
        assert sum(n for s in seen[0].values() for _, n in s) == 2 * want.total()
        lists.unpersist()


def test_all_words_of_the_head_are_clustered_and_raise_the_likelihood(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    few = brown.fit(docs, cfg=brown.BrownConfig(rounds=0))
    more = brown.fit(docs)
    assert len(more.own) == len(more.head) + len(more.shapes) + 2 and len(more.head) > 1024
    moved = np.flatnonzero(few.own != more.own)
    assert len(moved) > 0 and moved.min() >= 1024  # words beyond the core have classes of their own
    by_ending = {}
    for word, i in list(more.head.items())[1024:]:
        by_ending.setdefault(word[-2:], set()).add(int(more.own[i]))
    assert max(map(len, by_ending.values())) > 1


def test_scores_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learned = docs.filter("doc_id % 3 > 0")
    model = brown.fit(learned, cfg=brown.BrownConfig(head=2000, core=100, shapes=20, classes=8))
    count = {bytes(r.word): r.c for r in model.counts.collect()}

    def own(word):
        if word in model.head:
            return int(model.own[model.head[word]])
        return int(model.own[model.shapes.get(word[-2:], len(model.own) - 2)])

    got = {r.doc_id: r.score for r in brown.score(docs, model, [F.col("doc_id")]).collect()}
    for row in docs.collect():
        before, want = int(model.own[-1]), 0.0
        for word in [*brown.words_of(row.text), brown.END]:
            key = brown.word_key(word)
            k = int(model.own[-1]) if word == brown.END else own(key)
            want += model.move[before, k] + math.log10(count.get(key, 0) + 0.1) - model.spread[k]
            before = k
        assert abs(got[row.doc_id] - want) < 1e-8 * abs(want)


def test_a_long_word_keeps_its_ending_and_its_length_changes_no_class(spark):
    assert brown.word_key(b"x" * 64 + b"ing")[-2:] == b"ng" and len(brown.word_key(b"x" * 10**6)) == 19
    docs = spark.createDataFrame([(1, "a running b walking c " + "y" * 100 + "ing")], "doc_id long, text string")
    model = brown.fit(docs, cfg=brown.BrownConfig(head=3, core=1, shapes=4, classes=2))
    score = lambda n: brown.score(
        spark.createDataFrame([(1, "a " + "z" * n + "ing")], "doc_id long, text string"), model, [F.col("doc_id")]).first()
    assert score(61).score == score(62).score  # 64 and 65 bytes, both unknown


def test_probabilities_sum_to_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = brown.fit(docs, cfg=brown.BrownConfig(head=3000, core=50, shapes=20, classes=8))
    assert np.allclose((10**model.move).sum(1), 1)
    mass = np.zeros(9)
    for row in model.counts.collect():
        word = bytes(row.word)
        if word == brown.END:
            own = 8
        elif (i := model.head.get(word)) is not None:
            own = model.own[i]
        else:
            own = model.own[model.shapes.get(word[-2:], len(model.own) - 2)]
        mass[own] += (row.c + 0.1) / 10 ** model.spread[own]
    unknown = 0.1 / 10**model.spread
    assert np.allclose(mass + unknown, 1)


def test_small_head_gives_the_same_base(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    keep = [F.col("doc_id")]
    wide = brown.score(docs, brown.fit(docs), keep).toPandas().sort_values("doc_id")
    slim = brown.score(docs, brown.fit(docs, cfg=brown.BrownConfig(head=20, core=10, shapes=3)), keep)
    slim = slim.toPandas().sort_values("doc_id")
    assert np.allclose(wide.base_score, slim.base_score) and (wide.n_known.values == slim.n_known.values).all()


def test_odd_documents(spark):
    docs = odd_documents(spark)
    model = brown.fit(docs)
    rows = brown.score(docs, model, [F.col("doc_id"), F.col("row")]).collect()
    assert len(rows) == docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    counts = Counter(t for r in docs.collect() for t in tokens(r.text))
    assert rows[0].train_tokens == counts.total() and model.types == len(counts)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].n_tokens == 1 and by_id[24].n_tokens == 2 and by_id[24].n_known == 2  # null, a very long word


def test_empty_tables(spark):
    nothing = brown.fit(empty_documents(spark))
    assert brown.score(empty_documents(spark), nothing, [F.col("doc_id")]).count() == 0
    row = brown.score(odd_documents(spark).filter("doc_id = 6"), nothing, [F.col("doc_id")]).first()
    assert (row.n_known, row.train_tokens) == (0, 0) and abs(row.base_score) < 1e-9 and math.isfinite(row.score)


def test_kept_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "x", "a b"), (2, "y", None)], "id long, word string, text string")
    rows = brown.score(docs, brown.fit(docs), [F.col("id"), F.col("word"), F.col("text")]).collect()
    assert [(r.id, r.word, r.text, r.n_tokens) for r in rows] == [(1, "x", "a b", 3), (2, "y", None, 1)]
