from __future__ import annotations

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_helpers import ODD_TEXTS, SMALL, empty_documents, odd_documents, table
from reviewlens.llm import resample
from reviewlens.llm.resample import ResampleConfig


def features(text, cfg) -> tuple[int, list[int]]:
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    runs = [b" ".join(words[i : i + k]) for k in range(1, cfg.grams + 1) for i in range(len(words) - k + 1)]
    return len(words), [crc32(r) % cfg.buckets for r in runs]


def brute(docs, targets, cfg):
    """(key, words, features, weight, score, rank) of each document, by plain loops."""
    found = [(key, *features(text, cfg)) for key, text in docs]
    raw, wanted = Counter(b for *_, fs in found for b in fs), Counter(b for t in targets for b in features(t, cfg)[1])
    s_all, t_all = float(raw.total() + cfg.buckets), float(wanted.total() + cfg.buckets)
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((raw[b] + 1) * t_all))) for b in range(cfg.buckets)]
    rows = []
    for key, n, fs in found:
        h = int(sha256(f"{cfg.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in fs)
        rows.append((key, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= cfg.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: cfg.percent * len(able) // 100]
    ranked = [(*r, rank) for rank, r in enumerate(drawn, 1)]
    rest = Counter(rows) - Counter(drawn)
    return ranked + [(*r, None) for r in rest.elements()]


def ranked_rows(spark, docs, targets, cfg):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = resample.fit(frame, spark.createDataFrame([(t,) for t in targets], "text string"), cfg)
    rows = resample.draw(resample.score(frame, model), cfg)
    return rows.select("doc_id", *resample.SCORES, "rank").collect()


@pytest.mark.parametrize("grams", [1, 3])
def test_equals_brute_force(spark, grams):
    rng = random.Random(grams)
    vocabulary = ["one", "Two", "é", "3", "ÜX", "漢", "six", "seven"]
    docs = [(k, rng.choice([" ", "\n", "-"]).join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for k in range(300)]
    docs += [(1000 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, docs[0][1]), (5, docs[0][1])] + [docs[7]] * 40
    targets = [" ".join(rng.choices(vocabulary[:3], k=20)) for _ in range(20)] + [None, ""]
    cfg = ResampleConfig(grams=grams, buckets=97, percent=33, least_words=4)
    got = [tuple(r) for r in ranked_rows(spark, docs, targets, cfg)]
    assert Counter(got) == Counter(brute(docs, targets, cfg))


def test_query_equals_brute_force(spark):
    docs, cfg = table("documents"), ResampleConfig()
    want = brute(list(zip(docs.doc_id.tolist(), docs.text)), table("benchmark").text, cfg)
    got = contract.queries()["op12_importance_resampling"](spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted((k, f, w, s, r) for k, _, f, w, s, r in want)


def test_batches_do_not_change_features():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "b\n", "ü", ""], k=rng.randint(0, 9))) for _ in range(50)] + [None, "x " * 3000]
    cfg = ResampleConfig(grams=3, buckets=1000)
    whole = resample.batch_features(texts, cfg)
    for place, text in enumerate(texts):
        mine = whole.buckets[whole.documents == place]
        assert Counter(mine.tolist()) == Counter(features(text, cfg)[1])
        assert np.array_equal(np.sort(mine), np.sort(resample.batch_features([text], cfg).buckets))
    assert len(resample.batch_features([], cfg).buckets) == 0


def test_odd_and_empty_tables_keep_their_columns(spark):
    docs, target = odd_documents(spark), spark.createDataFrame([("same word",)], "text string")
    model = resample.fit(docs, target)
    scored = resample.score(docs, model)
    assert scored.columns == [*docs.columns, "n_words", "n_features", "weight", "_score"]
    assert scored.select(*docs.columns).exceptAll(docs).count() == 0 and scored.count() == docs.count()
    drawn = resample.resample(docs, target, ResampleConfig(percent=100, least_words=3))
    assert drawn.columns == docs.columns
    assert drawn.count() == scored.filter("n_words >= 3").count()
    assert resample.resample(empty_documents(spark), target).collect() == []
    assert all(r.rank is None for r in ranked_rows(spark, [(1, "few words"), (2, None)], [], ResampleConfig()))


def test_ranks_over_many_partitions(spark):
    cfg = ResampleConfig(percent=50, least_words=0)
    scored = spark.range(5000).selectExpr("id AS doc_id", "25L AS n_words", "CAST(id % 7 AS long) AS score")
    rows = resample.draw(scored.repartition(13), cfg).filter("rank IS NOT NULL").collect()
    want = sorted(((-(k % 7), k) for k in range(5000)))[:2500]
    assert [(-r.score, r.doc_id) for r in sorted(rows, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in rows) == list(range(1, 2501))
