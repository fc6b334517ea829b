from __future__ import annotations

import random
from math import comb

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_helpers import SMALL, empty_documents, odd_documents, shingle_links, table
from reviewlens.llm import jaccard
from reviewlens.llm.components import components


def near_copies(groups: int, each: int, words: int, seed: int) -> dict[int, str]:
    """Texts in groups that differ from their first in a few words, some of them not at all."""
    rng, texts = random.Random(seed), {}
    for g in range(groups):
        base = [f"w{g}x{rng.randint(0, 10**6)}" for _ in range(words)]
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(words)] = f"c{rng.randint(0, 10**6)}"
            texts[len(texts)] = " ".join(own)
    return texts


def check(spark, texts: dict, cfg=jaccard.JaccardConfig()):
    rows = jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), cfg=cfg)
    got = {r.doc_id: (r.n_links, r.class_id, r.kept) for r in rows.collect()}
    links, top = shingle_links(texts)
    assert got == {d: (links[d], top[d], top[d] == d) for d in texts}


def test_query_equals_brute_force(spark):
    docs = table("documents")
    texts = dict(zip(docs.doc_id, docs.text))
    got = contract.queries()["op6_jaccard_join"](spark, SMALL).collect()
    links, top = shingle_links(texts)
    assert {r.doc_id: (r.n_links, r.class_id, r.kept) for r in got} == {
        d: (links[d], top[d], top[d] == d) for d in texts}


def test_near_copies_around_the_threshold(spark):
    check(spark, near_copies(groups=12, each=9, words=110, seed=4))


def test_a_large_group_is_cut_into_blocks(spark):
    texts = near_copies(groups=1, each=90, words=130, seed=6) | {
        1000 + k: t for k, t in near_copies(groups=3, each=3, words=40, seed=7).items()}
    check(spark, texts, jaccard.JaccardConfig(block=16))


def test_short_and_odd_texts(spark):
    docs = odd_documents(spark).select("doc_id", "text").filter("doc_id IS NOT NULL AND doc_id != 5").collect()
    texts = {r.doc_id: r.text for r in docs} | {100: "One two THREE", 101: "one  two three", 102: "one two three four"}
    check(spark, texts)


def test_null_keys_repeated_keys_and_empty_table(spark):
    docs = odd_documents(spark)
    rows = jaccard.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    fives = [r for r in rows if r.doc_id == 5]
    assert sorted(r.n_links for r in fives) == [0, 2, 2, 2] and sum(r.kept for r in fives) == 2
    kept = jaccard.deduplicate(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.filter("doc_id = 5").count() == 2 and kept.filter("doc_id IS NULL").count() == 1
    assert jaccard.near_duplicates(empty_documents(spark)).collect() == []
    assert jaccard.deduplicate(empty_documents(spark)).collect() == []


def test_posterior_bounds():
    cfg = jaccard.JaccardConfig()
    for k, m in jaccard.least_matches(cfg):
        grid = (np.arange(200_000) + 0.5) / 200_000

        def reach(matches: int) -> float:
            density = grid**matches * (1 - grid) ** (k - matches) * comb(k, matches) * (k + 1)
            return float(density[grid >= cfg.threshold].mean() * (1 - cfg.threshold))

        assert reach(m) >= cfg.tolerance * 0.99
        assert m == 0 or reach(m - 1) < cfg.tolerance * 1.01


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 140)]
    edges += [(200, k) for k in range(201, 230)] + [(None, 3), (7, None)]
    top: dict = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in top} and len(got) == len(top)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
