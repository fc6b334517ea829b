from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_helpers import SMALL, empty_documents, odd_documents, table
from reviewlens.llm import variants
from reviewlens.llm.fmindex import Reader, one_error
from reviewlens.llm.variants import VariantConfig

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(docs, cfg=VariantConfig()) -> dict[str, int]:
    counts: Counter[str] = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if cfg.damage and h % cfg.damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= cfg.least_letters and n >= cfg.least_count}


def brute_forms(words: dict[str, int], factor: int = 10) -> set[tuple]:
    """All rows (word, n, n_near, form, form_n, root), by comparing each two words of fitting length and rest."""
    holders: dict[str, set[str]] = {}
    for w in words:
        for part in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            holders.setdefault(part, set()).add(w)
    form, found = {}, {}
    for w, n in words.items():
        parts = {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}
        others = {o for p in parts for o in holders[p] if near(w, o)}
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
        found[w] = len(others)
    rows = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, n, found[w], form[w], words.get(form[w]), root))
    return rows


def rows_of(spark, words: dict[str, int], cfg: VariantConfig) -> set[tuple]:
    found = variants.roots(variants.forms(spark.createDataFrame(list(words.items()), "word string, n long"), cfg))
    rows = [tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", range(40))
def test_search_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "abéc"[: rng.randint(1, 4)]
    words = list({"".join(rng.choices(letters, k=rng.randint(1, rng.choice([4, 8, 30])))) for _ in range(60)})
    queries = words + list({"".join(rng.choices(letters + "z", k=rng.randint(1, 9))) for _ in range(30)})
    reader = Reader([w.encode("latin-1") for w in words])
    exact = np.array([len(q) // 2 for q in queries])
    query, word = one_error(reader, [q.encode("latin-1") for q in queries], exact)
    got = sorted((queries[q], reader.words[w].decode("latin-1")) for q, w in zip(query, word))
    assert got == sorted((q, w) for q in queries for w in words if near(q, w) and w.startswith(q[: len(q) // 2]))


def test_search_over_no_words_and_long_words():
    query, word = one_error(Reader([]), [b"word"], np.array([2]))
    assert len(query) == len(word) == 0
    long = b"ab" * 3000
    reader = Reader([long, long + b"a", b"b" + long, b"a" * 5000, b"a" * 4999])
    query, word = one_error(reader, [long, b"a" * 5000], np.array([3000, 2500]))
    assert sorted((q, reader.words[w]) for q, w in zip(query.tolist(), word)) == [(0, long + b"a"), (1, b"a" * 4999)]


@pytest.mark.parametrize("cfg", [
    VariantConfig(factor=2), VariantConfig(factor=2, shard_rows=40, hot_rows=9), VariantConfig(least_letters=1, factor=3)])
def test_forms_and_roots_equal_brute_force(spark, cfg):
    rng = random.Random(5)
    words = {"".join(rng.choices("abé", k=rng.randint(cfg.least_letters, 9))): 2 ** rng.randint(0, 12) for _ in range(700)}
    assert rows_of(spark, words, cfg) == brute_forms(words, cfg.factor)


def test_a_hot_half_is_cut_into_blocks(spark):
    rng = random.Random(8)
    words = {"prefix" + "".join(rng.choices("abcdef", k=rng.randint(3, 6))): rng.choice([2, 30, 500]) for _ in range(1500)}
    cfg = VariantConfig(hot_rows=100)
    assert rows_of(spark, words, cfg) == brute_forms(words)


def test_chains_lead_to_the_last_form(spark):
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl"]
    words = {w: 10**k for k, w in enumerate(chain)}
    assert {r[5] for r in rows_of(spark, words, VariantConfig())} == {chain[-1]}


def test_query_equals_brute_force(spark):
    docs = table("documents")
    want = brute_forms(brute_words(zip(docs.doc_id.tolist(), docs.text)))
    got = contract.queries()["op11_spelling_variants"](spark, SMALL).collect()
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want and len(got) == len(want)
    assert any(r.form for r in got)


def test_vocabulary_of_odd_texts(spark):
    rows = [(k, "Spelling sPELLING speling Straße naïveté × ÷÷÷÷÷÷÷÷ ÀÉÎÕÜÝÞß Ωmegaaaa漢字letters") for k in range(200)]
    rows += [(None, "Spelling " * 3), (3, None), (4, ""), rows[0], rows[0], (9, "x" * 50_000), (10, "x" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in variants.vocabulary(docs).collect()}
    assert got == brute_words(rows)
    found = variants.spelling_variants(odd_documents(spark))
    assert {r.word for r in found.collect()} == set(brute_words([(r.doc_id, r.text) for r in odd_documents(spark).collect()]))
    assert variants.spelling_variants(empty_documents(spark)).collect() == []
