from __future__ import annotations

import hashlib
import random
import re

import __spark_entry__ as contract
import pytest
from llm_helpers import SMALL, empty_documents, odd_documents, table
from reviewlens.llm import decontam
from reviewlens.llm.decontam import DecontamConfig

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def brute(text, items, n: int):
    """Hit word places (from 1) and the items whose windows occur."""
    own, hit, found = words(text), set(), set()
    for item, said in items:
        theirs = words(said)
        k = min(n, len(theirs))
        windows = {tuple(theirs[i : i + k]) for i in range(max(1, len(theirs) - n + 1))} if k else set()
        for i in range(len(own) - k + 1):
            if k and tuple(own[i : i + k]) in windows:
                hit.update(range(i + 1, i + k + 1))
                if item is not None:
                    found.add(str(item))
    return hit, sorted(found)


def places(spans) -> list[int]:
    assert all(a["to"] < b["from"] for a, b in zip(spans, spans[1:]))
    return [w for s in spans for w in range(s["from"], s["to"])]


def check(spark, docs, items, cfg):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = decontam.contamination(frame, benchmark, cfg).collect()
    got = sorted((str(r.doc_id), r.n_words, tuple(places(r.spans)), tuple(r["items"])) for r in rows)
    want = []
    for doc, text in docs:
        hit, found = brute(text, items, cfg.words)
        want.append((str(doc), len(words(text)), tuple(sorted(hit)), tuple(found)))
    assert got == sorted(want)


def random_case(seed: int):
    """Texts over few words, so that windows of all sizes hit, repeat and overlap; null and repeated keys and rows."""
    rng = random.Random(seed)
    vocabulary = ["a", "B", "ü", "d4", "É", "xY"]

    def text(most):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(rng.randint(0, most)))

    docs = [(rng.choice([None, k, k // 3]), text(40)) for k in range(60)] + [(7, None), (8, ""), (9, "!!")]
    docs += [docs[0]] * 3
    items = [(rng.choice([None, k, k // 2]), text(7)) for k in range(9)] + [(50, None), (51, "...")]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_equals_brute_force(spark, seed, limit):
    docs, items = random_case(seed)
    check(spark, docs, items, DecontamConfig(words=4, broadcast_bytes=limit))


def test_query_equals_brute_force(spark):
    docs, benchmark = table("documents"), table("benchmark")
    items = list(zip(benchmark.item_id, benchmark.text))
    got = {r.doc_id: r for r in contract.queries()["op13_decontaminate"](spark, SMALL).collect()}
    assert len(got) == len(docs) and any(r.contaminated for r in got.values())
    for doc, text in list(zip(docs.doc_id, docs.text)):
        hit, found = brute(text, items, 10)
        row = got[doc]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (len(words(text)), len(hit), len(found), bool(hit))
        assert row.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(2))
def test_spans_and_documents_are_removed(spark, seed):
    docs, items = random_case(10 + seed)
    cfg = DecontamConfig(words=4)
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, `key` int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.decontaminate(frame, benchmark, cfg, remove="documents")
    assert whole.columns == frame.columns
    assert sorted(map(str, whole.collect())) == sorted(
        str(r) for r in frame.collect() if not brute(r.text, items, 4)[0])
    cut = decontam.decontaminate(frame, benchmark, cfg, remove="spans")
    assert cut.columns == frame.columns and cut.count() == len(docs)
    want = []
    for doc, text in docs:
        hit = brute(text, items, 4)[0]
        if hit:
            units = re.findall(r"[^0-9A-Za-z\x80-\U0010FFFF]*[0-9A-Za-z\x80-\U0010FFFF]+", text)
            tail = re.search(r"[^0-9A-Za-z\x80-\U0010FFFF]*$", text).group()
            text = "".join(u for i, u in enumerate(units, 1) if i not in hit) + tail
        want.append((doc, text))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text)) for r in cut.collect())
    with pytest.raises(ValueError):
        decontam.decontaminate(frame, benchmark, cfg, remove="all")


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    benchmark = spark.createDataFrame([(1, "other TEXT of five"), (2, None)], "item_id long, text string")
    rows = decontam.contamination(docs, benchmark).collect()
    assert len(rows) == docs.count() and sum(len(r.spans) for r in rows) == 1
    none = benchmark.filter("1 = 0")
    assert all(not r.spans for r in decontam.contamination(docs, none).collect())
    assert decontam.decontaminate(docs, none).exceptAll(docs).count() == 0
    assert decontam.contamination(empty_documents(spark), benchmark).collect() == []
    assert decontam.decontaminate(empty_documents(spark), benchmark).collect() == []


def test_a_long_text_is_read_whole(spark):
    text = " ".join(f"w{k % 977}" for k in range(200_000)) + " one two three four five six seven eight nine TEN"
    benchmark = spark.createDataFrame([(1, "One two three four five six seven eight nine ten")], "item_id long, text string")
    [row] = decontam.contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), benchmark).collect()
    assert row.n_words == 200_010 and places(row.spans) == list(range(200_001, 200_011))


def test_plan_has_no_python_and_no_join_of_texts(spark):
    found = contract.queries()["op13_decontaminate"](spark, SMALL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
