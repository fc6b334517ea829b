from __future__ import annotations

from itertools import product

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_helpers import ODD_TEXTS, SMALL, empty_documents, odd_documents, table
from reviewlens.llm import crf, langspans

TENTH = "/root/testdata/sf0.1"

# ---------------------------------------------------------------- languages


def test_held_out_languages(spark):
    got = contract.queries()["op9_language_id"](spark, TENTH).toPandas().merge(table("documents", TENTH), on="doc_id")
    assert len(got) == len(table("documents", TENTH))
    out = got[got.held_out]
    assert (out.lang_pred == out.lang).mean() > 0.99 and got.score.between(0, 1).all()


def test_best_path_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s, penalty = -rng.exponential(3, (rng.integers(1, 7), 3)), 4.0

        def value(path):
            return sum(s[i, x] for i, x in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))

        best = max(value(p) for p in product(range(3), repeat=len(s)))
        assert value(langspans.best_path(s, penalty).tolist()) == pytest.approx(best)


def test_two_languages_with_a_third_in_between():
    scores = np.array([(0.0, -8.0, -3.0)] * 4 + [(-8.0, 0.0, -3.0)] * 4)
    assert langspans.best_path(scores, 16.0).tolist() == [0] * 4 + [1] * 4
    slow = np.array([(0.0, -0.8, -0.3)] * 40 + [(-0.8, 0.0, -0.3)] * 40)
    assert langspans.best_path(slow, 16.0).tolist() == [0] * 40 + [1] * 40
    rng = np.random.default_rng(5)
    for _ in range(300):
        s, penalty = -rng.exponential(2, (8, 3)).round(1), 6.0
        s[:4, 0], s[4:, 1] = 0, 0

        def value(path):
            return sum(s[i, x] for i, x in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))

        best = max(value(p) for p in product(range(3), repeat=len(s)))
        assert value(langspans.best_path(s, penalty).tolist()) == pytest.approx(best)


def test_mixed_text_gets_spans(spark):
    docs = table("documents", TENTH)
    one = docs[docs.lang == "en"].text.iloc[0][:1500]
    two = docs[docs.lang == "de"].text.iloc[0][:600]
    model = langspans.fit(spark.read.parquet(f"{TENTH}/documents.parquet"))
    mixed = spark.createDataFrame([(1, one + "\n" + two, "old")], "doc_id int, text string, lang_pred string")
    row = langspans.identify(mixed, model).first()
    assert row.lang_pred == "en" and 0.5 < row.lang_score < 1
    assert [s["lang"] for s in row.lang_spans] == ["en", "de"]
    low = (one + "\n" + two).lower().encode()
    border = row.lang_spans[1]["start"]
    assert abs(border - len((one + "\n").lower().encode())) < 60 and row.lang_spans[-1]["end"] <= len(low)


def test_scripts_rule_out_languages(spark):
    rows = [("привет мир дом", "ru"), ("hello world house", "en"), ("hola mundo casa", "es"), ("text", None)] * 5
    model = langspans.fit(spark.createDataFrame(rows, "text string, lang string"))
    asked = spark.createDataFrame([("слово",), ("word",), ("漢字",), ("12 !!",), (None,)], "text string")
    got = [(r.lang_pred, len(r.lang_spans)) for r in langspans.identify(asked, model).collect()]
    assert model.languages == ["en", "es", "ru"]
    assert got[0] == ("ru", 1) and got[1][0] in ("en", "es") and got[2][0] in model.languages
    assert got[3] == got[4] == ("und", 0)


def test_odd_and_empty_documents_languages(spark):
    docs = odd_documents(spark)
    model = langspans.fit(docs)
    got = langspans.identify(docs, model)
    rows = got.collect()
    assert len(rows) == docs.count() and got.columns == [*docs.columns, "lang_pred", "lang_score", "lang_spans"]
    letters = [any(c.isalpha() for c in r.text or "") for r in rows]
    assert [r.lang_pred != "und" for r in rows] == letters
    assert all(0 < r.lang_score <= 1 if has else r.lang_score == 0 for r, has in zip(rows, letters))
    untaught = langspans.fit(empty_documents(spark))
    assert {r.lang_pred for r in langspans.identify(docs, untaught).collect()} == {"und"}
    assert langspans.identify(empty_documents(spark), model).collect() == []


# ---------------------------------------------------------------- quality


def test_held_out_quality(spark):
    got = contract.queries()["op10_quality_crf"](spark, TENTH).toPandas()
    assert len(got) == len(table("documents", TENTH)) and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    out = got.merge(table("labels", TENTH), on="doc_id")
    out = out[out.held_out]
    assert (out.predicted == out.quality).mean() > 0.97
    assert (out.predicted[out.quality == 1] == 1).mean() > 0.99


def chain_by_hand(good, move, counts):
    p, changes, at = np.zeros(len(good)), np.zeros((2, 2)), 0
    for n in counts:
        weights = {}
        for path in product((0, 1), repeat=n):
            s = sum(good[at + t] * y for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            weights[path] = np.exp(s)
        total = sum(weights.values())
        for path, w in weights.items():
            for t, y in enumerate(path):
                p[at + t] += y * w / total
            for a, b in zip(path, path[1:]):
                changes[a, b] += w / total
        at += n
    return p, changes


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    counts = np.array([3, 1, 5, 2])
    good, move = rng.normal(size=11) * 2, rng.normal(size=(2, 2))
    for got, want in zip(crf.marginals(good, move, counts), chain_by_hand(good, move, counts)):
        assert np.allclose(got, want)


def test_features_of_lines():
    own, sizes, counts = crf.line_features([None, "", "a\nb\n", "AAA!!! | ###\nsame same same same\nx\nx"])
    assert counts.tolist() == [1, 1, 3, 4] and sizes.tolist() == [0, 0, 1, 1, 0, 12, 19, 1, 1]
    assert own.shape == (9, crf.OWN) and not own[0].any()
    wide = crf.with_neighbours(own, counts)
    assert not wide[2, crf.OWN : 2 * crf.OWN].any() and (wide[3, crf.OWN : 2 * crf.OWN] == own[2]).all()
    assert (wide[3, 2 * crf.OWN : 3 * crf.OWN] == own[4]).all() and not wide[4, 2 * crf.OWN : 3 * crf.OWN].any()
    assert own[8, -1] and not own[7, -1]  # a line seen before


def test_a_bad_line_is_found(spark):
    model = crf.fit(spark.read.parquet(f"{TENTH}/documents.parquet"), spark.read.parquet(f"{TENTH}/labels.parquet"))
    good = table("documents", TENTH).merge(table("labels", TENTH), on="doc_id").query("quality == 1").text
    line = good[good.str.len().between(600, 2000)].iloc[0].split("\n")[0]
    bad = "word | other | " * 30
    rows = crf.classify(spark.createDataFrame([(f"{line}\n{bad}\n{line}",), (line,)], "text string"), model).collect()
    assert rows[0].line_good[1] < 0.5 < min(rows[0].line_good[0], rows[0].line_good[2])
    assert rows[0].quality_score < 0.5 < rows[1].quality_score


def test_odd_and_empty_documents_quality(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 0, 0), (6, 1, None), (7, None, 0), (8, 0, 1), (None, 1, 1), (24, 3, 0)],
        "doc_id long, quality int, toxic int")
    model = crf.fit(docs, labels)
    got = crf.classify(docs, model)
    rows = got.collect()
    assert len(rows) == docs.count() and got.columns == [*docs.columns, "quality_score", "line_good"]
    assert all(0 <= r.quality_score <= 1 for r in rows)
    assert [len(r.line_good) for r in rows[: len(ODD_TEXTS)]] == [(t or "").count("\n") + 1 for t in ODD_TEXTS]
    untaught = crf.fit(docs, labels.filter("1 = 0"))
    assert {r.quality_score for r in crf.classify(docs, untaught).collect()} == {0.5}
    assert crf.classify(empty_documents(spark), model).collect() == []


def test_small_tables_run(spark):
    for name in ("op9_language_id", "op10_quality_crf"):
        assert contract.queries()[name](spark, SMALL).count() == len(table("documents"))


def test_signs_are_no_letters_and_marks_belong_to_theirs(spark):
    def words(text):
        return [w.decode() for w in langspans.letters(text).split()]

    assert words("½ ² ① Ⅷ _ 5") == [] and words("\u0301 \u0301\u0902 1\u0301") == []
    assert words("नमस्ते दुनिया") == ["नमस्ते", "दुनिया"] and words("ที่นี่ x½y²") == ["ที่นี่", "x", "y"]
    assert words("Cafe\u0301 É2b") == ["cafe\u0301", "é", "b"]
    taught = spark.createDataFrame([(f"the word {k} and more", "en") for k in range(20)], "text string, lang string")
    asked = spark.createDataFrame([("½ ² ①",), ("\u0301",), ("the word",)], "text string")
    got = langspans.identify(asked, langspans.fit(taught), spans=None, certainty="sure").collect()
    assert [(r.lang_pred, r.lang_score > 0, r.sure > 0) for r in got] == [("und", False, False)] * 2 + [("en", True, True)]


def test_the_fit_is_bounded_by_lines(spark):
    """Documents of very many lines leave room to others, and the same lines are taken whatever the order of rows."""
    docs = spark.createDataFrame(
        [(i, f"fine words of text {i}" if i % 2 else f"!! {i} ||") for i in range(40)]
        + [(100 + i, f"a line of {i}\n" * 5000) for i in range(3)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "doc_id % 2 AS quality")
    cfg = crf.CrfConfig(fit_total_lines=1000)
    small = crf.fit(docs, labels, cfg=cfg)
    again = crf.fit(docs.orderBy("text").repartition(5), labels, cfg=cfg)
    without = crf.fit(docs.filter("doc_id < 100"), labels)
    assert np.allclose(small.weights, without.weights) and np.allclose(small.weights, again.weights)
    assert not crf.fit(docs, labels, cfg=crf.CrfConfig(fit_total_lines=0)).weights.any()


def test_too_many_languages_are_an_error(spark):
    docs = spark.createDataFrame([("some words", f"l{i}") for i in range(4)], "text string, lang string")
    assert len(langspans.fit(docs, cfg=langspans.LangConfig(most_languages=4)).languages) == 4
    with pytest.raises(ValueError):
        langspans.fit(docs, cfg=langspans.LangConfig(most_languages=3))
