from __future__ import annotations

import hashlib
import random
import zlib

import __spark_entry__ as contract
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import ODD_TEXTS, SMALL, empty_documents, odd_documents, table
from reviewlens.llm import binpack, chunks, pieces
from tokenizers import Tokenizer

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def strange(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    bits = [t for t in ODD_TEXTS if t and len(t) < 40] + [" ", "  ", "\n", ".", ",", "..", "'s", "the", "é", "́", "_,", "!."]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_chunk_tables_equal_the_libraries(model, tokenizer):
    texts = strange(3000, 1) + [t or "" for t in ODD_TEXTS]
    piece, word = chunks.piece_table(PIECES), chunks.word_table(WORDS)
    got = piece[0].join([piece[1](t) for t in texts])
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == model.encode(texts, num_threads=1)
    got = word.join([chunks.word_chunks(t) for t in texts])
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_control_strings_in_other_letters_are_none(tokenizer):
    texts = [f"{a}{c}{b}" for c in ("<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|StartOfText|>", "<|startoftext|>")
             for a, b in (("", ""), ("A Word ", " Été, two."), ("Word", "Word"), ("Привет ", " Мир"))]
    got = chunks.word_table(WORDS).join([chunks.word_chunks(t) for t in texts])
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == want


def test_a_table_that_overflows_gives_the_same(model):
    texts = strange(400, 2)
    small = chunks.ChunkTable(chunks.piece_table(PIECES)[0].encode, max_entries=50)
    for start in range(0, 400, 40):
        part = texts[start : start + 40]
        got = small.join([chunks.piece_chunks(t) for t in part])
        assert [np.frombuffer(g, "<i4").tolist() for g in got] == model.encode(part, num_threads=1)


def test_sentencepiece_query(spark, model):
    got = {r[0]: tuple(r)[1:] for r in contract.queries()["op3_sentencepiece"](spark, SMALL).collect()}
    docs = table("documents")
    assert len(got) == len(docs)
    for key, text in zip(docs.doc_id, docs.text):
        ids = model.encode(text or "")
        assert got[key] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                            hashlib.sha256(model.decode(ids).encode()).hexdigest())


def test_encoding_odd_documents(spark, model):
    docs = odd_documents(spark)
    got = pieces.decode(pieces.encode(docs, PIECES), PIECES).collect()
    want = [(r.doc_id, model.encode(r.text or "")) for r in docs.collect()]
    assert [(r.doc_id, r.ids) for r in got] == want
    assert [r.decoded for r in got] == [model.decode(ids) for _, ids in want]
    assert pieces.decode(pieces.encode(empty_documents(spark), PIECES), PIECES).count() == 0


# ---------------------------------------------------------------- packing


def fewest(lengths: list[int], capacity: int) -> int:
    """Fewest bins by trying everything."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i: int, bins: list[int]) -> None:
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def check_plan(lengths: list[int], capacity: int) -> int:
    counts = {x: lengths.count(x) for x in set(lengths)}
    plan = binpack.complete_bins(counts, capacity)
    held: dict[int, int] = {}
    for times, filling in plan:
        assert sum(filling) <= capacity and times > 0
        for x in filling:
            held[x] = held.get(x, 0) + times
    assert held == counts
    return sum(times for times, _ in plan)


@pytest.mark.parametrize("seed", range(12))
def test_small_plans_are_optimal(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    assert check_plan(lengths, capacity) == fewest(lengths, capacity)


def test_plans_of_many_pieces():
    rng = random.Random(5)
    lengths = [min(4096, int(rng.lognormvariate(6.5, 0.8)) + 1) for _ in range(4000)]
    assert check_plan(lengths, 4096) <= -(-sum(lengths) // 4096) + 1
    assert check_plan([1500] * 5000, 4096) == 2500
    assert check_plan([4096] * 7, 4096) == 7
    assert binpack.complete_bins({}, 4096) == []


def check_places(rows, capacity: int) -> None:
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_query(spark, tokenizer):
    rows = contract.queries()["op2_best_fit_packing"](spark, SMALL).collect()
    check_places(rows, 4096)
    docs, want = table("documents"), set()
    for key, text in zip(docs.doc_id, docs.text):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want |= {(key, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes()))
                 for k in range(0, len(ids), 4096)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 4096) + 1


def test_odd_documents_and_joined_sequences(spark, tokenizer):
    docs = odd_documents(spark)
    cut = binpack.tokenize(docs, WORDS, 64, 1)
    placed = binpack.pack(cut, ["doc_id", "piece"], 64)
    rows = placed.collect()
    check_places(rows, 64)
    assert sum(r.length for r in rows) == sum(
        len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    joined = {r.sequence_id: bytes(r.ids) for r in binpack.sequences(placed).collect()}
    for r in rows:
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert binpack.pack(binpack.tokenize(empty_documents(spark), WORDS, 64, 1), ["doc_id", "piece"], 64).count() == 0


def test_lengths_without_a_place_and_clashing_names(spark):
    rows = [(1, 10, "a", 0, 5), (2, None, "b", 1, 6), (3, 0, "c", 2, 7), (4, 65, "d", 3, 8), (5, 54, "e", 4, 9)]
    rows += [(9, 3, "hot", 0, 0)] * 200
    df = spark.createDataFrame(rows, "doc_id long, length long, bucket string, rank int, sequence_id int")
    got = binpack.pack(df, ["doc_id"], 64).collect()
    assert {r.doc_id for r in got if r.sequence_id is None} == {2, 3, 4} and len(got) == 205
    check_places([r for r in got if r.sequence_id is not None], 64)
    assert {r.doc_id: r.bucket for r in got}[5] == "e" and {r.doc_id: r["rank"] for r in got}[5] == 4
