"""Brute-force versions and small tables for the tests of the corpus operators."""

from __future__ import annotations

from collections import Counter

import duckdb

SMALL = "/root/testdata/sf0.001"


def table(name: str, folder: str = SMALL):
    return duckdb.connect().execute(f"SELECT * FROM '{folder}/{name}.parquet'").df()


#: Texts that upset things: missing, empty, gaps only, one word, signs, other scripts, control strings, very long.
ODD_TEXTS = [
    None, "", " ", "\n\n", "\t \r\n", "a", "word", "!!", "...,,,", "1234567890", "É è ß İ Σς", "漢字 かな 한국어",
    "Привет мир", "😀 😀", "a\u0000b", "x\u001cy", " nbsp ", "▁▁ a▁b", "<|endoftext|> a<|startoftext|>b", "<s></s><0x0A>",
    "<|im_end|><|im_start|>assistant", "\\<|\\\\|", "a.b,c;d", "é ́", "x" * 5000, "same same " * 400,
    "lines\n" * 300, "It's we'll they'd", "  two  spaces  ", "\nlead and trail\n",
]


def odd_documents(spark):
    """Odd texts with null and repeated keys, repeated rows and columns whose names the operators use themselves."""
    rows = [(i, t, "en" if i % 2 else None, "src", i, "x", 1.5, "print", -1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "null key here", "de", None, None, None, None, None, None), rows[5], rows[5], (5, "other text of five",
             "fr", "s", 1, "y", 2.5, "p", 0)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, key string, score double, "
              "print string, row int")


def empty_documents(spark):
    return odd_documents(spark).filter("1 = 0")


def shingle_links(texts: dict, words: int = 5, threshold: float = 0.8):
    """Links per key and the smallest key of each component, by comparing all sets."""
    sets = {}
    for key, text in texts.items():
        w = (text or "").lower().encode().split()
        sets[key] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    holders: dict = {}
    for key, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(key)
    n, top = Counter(), {key: key for key in sets}

    def find(key):
        while top[key] != key:
            key = top[key]
        return key

    for key, own in sets.items():
        common = Counter()
        for shingle in own:
            common.update(holders[shingle])
        for other, k in common.items():
            if other > key and k >= threshold * (len(own) + len(sets[other]) - k) - 1e-9:
                n[key] += 1
                n[other] += 1
                a, b = find(key), find(other)
                top[max(a, b)] = min(a, b)
    return n, {key: find(key) for key in sets}
