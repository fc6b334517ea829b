"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

A word's score for a language is the log-likelihood of its letter trigrams (hashed to a fixed number of buckets) in
the training texts of that language. Languages that hardly use a word's script are no candidates for it. A change of
language between two words costs a penalty, so single odd words change nothing and longer foreign passages become
spans of their own. All of it runs on arrays over the bytes of many texts at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import slices

UNDETERMINED = "und"

# First code points of runs of letters, and the script of each run.
SCRIPT_RUNS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0750, "Arabic"), (0x0780, "other"), (0x08A0, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"), (0x1800, "other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"),
    (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"),
    (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "other"), (0x20000, "Han"), (0x32000, "other"),
)
SCRIPTS = tuple(sorted({name for _, name in SCRIPT_RUNS}))
_RUN_STARTS = np.array([start for start, _ in SCRIPT_RUNS])
_RUN_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RUNS])


@dataclass(frozen=True)
class LangConfig:
    buckets: int = 1 << 16
    added: float = 0.5
    floor: float = -8.0
    switch_penalty: float = 16.0
    script_share: float = 0.01
    most_languages: int = 512


#: ASCII letters stay, all other ASCII is a gap.
_GAPS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))
_BEYOND = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
#: Letters are the categories L; marks (M) belong to the letter before them, and without one they are a gap.
_NO_LETTER = regex.compile(r"[^\p{L}\p{M}]+\p{M}*|^\p{M}+")


def letters(text: str | None) -> bytes:
    """The lower-case words of the text in UTF-8, with gaps for all that is no letter."""
    low = (text or "").lower()
    if _BEYOND.search(low):
        low = _NO_LETTER.sub(" ", low)
    return low.encode().translate(_GAPS)


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code point that begins at each place; `data` has three bytes to spare behind the last."""
    b0, b1, b2, b3 = (data[at + i].astype(np.int64) for i in range(4))
    two = (b0 & 0x1F) << 6 | b1 & 0x3F
    three = (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F
    four = (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F
    return np.where(b0 < 0x80, b0, np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four)))


@dataclass
class Words:
    """Words of several texts: the trigram bucket of each byte, and of each word its first byte, script and text."""

    bucket: np.ndarray
    first: np.ndarray
    size: np.ndarray
    script: np.ndarray
    start: np.ndarray
    text: np.ndarray


def find_words(texts: list[bytes], buckets: int) -> Words:
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    data = np.frombuffer(b" " + b" ".join(texts) + b"    ", dtype=np.uint8)
    body = data[1 : 1 + sizes.sum()]
    inside = body != 32
    begins = np.flatnonzero(inside & (data[: len(body)] == 32))
    wide = data.astype(np.uint32)
    n = len(body)
    code = (wide[:n] << np.uint32(16) | wide[1 : n + 1] << np.uint32(8) | wide[2 : n + 2])[inside]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - buckets.bit_length() + 1)
    kept = np.cumsum(inside)
    first = kept[begins] - 1
    points = _code_points(data, begins + 1)
    script = _RUN_SCRIPT[np.searchsorted(_RUN_STARTS, points, side="right") - 1]
    ends = np.cumsum(sizes)
    text = np.searchsorted(ends, begins, side="right")
    return Words(code, first, np.diff(np.append(first, len(code))), script, begins - (ends - sizes)[text], text)


@dataclass
class LangModel:
    languages: list[str]
    logs: np.ndarray
    candidate: np.ndarray
    cfg: LangConfig


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", cfg: LangConfig = LangConfig()) -> LangModel:
    """Trigram and script counts of every language, over all texts with a label (a null label teaches nothing).

    A task counts each language in an array, and only counts are shuffled: per language at most `buckets` and the
    scripts, which is also what reaches the driver. So there may be `cfg.most_languages` different labels; more are an
    error, since a column with more of them does not hold languages.
    """
    width = cfg.buckets + len(SCRIPTS)
    labels = docs.filter(F.col(lang).isNotNull()).select(lang).distinct().limit(cfg.most_languages + 1).count()
    if labels > cfg.most_languages:
        raise ValueError(f"more than {cfg.most_languages} different values of {lang}: raise `most_languages` if it is right")

    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def rows():
            for name, found in counts.items():
                keys = np.flatnonzero(found)
                yield pa.record_batch(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()),
                     pa.array(found[keys], pa.int64())], names=["lang", "key", "n"])
            counts.clear()

        for batch in slices(batches):
            by_lang: dict[str, list[bytes]] = {}
            for value, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(name, []).append(letters(value))
            for name, texts in by_lang.items():
                words = find_words(texts, cfg.buckets)
                total = counts.setdefault(name, np.zeros(width, dtype=np.int64))
                total[: cfg.buckets] += np.bincount(words.bucket, minlength=cfg.buckets)
                total[cfg.buckets :] += np.bincount(words.script, minlength=len(SCRIPTS))
            if len(counts) > 64:
                yield from rows()
        yield from rows()

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string"))
    table = rows.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    table = table.toArrow()
    names = table["lang"].to_pylist()
    languages = sorted(set(names))
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), width))
    if names:
        counts[[place[name] for name in names], np.asarray(table["key"])] = np.asarray(table["n"])
    grams, scripts = counts[:, : cfg.buckets], counts[:, cfg.buckets :]
    logs = np.log((grams + cfg.added) / (grams.sum(1, keepdims=True) + cfg.added * cfg.buckets)).T
    uses = scripts.T >= np.maximum(scripts.sum(1) * cfg.script_share, 1)
    uses[~uses.any(1)] = True  # a script that no language uses rules none out
    return LangModel(languages, np.ascontiguousarray(logs, dtype=np.float32), uses, cfg)


def word_scores(words: Words, model: LangModel) -> np.ndarray:
    """Log-likelihood of each word in each language, against its best candidate and not below the floor."""
    if not len(words.first) or not model.languages:
        return np.zeros((len(words.first), len(model.languages)))
    sums = np.add.reduceat(model.logs[words.bucket], words.first, axis=0).astype(np.float64)
    sums[~model.candidate[words.script]] = -np.inf
    return np.maximum(sums - sums.max(1, keepdims=True), model.cfg.floor)


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word with the highest sum of scores less a penalty for each change.

    The constant path in the language with the highest total is the best one, and no search is needed, if neither of
    two ways to leave it gains. A run of words in another language, with that language somewhere else in the text,
    gains at most the largest rise of another's cumulative lead and costs a penalty of its own. A path of k runs that
    never uses that language pays k - 1 penalties, so its first and last run, a prefix and a suffix of the text, have
    to bring more than one penalty between them. This decides most texts.
    """
    best = int(scores.sum(0).argmax())
    lead = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    lowest = np.minimum(np.minimum.accumulate(lead, axis=0), 0)
    rise = np.maximum(lead[0], 0)
    if len(lead) > 1:
        rise = np.maximum(rise, (lead[1:] - lowest[:-1]).max(0))
    ends = lead.max(0).max() + (lead[-1] - lowest[-1]).max()
    if rise.max() <= penalty and ends <= penalty:
        return np.full(len(scores), best)
    n, width = scores.shape
    came = np.empty((n, width), dtype=np.int32)
    stay, value = np.arange(width), scores[0].copy()
    for t in range(1, n):
        top = int(value.argmax())
        change = value < value[top] - penalty
        came[t] = np.where(change, top, stay)
        value = np.where(change, value[top] - penalty, value) + scores[t]
    path = np.empty(n, dtype=np.int64)
    path[-1] = int(value.argmax())
    for t in range(n - 1, 0, -1):
        path[t - 1] = came[t, path[t]]
    return path


def identify(docs: DataFrame, model: LangModel, text: str = "text", out: str = "lang_pred",
             score: str = "lang_score", spans: str | None = "lang_spans", certainty: str | None = None) -> DataFrame:
    """Add the language of each whole text, a score from 0 to 1, and its spans (`start`, `end`, `lang`).

    The language is that of the most letters; the score is their share, times how surely they are of it rather than
    of any other. Spans count bytes of the lower-case text in UTF-8. `und` with score 0 and no spans stands for a
    null text, one without letters, and any text if nothing was learned. Ties go to the first language by name. Other
    columns stay; those named like the new ones are replaced. Pass `spans=None` to leave them out. A name for `certainty`
    adds how surely all languages found are the right ones, each weighed by its letters: a text in several languages
    that are plain to see has a high one, though no language has a large share of it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = [out, score, *([spans] if spans else []), *([certainty] if certainty else [])]
    rest = docs.drop(*wanted)
    columns, place = rest.columns, rest.columns.index(text)

    def run(batches):
        model = shared.value
        names = np.array(model.languages, dtype=object)
        for batch in slices(batches):
            words = find_words([letters(t) for t in batch.column(place).cast(pa.string()).to_pylist()],
                               model.cfg.buckets)
            scores = word_scores(words, model)
            bounds = np.searchsorted(words.text, np.arange(batch.num_rows + 1))
            langs, sure, found, certain = [], [], [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if a == b or not len(names):
                    langs.append(UNDETERMINED)
                    sure.append(0.0)
                    found.append([])
                    certain.append(0.0)
                    continue
                own, size = scores[a:b], words.size[a:b]
                path = best_path(own, model.cfg.switch_penalty)
                weight = np.bincount(path, weights=size, minlength=len(names))
                top = int(weight.argmax())
                total = own[path == top].sum(0)
                langs.append(names[top])
                sure.append(float(weight[top] / weight.sum() / np.exp(total - total[top]).sum()))
                if certainty:
                    totals = {k: own[path == k].sum(0) for k in np.flatnonzero(weight).tolist()}
                    certain.append(float(sum(weight[k] / np.exp(t - t[k]).sum() for k, t in totals.items()) / weight.sum()))
                edges = np.flatnonzero(np.diff(path)) + 1
                if spans:
                    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(path)]]) - 1
                    begin = words.start[a:b]
                    found.append([
                        {"start": int(begin[s]), "end": int(begin[e] + size[e]), "lang": names[path[s]]}
                        for s, e in zip(starts, ends)
                    ])
            extra = [pa.array(langs, pa.string()), pa.array(sure, pa.float64())]
            if spans:
                kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
                extra.append(pa.array(found, pa.list_(kind)))
            if certainty:
                extra.append(pa.array(certain, pa.float64()))
            yield pa.record_batch([*batch.columns, *extra], names=[*columns, *wanted])

    added = {out: F.lit("").cast("string"), score: F.lit(0.0)}
    if spans:
        added[spans] = F.lit(None).cast("array<struct<start:bigint,end:bigint,lang:string>>")
    if certainty:
        added[certainty] = F.lit(0.0)
    return rest.mapInArrow(run, rest.withColumns(added).schema)
