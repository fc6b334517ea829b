"""Document quality: a linear-chain conditional random field labels every line good or bad.

A line is seen through yes-or-no features of its own and of the lines before and after it. Labels belong to
documents, so lines are labelled in rounds: all lines of a bad document are bad at first; after each fit those that the
field finds good become good, but for the worst line of each bad document. The marginals of the forward-backward pass,
weighted by line length, give the document's share and amount of bad text, and a logistic curve turns these into the
probability that the document is good.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import slices, stored


@dataclass(frozen=True)
class CrfConfig:
    """`fit_documents` bounds the labelled documents that the field is fitted on, taken by a hash of their key, and
    `fit_total_lines` the lines of all of them; `fit_lines` cuts their lines into chains for the fit. Scoring always
    runs over all lines of a text as one chain."""

    fit_documents: int = 6000
    fit_total_lines: int = 200_000
    fit_lines: int = 48
    rounds: int = 3
    steps: int = 60
    rate: float = 0.25
    ridge: float = 1e-4


# ---------------------------------------------------------------- features of lines

_KINDS = ("upper", "lower", "digit", "gap", "stop", "bang", "bar", "sign", "wide")


def _kind_of(byte: int) -> int:
    c = chr(byte)
    if byte > 127:
        return _KINDS.index("wide")
    for kind, test in (("upper", c.isupper()), ("lower", c.islower()), ("digit", c.isdigit()), ("gap", c.isspace()),
                       ("stop", c in ".,;:'\"-?()"), ("bang", c == "!"), ("bar", c == "|")):
        if test:
            return _KINDS.index(kind)
    return _KINDS.index("sign")


_KIND = np.array([_kind_of(b) for b in range(256)], dtype=np.uint8)

#: Thresholds of each measure; every one is a feature that says the measure is above it.
THRESHOLDS = {
    "bytes": (0, 20, 60, 200, 800, 3000),
    "words": (0, 3, 8),
    "upper": (0.15, 0.3, 0.6),
    "digit": (0.02, 0.1, 0.3),
    "stop": (0.03, 0.08),
    "bang": (0.01, 0.05),
    "bar": (0.005, 0.05),
    "sign": (0.01, 0.03, 0.1),
    "wide": (0.05, 0.5),
    "word_bytes": (3, 9, 14),
    "repeated": (0.35, 0.5, 0.65, 0.8),
    "doubled": (0.1, 0.25, 0.5),
    "seen": (0.5,),
}
OWN = sum(len(t) for t in THRESHOLDS.values())
WIDTH = 3 * OWN + 1


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line of the texts, the bytes of each line, and the number of lines of each text.

    A text has a line more than line ends; a null text has one empty line.
    """
    lines: list[bytes] = []
    counts, seen = [], []
    for text in texts:
        own = (text or "").encode().split(b"\n")
        counts.append(len(own))
        lines += own
        if len(set(own)) == len(own):
            seen += [False] * len(own)
        else:
            known: set[bytes] = set()
            for line in own:
                seen.append(line in known and bool(line))
                known.add(line)
    data = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    kind = _KIND[data]
    of = {name: np.add.reduceat(kind == i, starts, dtype=np.int64) for i, name in enumerate(_KINDS)}
    words = np.zeros((len(lines), 3))
    for i, line in enumerate(lines):
        own = line.split()
        if own:
            # A word after itself counts as doubled; a set as large as the list needs no look at neighbours.
            distinct = len(set(own))
            twice = sum(map(bytes.__eq__, own, own[1:])) if distinct < len(own) else 0
            words[i] = len(own), len(own) - distinct, twice
    n = words[:, 0]
    bytes_ = np.maximum(sizes, 1)
    # Common words repeat in long lines; what counts is repetition beyond that.
    usual = np.where(n > 60, 0.15 * np.log2(np.maximum(n, 60) / 60), 0)
    measures = {
        "bytes": sizes, "words": n, "upper": of["upper"] / np.maximum(of["upper"] + of["lower"], 1),
        "word_bytes": np.where(n > 0, sizes / np.maximum(n, 1), 0),
        "repeated": np.where(n >= 4, words[:, 1] / np.maximum(n, 1) - usual, 0),
        "doubled": np.where(n >= 4, words[:, 2] / np.maximum(n, 1), 0),
        "seen": np.array(seen, dtype=float),
    } | {name: of[name] / bytes_ for name in ("digit", "stop", "bang", "bar", "sign", "wide")}
    columns = [measures[name] > limit for name, limits in THRESHOLDS.items() for limit in limits]
    return np.stack(columns, axis=1), sizes, np.array(counts, dtype=np.int64)


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before, of the line after, and a constant; none beyond a text's ends."""
    n = len(own)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    ends = np.cumsum(counts)
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[(ends - counts)[counts > 0], OWN : 2 * OWN] = 0
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[(ends - 1)[counts > 0], 2 * OWN : 3 * OWN] = 0
    out[:, -1] = 1
    return out


# ---------------------------------------------------------------- the chain


def _steps(counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Rows of all chains by their t-th line, longest chains first, and how many chains have a t-th line."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    ordered = counts[order]
    alive = [int(np.searchsorted(-ordered, -t, side="left")) for t in range(int(ordered[0]) if len(ordered) else 0)]
    return starts, alive


def _lse(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(good: np.ndarray, move: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once: P(line is good), and the expected changes from i to j over all chains.

    `good` is each line's score for good (bad has 0), `move[i, j]` the score of i before j; 1 is good.
    """
    starts, alive = _steps(counts)
    n = len(good)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    score = np.stack([np.zeros(n), good], axis=1)
    for t, k in enumerate(alive):
        at = starts[:k] + t
        if t:
            before = forward[at - 1]
            step = np.stack([_lse(before[:, 0] + move[0, j], before[:, 1] + move[1, j]) for j in (0, 1)], axis=1)
            forward[at] = step + score[at]
        else:
            forward[at] = score[at]
    changes = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        at = starts[: alive[t]] + t
        after = backward[at] + score[at]
        backward[at - 1] = np.stack([_lse(after[:, 0] + move[i, 0], after[:, 1] + move[i, 1]) for i in (0, 1)], axis=1)
        joint = forward[at - 1][:, :, None] + move[None] + after[:, None, :]
        total = _lse(_lse(joint[:, 0, 0], joint[:, 0, 1]), _lse(joint[:, 1, 0], joint[:, 1, 1]))
        changes += np.exp(joint - total[:, None, None]).sum(0)
    both = forward + backward
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700))), changes


@dataclass
class CrfModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def lines(self, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return marginals(with_neighbours(own, counts) @ self.weights, self.move, counts)[0]

    def documents(self, good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(aggregate(good, sizes, counts) @ self.curve, -700, 700)))


def aggregate(good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each document: a constant, its share of bad text and the logarithm of its amount, both by line length."""
    starts = np.cumsum(counts) - counts
    weight = sizes + 1.0
    bad = np.add.reduceat((1 - good) * weight, starts)
    return np.stack([np.ones(len(counts)), bad / np.add.reduceat(weight, starts), np.log1p(bad) / 5], axis=1)


def _adam(value: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    first, second = np.zeros_like(value), np.zeros_like(value)
    for t in range(1, steps + 1):
        g = gradient(value)
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        value = value + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return value


def train(own: np.ndarray, sizes: np.ndarray, counts: np.ndarray, label: np.ndarray, cfg: CrfConfig) -> CrfModel:
    """Fit the field and the curve to documents given by the features of their lines and their labels (1 is good)."""
    model = CrfModel()
    if not len(counts):
        return model
    features = with_neighbours(own, counts)
    chains = np.concatenate([
        [*[cfg.fit_lines] * (c // cfg.fit_lines), *([c % cfg.fit_lines] if c % cfg.fit_lines else [])]
        for c in counts.tolist()
    ]).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.zeros(len(own), dtype=bool)
    first[(np.cumsum(chains) - chains)] = True
    good = label[doc].astype(float)
    starts = np.cumsum(counts) - counts
    scale = len(counts)
    # The first round looks at lines by themselves, so that good lines beside bad ones are told apart from them.
    alone = np.zeros(WIDTH + 4)
    alone[:OWN] = alone[WIDTH - 1] = 1
    for nth in range(cfg.rounds):
        taught = alone if nth == 0 else 1.0
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (good[:-1][~first[1:]].astype(int), good[1:][~first[1:]].astype(int)), 1)
        seen = features.T @ good

        def gradient(value: np.ndarray) -> np.ndarray:
            p, changes = marginals(features @ value[:WIDTH], value[WIDTH:].reshape(2, 2), chains)
            g = np.concatenate([seen - features.T @ p, (pairs - changes).ravel()]) / scale
            return (g - cfg.ridge * value) * taught

        value = _adam(np.concatenate([model.weights, model.move.ravel()]), gradient, cfg.steps, cfg.rate)
        model.weights, model.move = value[:WIDTH], value[WIDTH:].reshape(2, 2)
        p, _ = marginals(features @ model.weights, model.move, chains)
        worst = np.minimum.reduceat(p, starts)
        good = np.where(label[doc] == 1, 1.0, (p > 0.5) & (p > worst[doc]))
    whole = aggregate(model.lines(own, counts), sizes, counts)

    def slope(value: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(whole @ value, -700, 700)))
        return whole.T @ (label - p) / scale - cfg.ridge * value

    model.curve = _adam(np.array([2.0, -4.0, 0.0]), slope, 10 * cfg.steps, 0.1)
    return model


# ---------------------------------------------------------------- on Spark


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        cfg: CrfConfig = CrfConfig()) -> CrfModel:
    """Fit on at most `cfg.fit_documents` documents with a label of 0 or 1, taken by a hash of the key.

    Their line features are made where their texts are, and only those reach the driver, of at most
    `cfg.fit_total_lines` lines: whole documents by hash, each that still has room. Rows without a key or a label
    teach nothing, and a key with several labels counts with its lowest. Without any labels every score is 0.5.
    """
    one = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("good"))
    taken = one.orderBy(F.xxhash64(key), key).limit(cfg.fit_documents).toDF("_key", "good")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).join(
        F.broadcast(taken), "_key").select("_text", F.col("good").cast("long").alias("good"))  # a bounded list

    def run(batches):
        for batch in slices(batches):
            own, sizes, counts = line_features(batch.column(0).to_pylist())
            bounds = np.concatenate([[0], np.cumsum(counts)])
            packed = [np.packbits(own[a:b], axis=1).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            sizes = [sizes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch(
                [batch.column(1), pa.array(packed, pa.binary()), pa.array(sizes, pa.list_(pa.int64()))],
                names=["good", "own", "sizes"])

    found = rows.mapInArrow(run, "good long, own binary, sizes array<long>").select(
        "*", F.xxhash64("own", "good").alias("place"), F.size("sizes").alias("lines"))
    found = stored(found.orderBy("place").limit(cfg.fit_documents), "lines")  # a key may stand on many rows
    room, kept = cfg.fit_total_lines, []
    for place, lines, rows_alike in sorted(map(tuple, found.groupBy("place", "lines").count().collect())):
        if lines * rows_alike <= room:  # two numbers a document, and `fit_documents` of them at most
            room -= lines * rows_alike
            kept.append((place, lines))
    chosen = docs.sparkSession.createDataFrame(kept, "place long, lines int")
    table = found.join(F.broadcast(chosen), ["place", "lines"]).select("good", "own", "sizes").toArrow()
    if not table.num_rows:
        return CrfModel()
    table = table.sort_by([("own", "ascending")])  # the order of rows must not matter
    bits = -(-OWN // 8)
    own = np.frombuffer(b"".join(table["own"].to_pylist()), dtype=np.uint8).reshape(-1, bits)
    sizes = table["sizes"].to_pylist()
    return train(
        np.unpackbits(own, axis=1)[:, :OWN].astype(bool), np.concatenate(sizes).astype(np.int64),
        np.array([len(s) for s in sizes]), np.asarray(table["good"]).astype(float), cfg)


def classify(docs: DataFrame, model: CrfModel, text: str = "text", out: str = "quality_score",
             lines: str | None = "line_good") -> DataFrame:
    """Add the probability that each whole text is good, and that of each of its lines (as an array).

    A null text is one empty line, like an empty one. Other columns stay; those named like the new ones are replaced.
    Pass `lines=None` to leave the array out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(out, *([lines] if lines else []))
    columns, place = rest.columns, rest.columns.index(text)

    def run(batches):
        model = shared.value
        for batch in slices(batches):
            own, sizes, counts = line_features(batch.column(place).cast(pa.string()).to_pylist())
            good = model.lines(own, counts)
            extra = [pa.array(model.documents(good, sizes, counts))]
            if lines:
                bounds = np.concatenate([[0], np.cumsum(counts)])
                extra.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(good)))
            yield pa.record_batch([*batch.columns, *extra], names=[*columns, out, *([lines] if lines else [])])

    added = {out: F.lit(0.0)} | ({lines: F.lit(None).cast("array<double>")} if lines else {})
    return rest.mapInArrow(run, rest.withColumns(added).schema)
