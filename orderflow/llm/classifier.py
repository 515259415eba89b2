"""Quality classifier without gold labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.text import LOWER, texts

GOOD, ABSTAIN, BAD = 1, 0, -1
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIMENSIONS = 1 << 16
# What byte trigrams weigh against the shape features, whose values are 1.
_SCALE = 4.0
# Trigrams of texts shorter than this weigh less.
_SHORT = 256


def shape(text: bytes) -> list[float]:
    """Number of words and the shares that the labellers look at; an empty text has zeros."""
    words = text.translate(LOWER).split()
    n = len(words)
    if not n:
        return [0.0] * 13
    letters = sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.split()]
    marked = len(text) - len(text.translate(None, SYMBOLS))
    return [
        float(n),
        marked / n,
        marked / letters,
        sum(text.count(bytes([c])) > 1 + n // 100 for c in SYMBOLS) / len(SYMBOLS),
        (len(text) - len(text.translate(None, _UPPER))) / letters,
        sum(w.isupper() and len(w) > 1 for w in text.split()) / n,
        text.count(b"!") / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n,
        max(Counter(words).values()) / n,
        1 - len(set(lines)) / len(lines),
        letters / n,
        (text.count(b".") + text.count(b"?") + text.count(b",")) / n,
    ]


def votes(s: list[float]) -> tuple[int, ...]:
    """What each labeller says of a text by its shape: 1 good, -1 bad, 0 nothing.

    Each kind of junk (symbols, capitals, repeats) has several labellers that overlap on it.
    """
    n, symbols, symbol_share, kinds, upper, capitals, shouts, same, distinct, top, lines, length, marks = s

    def split(x, good, bad, sure=True):
        return GOOD if x <= good and sure else BAD if x >= bad and sure else ABSTAIN

    long = n >= 50
    return (
        BAD if n == 0 else GOOD if n >= 100 else ABSTAIN,
        split(symbols, 0.03, 0.2),
        split(symbol_share, 0.01, 0.04),
        split(kinds, 0.0, 0.1, long),
        split(upper, 0.15, 0.4),
        split(capitals, 0.05, 0.3, n >= 5),
        split(shouts, 0.02, 0.2),
        split(same, 0.03, 0.2, n >= 5),
        split(1 - distinct, 0.75, 0.88, long),
        split(top, 0.15, 0.3, long),
        split(lines, 0.1, 0.5),
        GOOD if 3 <= length <= 10 else BAD if length > 25 and long else ABSTAIN,
        BAD if marks < 0.005 and long else GOOD if 0.02 <= marks <= 0.5 else ABSTAIN,
    )


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and each labeller's accuracy on bad and on good texts, given that it votes."""

    prior: float
    accuracy: np.ndarray  # labellers x (bad, good)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of a good text for each row of votes; silence says nothing."""
        bad, good = self.accuracy[:, 0], self.accuracy[:, 1]
        odds = np.log(self.prior / (1 - self.prior))
        odds = odds + (patterns > 0) @ np.log(good / (1 - bad)) + (patterns < 0) @ np.log((1 - good) / bad)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many texts have each.

    It starts from texts with a bad vote as probably bad, the more votes the surer, because labellers of one kind
    of junk call texts of another kind good; this also fixes which class is the good one.
    """
    posterior = 0.95 * 0.1 ** (patterns < 0).sum(axis=1)
    voted, good = (patterns != 0).T, (patterns > 0).T
    model = LabelModel(0.5, np.full((patterns.shape[1], 2), 0.5))
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        cast, for_good = voted @ weight.T, good @ weight.T
        # one text's worth of doubt on either side
        accuracy = np.stack([(cast[:, 0] - for_good[:, 0] + 0.5) / (cast[:, 0] + 1), (for_good[:, 1] + 0.5) / (cast[:, 1] + 1)], axis=1)
        model = LabelModel(float((weight[1].sum() + 1) / (weight.sum() + 2)), accuracy)
        new = model.posterior(patterns)
        moved, posterior = np.abs(new - posterior).max(), new
        if moved < 1e-6:
            break
    return model


def trigrams(data: np.ndarray) -> np.ndarray:
    """Hashed feature of each byte trigram of a buffer."""
    d = data.astype(np.uint32)
    code = d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16)
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


def shape_features(s: list[float]) -> list[int]:
    """Hashed features of a shape, but for the number of words: each share's step on a rising scale."""
    return [(k * 0x9E3779B1 + 1 + int(np.searchsorted(_STEPS, x)) * 0x85EBCA6B) % _DIMENSIONS for k, x in enumerate(s) if k]


_STEPS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.5, 3, 10, 20, 50, 200])


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and values of a whole text: byte trigrams by share, and its shape."""
    low = np.frombuffer(text.translate(LOWER), np.uint8)
    index, count = np.unique(trigrams(low), return_counts=True) if len(low) > 2 else (np.zeros(0, np.uint32), np.zeros(0))
    own = shape_features(shape(text))
    return np.concatenate((index.astype(np.int32), np.array(own, np.int32))), np.concatenate((_SCALE * count / max(_SHORT, count.sum()), np.ones(len(own)))).astype(np.float32)


@dataclass(frozen=True)
class Scorer:
    """Linear over hashed features; the logistic function of the sum is the probability of a good text."""

    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        low = np.frombuffer(text.translate(LOWER), np.uint8)
        total = self.bias + float(self.weights[shape_features(shape(text))].sum())
        if len(low) > 2:
            part = sum(float(self.weights[trigrams(low[i : i + _PIECE + 2])].sum(dtype=np.float64)) for i in range(0, len(low) - 2, _PIECE))
            total += _SCALE * part / max(_SHORT, len(low) - 2)
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


_PIECE = 1 << 20
# Features of the fit that are looked at together.
_RUN = 1 << 17


def fit_scorer(index: list[np.ndarray], value: list[np.ndarray], target: np.ndarray, times: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> Scorer:
    """Logistic regression on soft targets by gradient steps scaled per weight; ``times`` is how often each row is there.

    Rows go by in runs of about ``_RUN`` features, so beside the rows little is held at a time.
    """
    weights, bias = np.zeros(_DIMENSIONS), 0.0
    if len(target):
        part = times / times.sum()
        sizes = np.array([len(x) for x in index])
        run = (np.cumsum(sizes) - sizes) // _RUN
        cuts = [*np.flatnonzero(np.append(True, run[1:] != run[:-1])).tolist(), len(sizes)]
        seen, bias_seen = np.full(_DIMENSIONS, 1e-8), 1e-8
        error = np.zeros(len(target))
        for _ in range(rounds):
            slope = np.zeros(_DIMENSIONS)
            for a, b in zip(cuts[:-1], cuts[1:]):
                own, x = np.concatenate(index[a:b]), np.concatenate(value[a:b]).astype(np.float64)
                margin = np.add.reduceat(weights[own] * x, np.cumsum(sizes[a:b]) - sizes[a:b]) + bias
                error[a:b] = part[a:b] * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target[a:b])
                x *= np.repeat(error[a:b], sizes[a:b])
                np.add.at(slope, own, x)
            slope += ridge * weights
            seen += slope**2
            bias_seen += error.sum() ** 2
            weights -= 0.3 * slope / np.sqrt(seen)
            bias -= 0.3 * error.sum() / np.sqrt(bias_seen)
    return Scorer(weights.astype(np.float32), float(bias))


def _lists(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    """Each row's list, as a view of the column: no object per value."""
    out = []
    for chunk in column.chunks:
        at, values = chunk.offsets.to_pylist(), chunk.values.to_numpy().astype(kind, copy=False)
        out += [values[a:b] for a, b in zip(at[:-1], at[1:])]
    return out


def fit(docs: DataFrame, sample_rows: int = 4000) -> tuple[LabelModel, Scorer]:
    """The label model from all rows' votes and the scorer from about ``sample_rows`` rows.

    Votes are counted by pattern, at most 3 to the power of the labellers, and only patterns reach the driver. The
    scorer's rows are those with the least hashes of id and text, so the sample is the same in each run; rows equal in both
    are one row with their number, so its size bounds what the driver holds.
    """

    def cast(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["".join("-.+"[v + 1] for v in votes(shape(t))) for t in texts(batch.column(0))], pa.string())], ["votes"])

    def described(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = [(votes(shape(t)), *features(t)) for t in texts(batch.column(0).slice(i, 256))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, 256), pa.array([list(r[0]) for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                     pa.array([r[2] for r in rows], pa.list_(pa.float32()))], ["times", "votes", "index", "value"])

    found = docs.select("text").mapInArrow(cast, "votes string").groupBy("votes").count().collect()
    if not found:
        return LabelModel(0.5, np.full((13, 2), 0.5)), fit_scorer([], [], np.zeros(0), np.zeros(0))
    found.sort()
    patterns = np.array([["-.+".index(c) - 1 for c in r["votes"]] for r in found])
    counts = np.array([r["count"] for r in found], float)
    labels = fit_labels(patterns, counts)
    steps = 1 << 30
    share = int(min(1.0, sample_rows / counts.sum()) * steps)
    key = F.xxhash64("doc_id", "text")
    chosen = docs.where(F.pmod(key, F.lit(steps)) < share).groupBy(key.alias("key")).agg(F.any_value("text").alias("text"), F.count("*").alias("times"))
    rows = chosen.select("text", "times").mapInArrow(described, "times long, votes array<int>, index array<int>, value array<float>").toArrow()
    cast_, index, value = _lists(rows["votes"], np.int32), _lists(rows["index"], np.int32), _lists(rows["value"], np.float32)
    target = labels.posterior(np.array(cast_).reshape(-1, patterns.shape[1]).astype(int)) if cast_ else np.zeros(0)
    # by votes, then by features: lists of numbers from 0 on compare like their bytes, the highest first
    order = sorted(range(len(target)), key=lambda i: ((cast_[i] + 1).astype(">i4").tobytes(), index[i].astype(">i4").tobytes()))
    scorer = fit_scorer([index[i] for i in order], [value[i] for i in order], target[order], rows["times"].to_numpy().astype(float)[order])
    return labels, scorer


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """All columns of ``docs`` that are not named so already, and ``quality_score``, the probability of a good text."""
    plain = docs.drop("quality_score")
    names = plain.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            scores = pa.array([scorer.score(t) for t in texts(batch.column(at))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "quality_score"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def classified(docs: DataFrame, limit: float = 0.5, sample_rows: int = 4000) -> DataFrame:
    """``docs`` with quality_score and ``good`` (score at least ``limit``).

    ``docs`` needs doc_id and text. A null or empty text is judged by its shape alone, as a text without words;
    equal texts get equal scores; an empty table gives no rows. Columns of these two names are replaced.
    """
    _, scorer = fit(docs, sample_rows)
    return scored(docs.drop("good"), scorer).withColumn("good", F.col("quality_score") >= limit)
