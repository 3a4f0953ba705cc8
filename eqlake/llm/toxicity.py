"""Operator 8: toxicity classifier with counterfactual regularisation.

A logistic model over the distinct words (runs of letters, lower case, hashed) of a text.
Words are screened first: a word stays only if its rate of toxic texts is above what chance
gives among as many words as were tried (exact binomial tail). Identity terms always stay.
For every labelled sentence with identity terms, the terms are swapped for those of another
group and for a neutral word; training penalises the squared change of the sentence's score,
so that a mention of a group by itself moves no score. All pairs of the sample count: they are
cut down to the model's features and equal ones are counted in Spark.

The model is fitted in numpy on at most ``MAX_TOXIC`` toxic and ``MAX_OTHER`` other labelled
documents (the documented bound; chosen by hash among rows that are not held out; weights make
up for the choice) and shipped to the tasks; every whole text is scored.

Defined results: null and empty texts have no words and get the score of the intercept; null
doc_ids are not held out and not learnt from; without labels every score is 0; labels other
than 0 and 1 are ignored; repeated rows get equal results; extra columns pass through
``reject_toxic`` and are ignored by ``score_documents``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.chunks import groups_by_size
from eqlake.llm.common import held_out, register, table, text_of

THRESHOLD = 0.3
MAX_TOXIC, MAX_OTHER = 4_000, 8_000
HASH_BITS = 22

#: Identity terms by group; terms of a group stand in the same place of each list.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
NEUTRAL = "person"
_GROUP = {term: group for group in IDENTITY for term in group}
_WORDS = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def feature(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) >> (32 - HASH_BITS)


def features(text: str) -> list[int]:
    return sorted({feature(w) for w in set(_WORDS.findall(text.lower()))})


def counterfactuals(text: str) -> list[tuple[list[int], list[int]]]:
    """(words, words after the swap) of each sentence with identity terms, for each swap."""
    out = []
    low = text.lower()
    for sentence in _SENTENCE.split(low) if any(t in low for t in _GROUP) else ():
        words = _WORDS.findall(sentence)
        for term in sorted({w for w in words if w in _GROUP}):
            group = _GROUP[term]
            for other in (group[(group.index(term) + 1) % len(group)], NEUTRAL):
                swapped = [other if w == term else w for w in words]
                out.append((sorted(map(feature, set(words))), sorted(map(feature, set(swapped)))))
    return out


def _tail(k: int, n: int, p: float) -> float:
    """P(at least k of n) for a binomial, by its largest terms."""
    if p <= 0:
        return 1.0 if k == 0 else 0.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log)
    for i in range(k, n):
        term *= (n - i) / (i + 1) * p / (1 - p)
        total += term
        if term < 1e-12 * total:
            break
    return min(1.0, total)


class Model:
    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str) -> float:
        if self.bias == -math.inf:
            return 0.0
        get = self.weights.get
        z = self.bias + math.fsum(get(f, 0.0) for f in features(text))
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


class _Rows:
    """A 0/1 matrix by the positions of its ones, so that memory follows the words that are kept."""

    def __init__(self, lists: list[list[int]], column: dict[int, int]):
        found = [sorted({column[f] for f in fs if f in column}) for fs in lists]
        self.shape = len(lists), len(column)
        self.row = np.repeat(np.arange(len(found)), [len(fs) for fs in found])
        self.column = np.array([i for fs in found for i in fs], np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.shape[0])

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, v[self.row], self.shape[1])


def screen(rows: list[tuple[int, float, list[int]]]) -> list[int]:
    """The features that a model of (label, weight, features) has: every word that passes the test, and the identity terms."""
    size = 1 << HASH_BITS
    n_all = np.bincount(np.concatenate([np.array(r[2], np.int64) for r in rows]), minlength=size)
    n_toxic = np.bincount(np.concatenate([np.array(r[2], np.int64) for r in rows if r[0] == 1]), minlength=size)
    rate = min(1 - 1e-9, max(1e-9, float(np.mean([r[0] for r in rows]))))
    tried = np.flatnonzero((n_all >= 3) & (n_toxic > n_all * rate))
    total = max(1, int((n_all >= 3).sum()))
    tails = sorted((_tail(int(n_toxic[f]), int(n_all[f]), rate), int(f)) for f in tried)
    identity = {feature(t) for t in [*_GROUP, NEUTRAL]}
    return list(dict.fromkeys([*(f for t, f in tails if t * total < 0.5), *sorted(identity)]))


def learnable(rows: list[tuple[int, float, list[int]]]) -> bool:
    return any(y == 1 for y, _, _ in rows)


def train(rows: list[tuple[int, float, list[int]]], pairs: list[tuple[list[int], list[int]]], counts: list[int] | None = None, *, penalty: float = 4.0, ridge: float = 1e-3, steps: int = 400) -> Model:
    """Fit on (label, weight, features) and counterfactual pairs, each standing for ``counts`` equal ones.
    Deterministic for the same rows in any order."""
    rows = sorted(rows)
    if not learnable(rows):
        return Model({}, -math.inf)
    y = np.array([r[0] for r in rows], float)
    weight = np.array([r[1] for r in rows], float)
    column = {f: i for i, f in enumerate(screen(rows))}
    often = np.ones(len(pairs)) if counts is None else np.array(counts, float)

    def matrix(lists: list[list[int]]) -> _Rows:
        return _Rows(lists, column)

    x = matrix([r[2] for r in rows])
    before, after = matrix([a for a, _ in pairs]), matrix([b for _, b in pairs])
    w, b = np.zeros(len(column)), math.log(max(1e-6, (weight * y).sum()) / max(1e-6, (weight * (1 - y)).sum()))
    share = weight / weight.sum()
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        error = share * (1 / (1 + np.exp(-np.clip(x.times(w) + b, -60, 60))) - y)
        g, gb = x.back(error) + ridge * w, error.sum()
        if len(pairs):
            p, q = (1 / (1 + np.exp(-np.clip(m.times(w) + b, -60, 60))) for m in (before, after))
            change = 2 * penalty * (p - q) * often / often.sum()
            g = g + before.back(change * p * (1 - p)) - after.back(change * q * (1 - q))
            gb += (change * (p * (1 - p) - q * (1 - q))).sum()
        g = np.append(g, gb)
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Model({f: float(w[i]) for f, i in column.items() if abs(w[i]) > 1e-9}, float(b))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled rows that are not held out. Only the bounded sample's words reach the
    driver, and of its counterfactual pairs the distinct ones over the model's features, with counts."""
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    limits = {1: MAX_TOXIC, 0: MAX_OTHER}
    picked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(n) for y, n in limits.items()]
    # At most MAX_TOXIC + MAX_OTHER rows of two numbers: a bounded broadcast.
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array([features(t) for t in texts], pa.list_(pa.int32()))], names=["toxic", "features"])

    found = sample.select("text", F.col("toxic").cast("int")).mapInArrow(run, "toxic int, features array<int>")
    rows = []
    for r in found.toLocalIterator():
        y = r["toxic"]
        rows.append((y, max(1.0, counts[y] / limits[y]), r["features"]))
    if not learnable(rows):
        return train(rows, [])
    pairs = sorted((r["before"], r["after"], r["n"]) for r in swaps(sample.select("text"), screen(rows)).toLocalIterator())
    return train(rows, [(a, b) for a, b, _ in pairs], [n for _, _, n in pairs])


def swaps(texts: DataFrame, kept: list[int]) -> DataFrame:
    """before, after, n: every counterfactual pair of the texts over the features ``kept``; equal ones are counted."""
    known = frozenset(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            met = Counter(tuple(tuple(sorted(known.intersection(x))) for x in pair) for t in b.column(0).to_pylist() for pair in counterfactuals(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in met], pa.list_(pa.int32())), pa.array([p[1] for p in met], pa.list_(pa.int32())), pa.array(list(met.values()), pa.int64())],
                names=["before", "after", "n"],
            )

    return texts.mapInArrow(run, "before array<int>, after array<int>, n bigint").groupBy("before", "after").agg(F.sum("n").alias("n"))


def score_documents(docs: DataFrame, model: Model, *, keep: list[str] | None = None, at_most: float | None = None) -> DataFrame:
    """``keep`` columns (doc_id unless given), held_out, score and predicted of every row; with
    ``at_most``, only the ``keep`` columns of rows whose score lies below it. Map-only."""
    kept = keep or ["doc_id"]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], held_out().alias("__held"), text_of().alias("__text"))
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(n + 1).to_pylist()
            for rows in groups_by_size(texts):
                part = b.slice(rows[0], len(rows))
                scores = [model.score(texts[i]) for i in rows]
                if at_most is not None:
                    part = part.filter(pa.array([s < at_most for s in scores], pa.bool_()))
                    yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n)], names=kept)
                    continue
                made = [part.column(n), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n)] + made, names=[*kept, "held_out", "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:n]]
    if at_most is None:
        fields += ["held_out boolean", "score double", "predicted int"]
    return source.mapInArrow(run, ", ".join(fields))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the model calls toxic; all columns stay."""
    return score_documents(docs, fit(docs, labels), keep=docs.columns, at_most=THRESHOLD)


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
