"""Operator 10: language identification with a bidirectional gated recurrent network over bytes.

The network reads the bytes of a segment (a word, cut at ``SEGMENT`` characters) in both
directions and labels every position; a document's probabilities are the mean over all its
positions. The states start anew at each segment, so equal segments get equal labels and
are computed once per batch of documents; long texts need no long recurrence. Training is
plain numpy: backpropagation through time with Adam, on at most ``SAMPLE_PER_LANG``
documents per language (the documented bound), chosen by hash among the rows with a
language that are not held out. Prediction covers every whole text.

Defined results: ``und`` with score 0 for a null text or one without a letter, or when no
labelled text exists; ties go to the language that sorts first; null doc_ids are neither
held out nor learnt from; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.chunks import groups_by_size
from eqlake.llm.common import held_out, register, table, text_of

SEGMENT = 16
HIDDEN = 16
SAMPLE_PER_LANG = 192
SAMPLE_CHARS = 6_000
_GATES = 3


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class BiGRU:
    """Parameters: per direction an input table (256 x 3H), recurrent weights (H x 3H) and the
    candidate's recurrent bias (H); one output layer (2H x languages). Gate order: reset, update, candidate."""

    def __init__(self, n_out: int, hidden: int = HIDDEN, seed: int = 7, dtype=np.float32):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (256, _GATES * hidden)).astype(dtype)
            self.p[f"u{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, _GATES * hidden)).astype(dtype)
            self.p[f"c{d}"] = np.zeros(hidden, dtype)
        self.p["v"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, n_out)).astype(dtype)
        self.p["o"] = np.zeros(n_out, dtype)

    def _step(self, d: str, byte: np.ndarray, h: np.ndarray) -> tuple:
        k = self.h
        a, s = self.p[f"x{d}"][byte], h @ self.p[f"u{d}"]
        gates = _sigmoid(a[:, : 2 * k] + s[:, : 2 * k])
        r, z = gates[:, :k], gates[:, k:]
        q = s[:, 2 * k :] + self.p[f"c{d}"]
        n = 2.0 * _sigmoid(2.0 * (a[:, 2 * k :] + r * q)) - 1.0  # tanh
        return r, z, q, n, n + z * (h - n)

    def probabilities(self, segments: np.ndarray) -> np.ndarray:
        """Mean label probabilities over the positions of equally long segments (rows of bytes), times their length."""
        rows, width = segments.shape
        kind = self.p["v"].dtype
        states = {}
        for d in "fb":
            h = np.zeros((rows, self.h), kind)
            held = [h] * width
            for t in range(width) if d == "f" else range(width - 1, -1, -1):
                h = held[t] = self._step(d, segments[:, t], h)[-1]
            states[d] = held
        total = np.zeros((rows, self.p["v"].shape[1]), kind)
        for f, b in zip(states["f"], states["b"]):
            logits = f @ self.p["v"][: self.h] + b @ self.p["v"][self.h :] + self.p["o"]
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            total += e / e.sum(axis=1, keepdims=True)
        return total

    def gradients(self, segments: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the positions in ``mask`` and its gradient, through time in both directions."""
        rows, width = segments.shape
        k, kind = self.h, self.p["v"].dtype
        m = mask.astype(kind)[:, :, None]
        tape: dict[str, list] = {}
        states: dict[str, list] = {}
        for d in "fb":
            h = np.zeros((rows, k), kind)
            tape[d], states[d] = [], [h] * width
            for t in range(width) if d == "f" else range(width - 1, -1, -1):
                r, z, q, n, new = self._step(d, segments[:, t], h)
                tape[d].append((t, h, r, z, q, n))
                h = states[d][t] = m[:, t] * new + (1 - m[:, t]) * h
        both = np.concatenate([np.stack(states["f"], 1), np.stack(states["b"], 1)], axis=2)
        logits = both @ self.p["v"] + self.p["o"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        prob = e / e.sum(axis=2, keepdims=True)
        count = max(1.0, float(mask.sum()))
        right = np.take_along_axis(prob, np.broadcast_to(labels[:, None, None], (rows, width, 1)), axis=2)
        loss = float(-(np.log(np.maximum(right, 1e-30)) * m).sum() / count)
        dlogits = prob.copy()
        np.put_along_axis(dlogits, np.broadcast_to(labels[:, None, None], (rows, width, 1)), right - 1, axis=2)
        dlogits *= m / count
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        g["v"] = np.einsum("rtk,rto->ko", both, dlogits)
        g["o"] = dlogits.sum(axis=(0, 1))
        dboth = dlogits @ self.p["v"].T
        for d, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
            u = self.p[f"u{d}"]
            carry = np.zeros((rows, k), kind)
            for t, h, r, z, q, n in reversed(tape[d]):
                dh = carry + dboth[:, t, part]
                dnew = dh * m[:, t]
                da = np.empty((rows, _GATES * k), kind)
                dn = dnew * (1 - z) * (1 - n * n)
                da[:, :k] = dn * q * r * (1 - r)
                da[:, k : 2 * k] = dnew * (h - n) * z * (1 - z)
                da[:, 2 * k :] = dn
                ds = da.copy()
                ds[:, 2 * k :] = dn * r
                carry = dh * (1 - m[:, t]) + dnew * z + ds @ u.T
                g[f"u{d}"] += h.T @ ds
                g[f"c{d}"] += ds[:, 2 * k :].sum(axis=0)
                np.add.at(g[f"x{d}"], segments[:, t], da)
        return loss, g


def _segments(text: str) -> list[str]:
    out = []
    for w in text.split():
        out += [w] if len(w) <= SEGMENT else [w[i : i + SEGMENT] for i in range(0, len(w), SEGMENT)]
    return out


def train(samples: list[tuple[str, str]], *, steps: int = 260, batch: int = 320, seed: int = 11) -> tuple[list[str], BiGRU | None]:
    """Fit on (language, text) pairs; languages weigh the same. Deterministic for the same set of samples."""
    by_lang: dict[str, list[str]] = {}
    for lang, text in sorted(samples):
        by_lang.setdefault(lang, []).extend(_segments(text))
    langs = [lang for lang, segs in sorted(by_lang.items()) if segs]
    if not langs:
        return [], None
    model, rng = BiGRU(len(langs)), np.random.default_rng(seed)
    raw = [[s.encode("utf-8", "surrogatepass") for s in by_lang[lang]] for lang in langs]
    first = {n: np.zeros_like(v) for n, v in model.p.items()}
    second = {n: np.zeros_like(v) for n, v in model.p.items()}
    for step in range(1, steps + 1):
        labels = rng.integers(0, len(langs), batch)
        picked = [raw[i][rng.integers(0, len(raw[i]))] for i in labels]
        width = max(map(len, picked))
        x, mask = np.zeros((batch, width), np.uint8), np.zeros((batch, width), bool)
        for i, s in enumerate(picked):
            x[i, : len(s)], mask[i, : len(s)] = np.frombuffer(s, np.uint8), True
        _, g = model.gradients(x, mask, labels)
        rate = 0.02 * (1 - 0.8 * step / steps)
        for n, v in model.p.items():
            first[n] += 0.1 * (g[n] - first[n])
            second[n] += 0.01 * (g[n] ** 2 - second[n])
            v -= (rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)).astype(v.dtype)
    return langs, model


class Scorer:
    """Document probabilities; label sums of segments are kept for at most ``limit`` segments."""

    def __init__(self, langs: list[str], model: BiGRU, limit: int = 400_000):
        self.langs, self.model, self.limit = langs, model, limit
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.sums = np.zeros((0, len(self.langs)), np.float32)
        self.lengths = np.zeros(0, np.int64)

    def _learn(self, docs: list[list[str]]) -> None:
        if len(self.row) > self.limit:
            self._clear()
        missing = sorted({s for d in docs for s in d}.difference(self.row))
        if not missing:
            return
        raw = [s.encode("utf-8", "surrogatepass") for s in missing]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        sums = np.zeros((len(raw), len(self.langs)), np.float32)
        for width in np.unique(lengths):
            at = np.flatnonzero(lengths == width)
            for k in range(0, len(at), 4_096):
                some = at[k : k + 4_096]
                x = np.frombuffer(b"".join(raw[i] for i in some), np.uint8).reshape(len(some), width)
                sums[some] = self.model.probabilities(x)
        start = len(self.lengths)
        self.row.update(zip(missing, range(start, start + len(missing))))
        self.sums, self.lengths = np.concatenate([self.sums, sums]), np.concatenate([self.lengths, lengths])

    def score(self, texts: list[str]) -> list[tuple[str, float]]:
        docs = [_segments(t) for t in texts]
        self._learn(docs)
        out = []
        for text, segs in zip(texts, docs):
            if not segs or not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            at = np.fromiter(map(self.row.__getitem__, segs), np.int64, len(segs))
            p = self.sums[at].sum(axis=0, dtype=np.float64) / self.lengths[at].sum()
            best = int(p.argmax())
            out.append((self.langs[best], float(min(1.0, p[best]))))
        return out


def training_sample(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, seed: int = 17) -> list[tuple[str, str]]:
    """(lang, text) of at most ``per_lang`` documents per language, by hash: the winner of each of
    ``per_lang`` hash buckets, so that a language with most rows is counted in many tasks. At most
    ``SAMPLE_CHARS`` characters of a sampled text are learnt from."""
    usable = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(per_lang)).alias("bucket")
    ids = usable.groupBy("lang", bucket).agg(F.min_by("doc_id", F.xxhash64("doc_id", F.lit(seed + 1))).alias("doc_id"))
    ids = ids.select("doc_id").distinct()
    # At most per_lang ids per language: a few kilobytes.
    rows = usable.join(F.broadcast(ids), "doc_id").select("lang", F.substring(text_of(), 1, SAMPLE_CHARS).alias("text"))
    return [(r["lang"], r["text"]) for r in rows.toLocalIterator()]


def predict(docs: DataFrame, langs: list[str], model: BiGRU | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``. Map-only."""
    source = docs.select("doc_id", held_out().alias("held_out"), text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(langs, model) if model is not None else None
        for b in batches:
            texts = b.column(2).to_pylist()
            for rows in groups_by_size(texts):
                part = [texts[i] for i in rows]
                found = scorer.score(part) if scorer else [("und", 0.0)] * len(part)
                cut = b.slice(rows[0], len(rows))
                yield pa.RecordBatch.from_arrays(
                    [cut.column(0), cut.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return source.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


@register("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs, *train(training_sample(docs)))
