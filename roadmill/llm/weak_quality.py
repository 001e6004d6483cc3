"""Quality classifier from weak labels.

Nine overlapping heuristics vote good, bad or nothing on a document. Expectation-maximisation over the counts of
vote patterns (at most 3**9, over all documents) estimates how often each heuristic votes what in either class;
the posterior of a pattern labels its documents. A hashed linear scorer, over word shapes and words, is fitted
to the posteriors of a bounded sample (about `sample` documents, by hash), and scores every document.

Nulls and ties: null, empty and wordless texts get the vote of the length heuristic alone and score by the bias
of a text without words, which is set to bad; null ids and repeated rows are scored like others. Without
documents the result is empty. Very long texts are read whole, a few at a time. Rows that agree in id and text are in
the sample once, so that repeated rows can't swell it. Columns other than doc_id and text are carried by `keep_good`,
with any names.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, small_batches, use_worker

NONE, BAD, GOOD = 0, 1, 2
DIMENSIONS = 2048
_STRANGE = re.compile(r"[^\w\s.,;:'\"()\-!?¿¡]")
_DOUBLED = re.compile(r"([!?*#$%&=~+])\1")
#: Function words of the four languages; with other languages the heuristic abstains rarely and EM weighs it down.
FUNCTION_WORDS = frozenset(
    "the of and to in is that it for was on are as with he be at by this have from or an not but "
    "der die das und zu den mit von für ist im ein eine nicht auf sich des dem "
    "le la les de des et en un une du que pour dans est qui au sur pas par "
    "el los las y con para del se su al lo como más".split()
)
LABELLERS = ("strange", "capitals", "function_words", "stutter", "variety", "separators", "doubled", "sentences", "word_length")


def _vote(x: float, good: bool, bad: bool) -> int:
    return GOOD if good else BAD if bad else NONE


def votes(text: str, words: list[str]) -> tuple[int, ...]:
    """One vote of each labeller."""
    n = len(words)
    if not n:
        return (NONE,) * 8 + (BAD,)
    strange = len(_STRANGE.findall(text)) / len(text)
    capitals = sum(map(str.isupper, words)) / n
    function = sum(map(FUNCTION_WORDS.__contains__, words)) / n
    stutter = sum(map(operator.eq, words, words[1:])) / n
    variety = len(set(words)) / n
    bars = words.count("|") / n
    doubled = len(_DOUBLED.findall(text)) / n
    stops = sum(w[-1] == "." for w in words) / n
    length = (len(text) - n) / n
    long = n >= 20
    return (
        _vote(strange, strange < 0.005, strange > 0.03),
        _vote(capitals, capitals < 0.15, capitals > 0.5 and long),
        _vote(function, function >= 0.1, function < 0.03 and long),
        _vote(stutter, stutter < 0.03, stutter > 0.15),
        _vote(variety, variety > 0.4, variety < 0.3 and n >= 50),
        _vote(bars, bars < 0.01, bars > 0.05),
        _vote(doubled, doubled < 0.01, doubled > 0.1),
        _vote(stops, long and 0.02 <= stops <= 0.4, n >= 60 and stops < 0.012),
        _vote(length, 2.0 <= length <= 9.0, not 1.5 <= length <= 12.0),
    )


def pattern(text: str | None, words: list[str] | None = None) -> int:
    text = text or ""
    return sum(v * 3**i for i, v in enumerate(votes(text, text.split() if words is None else words)))


def _unpack(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class LabelModel:
    """prior of good; table[labeller, class, vote]: class 0 bad, 1 good; of those who vote, the share that votes so.
    Whether one votes says nothing of the class (short texts get few votes, not bad ones)."""

    prior: float
    table: np.ndarray

    @classmethod
    def fit(cls, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
        v = _unpack(patterns)
        good, bad = (v == GOOD).sum(1), (v == BAD).sum(1)
        q = (good - 2.0 * bad > 0).astype(float) * 0.9 + 0.05  # the first guess: votes against count twice
        model = cls(0.5, np.ones((len(LABELLERS), 2, 3)))
        for _ in range(rounds):
            before = q
            weight = np.stack([counts * (1 - q), counts * q])
            for i in range(len(LABELLERS)):
                hits = np.array([[w[v[:, i] == x].sum() for x in (BAD, GOOD)] for w in weight]) + 0.5
                model.table[i, :, BAD:] = hits / hits.sum(1, keepdims=True)
            model.prior = float((weight[1].sum() + 1) / (weight.sum() + 2))
            q = model.posterior(patterns)
            if np.abs(q - before).max() < tolerance:
                break
        return model

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        v = _unpack(np.asarray(patterns))
        logs = np.log(self.table)
        score = np.log(self.prior / (1 - self.prior)) + sum(logs[i, 1, v[:, i]] - logs[i, 0, v[:, i]] for i in range(len(LABELLERS)))
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))

    def accuracies(self) -> dict[str, float]:
        """Of each labeller's votes, the share that agrees with the class."""
        out = {}
        for i, name in enumerate(LABELLERS):
            right = self.prior * self.table[i, 1, GOOD] + (1 - self.prior) * self.table[i, 0, BAD]
            wrong = self.prior * self.table[i, 1, BAD] + (1 - self.prior) * self.table[i, 0, GOOD]
            out[name] = float(right / (right + wrong))
        return out


# ---------------------------------------------------------------- features and scorer

_RUNS = re.compile(r"(.)\1+", re.S)


class _Kinds(dict):
    """Character to A, a, 0 or itself, for str.translate."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return kind


_kinds = _Kinds()
_shape_slots: dict[str, int] = {}
_slots: dict[str, int] = {}
_AGAIN = xxhash.xxh32_intdigest("\0again") % DIMENSIONS


def _clear() -> None:
    for cache in (_kinds, _shape_slots, _slots):
        cache.clear()


def _slot(word: str) -> int:
    """Hashed places of the word's shape (runs of a kind count once) and of the word, as one number."""
    kinds = word.translate(_kinds)
    shape = _shape_slots.get(kinds)
    if shape is None:
        if len(_shape_slots) > 50_000:
            _shape_slots.clear()
        _shape_slots[kinds] = shape = xxhash.xxh32_intdigest(_RUNS.sub(r"\1+", kinds)) % DIMENSIONS
    return shape * DIMENSIONS + xxhash.xxh32_intdigest(word, 1) % DIMENSIONS


def features(words: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed places, of unit length."""
    known = _slots
    if len(known) > 100_000:
        known.clear()
        _kinds.clear()
    for w in set(words).difference(known):
        known[w] = _slot(w)
    at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    counts = (np.bincount(at // DIMENSIONS, minlength=DIMENSIONS) + np.bincount(at % DIMENSIONS, minlength=DIMENSIONS)).astype(np.float64)
    counts[_AGAIN] += 2 * sum(map(operator.eq, words, words[1:]))
    return np.sqrt(counts / max(1.0, counts.sum()))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, q: np.ndarray, rounds: int = 150, penalty: float = 1e-4) -> Scorer:
        """Logistic regression on soft labels by accelerated gradient steps, in single precision; deterministic."""
        x, q, f = x.astype(np.float32, copy=False), q.astype(np.float32), np.float32
        w, b = np.zeros(x.shape[1], f), f(0)
        pw, pb, rate = w.copy(), b, f(4.0)  # rows have unit length, and the loss bends by a quarter
        share = min(max(float(q.mean()), 1e-6), 1 - 1e-6)
        scale = np.minimum(np.where(q >= 0.5, f(0.5 / share), f(0.5 / (1 - share))), f(10))  # both classes weigh the same
        for step in range(1, rounds + 1):
            p = 1 / (1 + np.exp(-np.clip(x @ pw + pb, -30, 30)))
            g = (p - q) * scale
            nw, nb = pw - rate * (g @ x / f(len(q)) + f(penalty) * pw), pb - rate * g.mean()
            k = f((step - 1) / (step + 2))
            pw, pb = nw + k * (nw - w), nb + k * (nb - b)
            w, b = nw, nb
        return cls(w.astype(np.float64), float(b))

    def score(self, words: list[str]) -> float:
        """The probability of good; 0 for a text without words."""
        if not words:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(features(words) @ self.weights + self.bias, -30, 30))))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    use_worker("quality", _clear)
    for batch in batches:
        for (texts,) in pieces(batch, "text"):
            yield pa.RecordBatch.from_arrays([pa.array([pattern(t) for t in texts], pa.int32())], names=["pattern"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    use_worker("quality", _clear)
    for batch in batches:
        for orders, texts in pieces(batch, "order", "text"):
            split = [(t or "").split() for t in texts]
            found = [features(w) for w in split]
            at = [np.flatnonzero(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(orders, pa.int64()), pa.array([pattern(t, w) for t, w in zip(texts, split, strict=True)], pa.int32()), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()), pa.array([f[a].astype("<f4").tobytes() for f, a in zip(found, at, strict=True)], pa.binary())],
                names=["order", "pattern", "at", "value"],
            )


@dataclass
class QualityModel:
    labels: LabelModel
    scorer: Scorer
    threshold: float = 0.5


def fit(docs: DataFrame, sample: int = 4000) -> QualityModel | None:
    """The model of docs(doc_id, text): vote patterns of all documents, the scorer from about `sample` of them.
    None if there are no documents."""
    with small_batches(docs.sparkSession):
        counted = docs.select("text").mapInArrow(_patterns, "pattern int").groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    if not counted:
        return None
    patterns, counts = np.array([r.pattern for r in counted]), np.array([float(r.n) for r in counted])
    labels = LabelModel.fit(patterns, counts)
    order = F.xxhash64(F.lit(5), "doc_id", "text")
    share = min(1.0, sample / counts.sum())
    chosen = docs.select(order.alias("order"), "text").where(F.pmod("order", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    chosen = chosen.groupBy("order").agg(F.first("text").alias("text"))
    with small_batches(docs.sparkSession):
        rows = chosen.mapInArrow(_sampled, "order long, pattern int, at binary, value binary").collect()
    rows.sort(key=lambda r: (r.order, r.pattern))
    x = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r.value, "<f4")
    q = labels.posterior(np.array([r.pattern for r in rows], np.int64).reshape(-1)) if rows else np.zeros(0)
    scorer = Scorer.fit(x, q) if rows else Scorer(np.zeros(DIMENSIONS), 0.0)
    return QualityModel(labels, scorer)


def _scored(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_worker("quality", _clear)
        posterior: dict[int, float] = {}
        for batch in batches:
            for ids, ties, texts in pieces(batch, "doc_id", "tie", "text"):
                split = [(t or "").split() for t in texts]
                codes = [pattern(t, w) for t, w in zip(texts, split, strict=True)]
                for c in set(codes).difference(posterior):
                    posterior[c] = float(model.labels.posterior(np.array([c]))[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ties, pa.int64()), pa.array(codes, pa.int32()), pa.array([posterior[c] for c in codes], pa.float64()), pa.array([model.scorer.score(w) for w in split], pa.float64())],
                    names=["doc_id", "tie", "pattern", "weak_posterior", "score"],
                )

    return run


def classify(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id, pattern, weak_posterior, score, keep of every row of docs(doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("tie"), "text")
    if model is None:
        return rows.select("doc_id", F.lit(0).alias("pattern"), F.lit(0.0).alias("weak_posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("keep"))
    out = rows.mapInArrow(_scored(model), "doc_id long, tie long, pattern int, weak_posterior double, score double").drop("tie")
    return out.withColumn("keep", F.col("score") >= model.threshold)


def keep_good(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """The rows of docs that the model keeps; columns stay as they are."""
    if model is None:
        return docs
    scorer, threshold, place = model.scorer, model.threshold, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_worker("quality", _clear)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                good = [scorer.score((t or "").split()) >= threshold for t in part.column(place).to_pylist()]
                yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
