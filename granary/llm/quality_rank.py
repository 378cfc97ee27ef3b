"""Quality scores from preference pairs (Bradley-Terry).

Of two documents the one with the better label is preferred with probability sigmoid(score difference), and a score is a
weighted sum of features, so logistic loss on feature differences gives the weights. A quantile of the scores, the share of
documents with the worse label, becomes the threshold; scores are mapped to 0..1 so that it falls on ``at``.

Features come from the text alone: each measure below is cut at quantiles of the training sample and enters as one
indicator per interval.

Defined cases: a null or empty text has measures of an empty text and gets a score; rows without a label are scored only;
a document with several labels counts once per label; with no labels, or labels of one kind, every score is ``at``;
repeated rows are scored alike; extra columns of the documents pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted on at most, and pairs drawn from them.
SAMPLE, PAIRS = 20_000, 60_000
BINS = 12
SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")
DIGIT = re.compile(r"[0-9]")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
STOP = re.compile(r"[.!?]")


def measures(text: str) -> list[float]:
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, chars = len(words), len(text)
    per_word, per_char = 1 / max(n, 1), 1 / max(chars, 1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    letters = sum(map(len, words))
    return [
        float(n),
        letters * per_word,
        len(counts) * per_word,
        len(pairs) / max(n - 1, 1),
        max(counts.values(), default=0) * per_word,
        len(SYMBOL.findall(text)) * per_char,
        len(DIGIT.findall(text)) * per_char,
        len(CAPITAL.findall(text)) * per_char,
        len(STOP.findall(text)) * per_word,
        text.count(",") * per_word,
        chars / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        max(map(len, counts), default=0),
        sum(len(w) <= 3 for w in words) * per_word,
    ]


NAMES = ["n_words", "word_length", "distinct", "distinct_pairs", "top_word", "symbols", "digits", "capitals", "stops", "commas", "line_length", "repeated_lines", "longest_word", "short_words"]


@dataclass
class Model:
    edges: np.ndarray  # measures x inner bounds
    weights: np.ndarray  # measures x intervals
    threshold: float
    scale: float
    at: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return sum((self.weights[j][np.searchsorted(self.edges[j], x[:, j], side="right")] for j in range(x.shape[1])), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.raw(x) - self.threshold) * self.scale + np.log(self.at / (1 - self.at))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def add_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``measures``."""
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "measures array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(t.as_py() or "") for t in batch.column(batch.schema.get_field_index(text))]
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.float64()))], names=[*(f.name for f in rest), "measures"])

    return docs.mapInArrow(run, schema)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, at: float = 0.3, decay: float = 1e-3, rounds: int = 300, seed: int = 7) -> Model:
    """Weights from pairs of a better (1) and a worse (0) row."""
    m = x.shape[1]
    edges = np.array([np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]) for j in range(m)]) if len(x) else np.zeros((m, BINS - 1))
    weights = np.zeros((m, BINS))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(edges, weights, 0.0, 1.0, at)
    cell = np.stack([np.searchsorted(edges[j], x[:, j], side="right") + j * BINS for j in range(m)], axis=1)
    draw = np.random.default_rng(seed)
    a, b = cell[draw.choice(good, pairs)], cell[draw.choice(bad, pairs)]
    w, speed = np.zeros(m * BINS), np.zeros(m * BINS)
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(w[a].sum(1) - w[b].sum(1)))
        grad = decay * w
        grad -= np.bincount(a.ravel(), np.repeat(miss, m), m * BINS) / pairs
        grad += np.bincount(b.ravel(), np.repeat(miss, m), m * BINS) / pairs
        speed = 0.9 * speed - grad
        w = w + speed
    model = Model(edges, w.reshape(m, BINS), 0.0, 1.0, at)
    raw = model.raw(x)
    model.threshold = float(np.quantile(raw, len(bad) / (len(good) + len(bad))))
    model.scale = float(2 / max(raw.std(), 1e-9))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id and 0/1), those whose ids hash lowest."""
    some = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("_y"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(sample)
    mine = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # ``sample`` rows at most
    rows = add_measures(mine.select("text", "_y")).collect()
    x = np.array([r["measures"] for r in rows]).reshape(len(rows), len(NAMES))
    return fit(x, np.array([r["_y"] for r in rows]))


def add_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``score`` in place of any column of that name."""
    rest = [f for f in docs.schema.fields if f.name not in (text, "score")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([measures(t.as_py() or "") for t in batch.column(batch.schema.get_field_index(text))]).reshape(batch.num_rows, len(NAMES))
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.score(x))], names=[*(f.name for f in rest), "score"])

    return docs.mapInArrow(run, schema)
