"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Statistics of a text (``STATISTICS``) are transformed (log, logit-like and power scales), standardised, and modelled as
one Gaussian a class. A class covariance is shrunk towards the pooled one and that towards a multiple of the identity;
its Cholesky factor is kept, so a score costs two triangular products: the difference of the classes' Mahalanobis
distances, log-determinants and log-priors. A document of score >= 0 is kept.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows of each class (those of least hash of the doc_id). Shrinkage and
the bias are chosen on one fifth of them, of models fitted on three fifths; ``held_out`` is the balanced accuracy of the chosen one
on the last fifth, which nothing was chosen by. The model itself is then fitted on all of them.

Defined results: null and empty texts have all statistics 0 and are scored like others; a text without letters as well;
repeated rows are scored alike; a doc_id with several labels takes the lowest, one with several texts the longest (of
equally long ones the last in order); rows without a doc_id are dropped; without rows of both classes every score is 0 and
everything is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import U, Words, mix, read, slices, texts

TRAIN_ROWS = 4000
STATISTICS = (
    "characters", "words", "word_length", "word_length_spread", "distinct_words", "symbols", "digits", "capitals", "spaces",
    "line_length", "repeated_lines", "entropy", "repeated_pairs", "sentence_ends",
)
_KIND = np.zeros(256, np.int64)  # 0 letters (and bytes beyond ASCII), 1 digits, 2 capitals, 3 white space, 4 sentence ends, 5 others
_KIND[:128] = 5
_KIND[97:123] = 0
_KIND[48:58], _KIND[65:91], _KIND[[9, 10, 11, 12, 13, 32]] = 1, 2, 3
_KIND[[33, 46, 63]] = 4


def _distinct(owner: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each owner."""
    joint = np.sort(key ^ mix(owner.astype(U)))
    new = np.flatnonzero(np.concatenate(([True], joint[1:] != joint[:-1]))) if len(joint) else np.empty(0, np.int64)
    order = np.argsort(key ^ mix(owner.astype(U)))
    return np.bincount(owner[order[new]], minlength=n)


def statistics(column: pa.Array) -> np.ndarray:
    """Transformed statistics, a row a text."""
    w = Words(column, lower=False)
    n = len(w.count)
    size = np.diff(w.offsets).astype(float)
    row = np.repeat(np.arange(n), np.diff(w.offsets))
    kind = np.bincount(row * 6 + _KIND[w.bytes], minlength=6 * n).reshape(n, 6).astype(float)
    length = (w.ends - w.starts).astype(float)
    count = np.maximum(w.count, 1).astype(float)
    mean = np.bincount(w.doc, length, n) / count
    spread = np.sqrt(np.maximum(0, np.bincount(w.doc, length**2, n) / count - mean**2))
    unique = _distinct(w.doc, w.hash, n)
    same = w.doc[1:] == w.doc[:-1]
    pair = (w.hash[:-1] * U(0x9E3779B97F4A7C15) + w.hash[1:])[same]
    pairs = _distinct(w.doc[:-1][same], pair, n)
    # A line ends at a break, or with its text; a break at a text's end begins no further line.
    breaks, last = np.flatnonzero(w.bytes == 10), w.offsets[1:][size > 0]
    last = last[w.bytes[last - 1] != 10]
    ends = np.concatenate((breaks, last))
    line_row = np.searchsorted(w.offsets, np.concatenate((breaks, last - 1)), "right") - 1
    order = np.argsort(ends + np.concatenate((np.zeros(len(breaks)), np.full(len(last), -0.5))))
    ends, line_row = ends[order], line_row[order]
    fresh = np.concatenate(([True], line_row[1:] != line_row[:-1])) if len(ends) else np.empty(0, bool)
    begins = np.where(fresh, w.offsets[line_row], np.concatenate(([0], ends[:-1] + 1))[: len(ends)])
    lines = np.bincount(line_row, minlength=n).astype(float)
    line_hash = w.span(begins, ends) ^ mix((ends - begins).astype(U))
    line_unique = _distinct(line_row, line_hash, n)
    symbols = np.bincount(row * 256 + w.bytes, minlength=256 * n).reshape(n, 256) / np.maximum(size, 1)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(symbols > 0, symbols * np.log2(np.where(symbols > 0, symbols, 1)), 0).sum(1)
    share = kind / np.maximum(size, 1)[:, None]
    return np.column_stack([
        np.log1p(size), np.log1p(w.count), np.log1p(mean), np.log1p(spread),
        np.sqrt(unique / count), np.sqrt(share[:, 5]), np.sqrt(share[:, 1]), np.sqrt(share[:, 2]), share[:, 3],
        np.log1p(size / np.maximum(lines, 1)), (1 - line_unique / np.maximum(lines, 1)) * (lines > 0), entropy,
        (1 - pairs / np.maximum(w.count - 1, 1)) * (w.count > 1), np.sqrt(share[:, 4]),
    ])


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverses of the Cholesky factors
    constants: list[float]
    bias: float = 0.0
    held_out: float = float("nan")  # balanced accuracy

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-density of quality 1 less that of quality 0, with priors."""
        if not self.means:
            return np.zeros(len(x))
        z = (x - self.centre) / self.scale
        log = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return log[1] - log[0] + self.bias


def fit(x: np.ndarray, y: np.ndarray, to_pooled: float, to_identity: float) -> Model:
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - centre) / scale
    groups = [z[y == k] for k in (0, 1)]
    means = [g.mean(0) for g in groups]
    own = [np.cov(g, rowvar=False, bias=True).reshape(x.shape[1], -1) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / len(x)
    factors, constants = [], []
    for g, c in zip(groups, own):
        s = (1 - to_pooled) * c + to_pooled * pooled
        s = (1 - to_identity) * s + to_identity * max(np.trace(s) / len(s), 1e-6) * np.eye(len(s))
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(len(g) / len(x)) - np.log(np.diag(lower)).sum()))
    return Model(centre, scale, means, factors, constants)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample; a fifth is held out to choose the shrinkage and then counts as well."""
    sure = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    parts = [sure.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]

    def measure(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(list(statistics(part.column("text"))), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    sample = texts(docs).join(F.broadcast(parts[0].union(parts[1])), "doc_id").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.struct(F.octet_length("text").alias("size"), "text")).alias("s")
    )
    measured = sample.select("doc_id", "quality", "s.text").mapInArrow(measure, "doc_id long, quality int, x array<double>")
    data = sorted(measured.collect(), key=lambda r: r.doc_id)
    return chosen(np.array([r.x for r in data]).reshape(len(data), len(STATISTICS)), np.array([r.quality for r in data], np.int64))


def balanced(scores: np.ndarray, y: np.ndarray, bias: float = 0.0) -> float:
    """Balanced accuracy of keeping what scores 0 or more."""
    keep = scores + bias >= 0
    return float((keep[y == 1].mean() + (~keep)[y == 0].mean()) / 2)


def chosen(x: np.ndarray, y: np.ndarray) -> Model:
    """The model whose shrinkage and bias are best on a part of the rows."""
    if min((y == 0).sum(), (y == 1).sum()) < 5:
        return Model(np.zeros(0), np.zeros(0), [], [], [])
    # Fifths of each class by itself, so none lacks a class.
    fifth = np.zeros(len(y), np.int64)
    for k in (0, 1):
        fifth[y == k] = np.arange((y == k).sum()) % 5
    base, tune, rest = fifth < 3, fifth == 3, fifth == 4
    best = None
    for to_pooled in (0.0, 0.1, 0.5):
        for to_identity in (0.001, 0.01, 0.1):
            model = fit(x[base], y[base], to_pooled, to_identity)
            s = model.scores(x[tune])
            # Biases between the scores; no bias comes first, then the least.
            cuts = np.unique(s)
            for bias in [0.0, *sorted((-(cuts[1:] + cuts[:-1]) / 2).tolist(), key=abs)]:
                found = balanced(s, y[tune], bias)
                if best is None or found > best[0]:
                    best = found, to_pooled, to_identity, bias, model
    _, to_pooled, to_identity, bias, model = best
    final = fit(x, y, to_pooled, to_identity)
    final.bias, final.held_out = float(bias), balanced(model.scores(x[rest]), y[rest], bias)
    return final


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, keep of every document; nothing is shuffled."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                s = model.scores(statistics(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), pa.array(s >= 0)], ["doc_id", "score", "keep"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, keep boolean")


def op5_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, by a model fitted on the labelled ones."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels")))

