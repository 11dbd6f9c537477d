"""Quality by regularised quadratic discriminant analysis over transformed document statistics.

The class moments (count, sum, sum of products) are mergeable, so they are summed by Spark over every labelled
training row and only d + d^2 numbers per class reach the driver.  Each class covariance is shrunk towards the pooled
covariance and then towards a multiple of the identity; its Cholesky factor is kept, and a document's score is the
logistic of a straight line in the compressed difference of the two Gaussian log densities, fitted on counts of all
training rows.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpus_audit.llm.common import held_out, keyed_texts, sliced, stash, unused

POOLED, RIDGE = 0.85, 0.02

#: What is measured of a text, in this order; see ``statistics``.
NAMES = (
    "log_words mean_word sd_word upper letters digits symbols stops distinct top_word repeats lines_repeated "
    "log_sentence ratio shouts short_words trigrams_repeated"
).split()


def _kinds() -> np.ndarray:
    """Per UTF-16 code unit: is it upper case, a letter, a digit, a symbol, punctuation, the end of a sentence?"""
    units = [chr(k) for k in range(65536)]
    plain = set(".,;:!?'\"()-")
    tests = (
        str.isupper,
        str.isalpha,
        lambda c: c in "0123456789",
        lambda c: not (c.isalnum() or c.isspace() or c in plain or c == "_"),
        lambda c: c in ".,;:!?",
        lambda c: c in ".!?",
    )
    return np.array([[t(c) for t in tests] for c in units], dtype=np.float64)


_KINDS: list[np.ndarray] = []  # made once per worker


def _share(x: float) -> float:
    """A share in 0..1 on a scale where small shares are told apart."""
    return math.log(max(x, 0.0) + 0.005)


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text; a null or empty text counts as having one empty word."""
    if not _KINDS:
        _KINDS.append(_kinds())
    words = text.split() or [""]
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int32, n)
    chars = max(1, int(sizes.sum()))
    counts = Counter(words)
    units = np.bincount(np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16))
    upper, letters, digits, symbols, points, stops = units @ _KINDS[0][: len(units)]
    lines = text.split("\n")
    raw = text.encode("utf-8", "surrogatepass")
    follow = sum(map(operator.eq, words, words[1:]))
    triples = n - 2
    seen = len(set(zip(words, words[1:], words[2:]))) if triples > 0 else 0
    return [
        math.log1p(n),
        float(sizes.mean()),
        math.log1p(sizes.std()),
        _share(upper / max(1, letters)),
        _share(1 - letters / chars),
        _share(digits / chars),
        _share(symbols / chars),
        _share(points / chars),
        math.log(len(counts)) / math.log(n + 1),
        _share(max(counts.values()) / n) if n > 4 else _share(0.1),
        _share(follow / n),
        _share(1 - len(set(lines)) / len(lines)),
        math.log(n / max(1.0, stops)),
        math.log((len(zlib.compress(raw, 1)) + 1) / (len(raw) + 20)),
        _share(text.count("!!") / n),
        _share(float((sizes < 4).mean())),
        _share(1 - seen / triples) if triples > 0 else _share(0),
    ]


@dataclass
class Model:
    """Per class mean and inverse Cholesky factor, in standardised units; ``constant`` where a class is missing."""

    center: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    logdets: list[float]
    line: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """asinh of the log density ratio of class 1 to class 0."""
        z = (x - self.center) / self.scale
        density = [
            -0.5 * (((z - m) @ f.T) ** 2).sum(1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.logdets)
        ]
        return np.arcsinh(density[1] - density[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        slope, shift = self.line
        return 1 / (1 + np.exp(-np.clip(slope * self.difference(x) + shift, -500, 500)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(y, x): label and statistics of every labelled row that is not held out."""
    train = keyed_texts(docs).where(~held_out(F.col("doc_id")))

    def measured(batches):
        for batch in sliced(batches):
            x = [statistics(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    marks = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
    return train.mapInArrow(measured, "doc_id long, x array<double>").join(marks, "doc_id").select("y", "x")


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y = batch.column(0).to_numpy(zero_copy_only=False)
    return y, batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)


def moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per class the matrix of sums of (1, x)(1, x)^T over all training rows."""
    width = len(NAMES) + 1

    def summed(batches):
        sums = np.zeros((2, width, width))
        for batch in batches:
            y, x = _rows(batch)
            x = np.concatenate([np.ones((len(y), 1)), x], axis=1)
            for c in (0, 1):
                sums[c] += x[y == c].T @ x[y == c]
        at = np.arange(width * width, dtype=np.int32)
        for c in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), c, np.int32)), pa.array(at), pa.array(sums[c].ravel())], ["y", "at", "value"]
            )

    total = rows.mapInArrow(summed, "y int, at int, value double").groupBy("y", "at").agg(F.sum("value").alias("value"))
    out = {0: np.zeros(width * width), 1: np.zeros(width * width)}
    for r in total.collect():
        out[r.y][r["at"]] = r.value
    return {c: m.reshape(width, width) for c, m in out.items()}


def _fitted_line(u: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic in ``u`` on counted rows, by Newton steps with a light penalty on the slope."""
    a, b = 0.1, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        g = np.array([(n * (p - y) * u).sum() + a, (n * (p - y)).sum() + 1e-3 * b])
        w = n * p * (1 - p)
        h = np.array([[(w * u * u).sum() + 1, (w * u).sum()], [(w * u).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    """Learn from every labelled row that is not held out; labels other than 0 and 1 and null ids are ignored.

    Repeated label rows count each time.  Where a class has fewer than two rows the model is a constant: the share of
    label 1 among the labelled rows, or 0.5 without any.
    """
    rows = stash(training_rows(docs, labels, label), "quality-rows")
    sums = moments(rows)
    n = {c: m[0, 0] for c, m in sums.items()}
    d = len(NAMES)
    if min(n.values()) < 2:
        share = n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
        return Model(np.zeros(d), np.ones(d), [], [], [], constant=float(share))
    every = sums[0] + sums[1]
    center = every[0, 1:] / every[0, 0]
    variance = np.diag(every)[1:] / every[0, 0] - center**2
    scale = np.sqrt(np.maximum(variance, 1e-6))
    means, covariances = [], []
    for c in (0, 1):
        mean = sums[c][0, 1:] / n[c]
        cov = (sums[c][1:, 1:] - n[c] * np.outer(mean, mean)) / (n[c] - 1)
        means.append((mean - center) / scale)
        covariances.append(cov / np.outer(scale, scale))
    within = sum((n[c] - 1) * covariances[c] for c in (0, 1)) / (n[0] + n[1] - 2)
    factors, logdets = [], []
    for cov in covariances:
        cov = (1 - pooled) * cov + pooled * within
        cov = (1 - ridge) * cov + ridge * (np.trace(cov) / d + 1e-3) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        logdets.append(float(2 * np.log(np.diag(lower)).sum()))
    model = Model(center, scale, means, factors, logdets)

    def placed(batches):
        for batch in batches:
            y, x = _rows(batch)
            if len(y):
                u = np.round(model.difference(x) * 20).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(u)], ["y", "u"])

    bins = rows.mapInArrow(placed, "y int, u int").groupBy("y", "u").count().collect()  # some thousand at most
    u, y, k = (np.array(v, dtype=np.float64) for v in zip(*[(r.u / 20, r.y, r["count"]) for r in bins]))
    model.line = _fitted_line(u, y, k)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: likelihood of label 1 in 0..1, from the whole text alone.

    Rows, their order and all other columns stay; a column that has that name already is replaced.  Null and empty
    texts are scored like any other.
    """
    kept = docs.drop(name)
    schema = StructType([*kept.schema.fields, StructField(name, DoubleType())])
    at = kept.columns.index(text)

    def run(batches):
        for batch in sliced(batches):
            x = np.array([statistics(t or "") for t in batch.column(at).to_pylist()]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], schema.names)

    return kept.mapInArrow(run, schema)


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with the columns they came with, whatever their names.

    Null texts score as empty ones; repeated rows score alike and each stays or goes; an empty table gives no row.
    """
    name = unused(docs, "_quality")
    return score(docs, fit(docs, labels), name=name).where(F.col(name) >= threshold).drop(name)
