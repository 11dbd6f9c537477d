"""Toxicity by multiple-instance learning: a document is toxic when at least one of its sentences is.

A sentence's probability is the logistic of a bias and the weights of its words (each as a whole and by its first
four, five and six letters); a document's is their noisy-or, 1 - prod(1 - p).  Only document labels are learned from;
the sentence scores come out of the same model and locate what is offensive.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from corpus_audit.llm.common import held_out, keyed_texts, sliced, stash, unused

SAMPLE_PER_CLASS, VOCABULARY, LEAST_Z = 6000, 4096, 3.5
STEPS, RATE, PENALTY = 300, 0.1, 1e-5

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str) -> list[str]:
    """A word, and its beginnings of four to six letters where it is longer."""
    return [word, *(f"{word[:k]}-" for k in (4, 5, 6) if len(word) > k)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each run between full stops, exclamation and question marks, and line ends."""
    return [m.span() for m in _SENTENCE.finditer(text)]


class _Weights(dict):
    """Word -> sum of the weights of its features; cleared when full."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        value = sum(self.weights.get(f, 0.0) for f in features(word))
        self[word] = value
        return value


@dataclass
class Model:
    bias: float
    weights: dict[str, float]

    def scorer(self):
        """text -> (noisy-or of its sentences, [(start, end, probability) of each sentence])."""
        words = _Weights(self.weights)
        get, bias = words.__getitem__, self.bias
        floor = np.log1p(np.exp(bias))

        def run(text: str) -> tuple[float, list[tuple[int, int, float]]]:
            low = text.lower()
            spans, total, out = sentences(low), 0.0, []
            for a, b in spans:
                z = sum({w: get(w) for w in _WORD.findall(low, a, b)}.values())
                if z:
                    z = np.logaddexp(0, min(z + bias, 500.0))
                    total += z
                    out.append((a, b, float(-np.expm1(-z))))
                else:
                    total += floor
                    out.append((a, b, float(-np.expm1(-floor))))
            return float(-np.expm1(-total)), out

        return run


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, y, weight) and the rows of each class: of each class the ``per_class`` labelled rows of ``docs``, not held out, whose ids hash lowest.

    Labels of ids that ``docs`` does not hold are neither drawn nor counted.
    Their number is bounded, so their ids are broadcast and no text moves.  ``weight`` restores the share of the class.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    # a null id meets none; the ids of all documents are read once
    marks = stash(marks.join(keyed_texts(docs).select("doc_id"), "doc_id", "left_semi"), "marks")
    counts = {r.y: r["count"] for r in marks.groupBy("y").count().collect()}
    parts = [
        marks.where(F.col("y") == y)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_class)
        .withColumn("weight", F.lit(max(1.0, counts.get(y, 0) / per_class)))
        for y in (0, 1)
    ]
    rows = keyed_texts(docs).join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select("text", "y", "weight")
    return rows, {y: min(counts.get(y, 0), per_class) for y in (0, 1)}


def vocabulary(sample: DataFrame, n: dict[int, int], size: int, least: float) -> list[str]:
    """The ``size`` features that most exceed their share among clean documents in toxic ones, by the z statistic of
    two proportions, of those with a z of at least ``least``."""

    def counted(batches):
        flush = lambda c: pa.RecordBatch.from_pydict(
            {"f": pa.array([k[0] for k in c], pa.string()), "y": pa.array([k[1] for k in c], pa.int32()), "n": pa.array(list(c.values()), pa.int64())}
        )
        seen: Counter = Counter()
        for batch in sliced(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {f for w in set(_WORD.findall((text or "").lower())) for f in features(w)}
                seen.update((f, y) for f in found)
            if len(seen) > 300_000:
                yield flush(seen)
                seen = Counter()
        if seen:
            yield flush(seen)

    pairs = sample.select("text", "y").mapInArrow(counted, "f string, y int, n long")
    rows = pairs.groupBy("f").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good"),
    )
    pooled = (F.col("bad") + F.col("good")) / float(n[0] + n[1])
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    z = (F.col("bad") / n[1] - F.col("good") / n[0]) / F.greatest(spread, F.lit(1e-9))
    picked = rows.withColumn("z", z).where(F.col("z") >= least).orderBy(F.desc("z"), "f").limit(size)
    return [r.f for r in picked.select("f").collect()]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
    size: int = VOCABULARY,
    least: float = LEAST_Z,
) -> Model:
    """Learn from at most ``per_class`` labelled rows of each class that are not held out.

    Without rows of both classes nothing is known to be toxic: no weights and a bias of -20.
    """
    sample, n = training_sample(docs, labels, label, per_class)
    if not n[0] or not n[1]:
        return Model(-20.0, {})
    words = vocabulary(sample, n, size, least)
    place = {f: k for k, f in enumerate(words)}

    def hits(batches):
        """Per document the number of sentences, and for each with known features their places."""
        for batch in sliced(batches):
            n, found = [], []
            for text in batch.column(0).to_pylist():
                low = (text or "").lower()
                spans = sentences(low)
                n.append(len(spans))
                own = ({place[f] for w in set(_WORD.findall(low, a, b)) for f in features(w) if f in place} for a, b in spans)
                found.append([sorted(s) for s in own if s])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(n, pa.int32()), pa.array(found, pa.list_(pa.list_(pa.int32())))],
                ["y", "weight", "n", "hits"],
            )

    rows = sample.mapInArrow(hits, "y int, weight double, n int, hits array<array<int>>").collect()
    y = np.array([r.y for r in rows], dtype=np.float64)
    if len(set(y)) < 2:
        return Model(-20.0, {})
    weight = np.array([r.weight for r in rows])
    weight /= weight.sum()
    idle = np.array([r.n - len(r.hits) for r in rows], dtype=np.float64)
    owner = np.array([k for k, r in enumerate(rows) for _ in r.hits], dtype=np.int64)
    lengths = np.array([len(s) for r in rows for s in r.hits], dtype=np.int64)
    flat = np.array([f for r in rows for s in r.hits for f in s], dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    w, bias = np.zeros(len(words)), -6.0
    m1, m2 = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(row, w[flat], len(lengths))
        total = np.bincount(owner, np.logaddexp(0, z), len(rows)) + idle * np.logaddexp(0, bias)
        # -log p of a toxic document by d(total); a clean one has loss total
        slope = weight * np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        rise = 1 / (1 + np.exp(-z)) * slope[owner]
        grad = np.append(np.bincount(flat, rise[row], len(words)) + PENALTY * w, rise.sum() + (slope * idle).sum() / (1 + np.exp(-bias)))
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], float(bias - move[-1])
    return Model(bias, {f: float(v) for f, v in zip(words, w) if abs(v) > 1e-3})


OFFENDING = ArrayType(
    StructType(
        [
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
            StructField("score", DoubleType()),
            StructField("sentence", StringType()),
        ]
    )
)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", offending: str | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` with ``name`` (0..1) and, if asked for, ``offending``: the sentences of at least ``least``.

    All other columns stay; columns that have these names already are replaced.  Null and empty texts have no
    sentence and score 0.  Offsets count characters of the lower-cased text.
    """
    kept = docs.drop(name, *([offending] if offending else []))
    fields = [StructField(name, DoubleType())] + ([StructField(offending, OFFENDING)] if offending else [])
    schema = StructType([*kept.schema.fields, *fields])
    at = kept.columns.index(text)
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("sentence", pa.string())])
    )

    def run(batches):
        rate = model.scorer()
        for batch in sliced(batches):
            scores, where = [], []
            for t in batch.column(at).to_pylist():
                value, parts = rate(t or "")
                scores.append(value)
                if offending:
                    low = (t or "").lower()
                    where.append([{"start": a, "end": b, "score": p, "sentence": low[a:b]} for a, b, p in parts if p >= least])
            columns = [*batch.columns, pa.array(scores, pa.float64())] + ([pa.array(where, kind)] if offending else [])
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return kept.mapInArrow(run, schema)


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns they came with, whatever their names.

    Null texts score as empty ones; repeated rows score alike and each stays or goes; an empty table gives no row.
    """
    name = unused(docs, "_toxic")
    return score(docs, fit(docs, labels), name=name).where(F.col(name) < threshold).drop(name)
