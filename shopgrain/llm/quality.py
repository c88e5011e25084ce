"""Quality classifier: cumulative-link regression on graded ratings, over hashed text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shopgrain.llm.common import per_batch, words_of
from shopgrain.llm.tokens import Remembered

BUCKETS = 1 << 18  # hashed features
SAMPLE = 6000  # labelled rows to fit on, about; a fixed bound
_RUN = regex.compile(rb"([A-Z])\1*|([a-z\x80-\xff])+|([0-9])+|(.)\4*", regex.S)


def shape(word: bytes) -> bytes:
    """The word with each run of one kind of character as one sign: letters, digits, the rest."""
    return b"".join(
        b"A" if m[1] else b"a" if m[2] else b"0" if m[3] else m[4] for m in _RUN.finditer(word)
    )[:24]


def _word_buckets(word: bytes) -> tuple[int, int]:
    kind = xxhash.xxh3_64_intdigest(b"\x01" + shape(word)) % BUCKETS
    return xxhash.xxh3_64_intdigest(word.lower()) % BUCKETS, kind


class Features:
    """Hashed features of a text: its words' shares and its word shapes' shares, each part with
    length one, so that long and short texts compare."""

    def __init__(self) -> None:
        self.memo = Remembered(_word_buckets)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(text)
        if not words:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
        flat = np.array(list(map(self.memo.__getitem__, words)), dtype=np.int32)
        at, value = [], []
        for column in flat.T:
            ids, counts = np.unique(column, return_counts=True)
            share = np.sqrt(counts / len(words))
            at.append(ids)
            value.append(share)
        return np.concatenate(at), np.concatenate(value).astype(np.float32)


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(weights . x - thresholds[k]), thresholds in rising order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(self.thresholds - float(self.weights[at] @ value)))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int,
    steps: int = 150, rate: float = 0.3, decay: float = 1e-5,
) -> OrdinalModel:
    """Maximum likelihood by Adam on the whole sample. The first threshold is free, the others are
    sums of exponentials above it, so they stay in order."""
    at = np.concatenate([a for a, _ in rows]) if rows else np.zeros(0, dtype=np.int32)
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    doc = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    params = np.zeros(BUCKETS + levels - 1)
    for k in range(1, levels):  # start at the shares of the grades
        share = min(max(float(np.mean(grades >= k)) if len(grades) else 0.5, 1e-3), 1 - 1e-3)
        params[BUCKETS + k - 1] = -np.log(share / (1 - share))
    cuts = np.maximum.accumulate(params[BUCKETS:] + 1e-3 * np.arange(levels - 1))
    params[BUCKETS + 1 :] = np.log(np.maximum(np.diff(cuts), 1e-3))
    first, second = np.zeros_like(params), np.zeros_like(params)
    n = max(1, len(rows))
    for step in range(1, steps + 1 if len(rows) else 1):
        w, gaps = params[:BUCKETS], np.exp(params[BUCKETS + 1 :])
        cuts = params[BUCKETS] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(doc, w[at] * value, minlength=len(rows))
        tails = 1 / (1 + np.exp(np.clip(cuts[None, :] - z[:, None], -30, 30)))
        edges = np.hstack([np.ones((len(z), 1)), tails, np.zeros((len(z), 1))])
        slopes = edges * (1 - edges)
        i = np.arange(len(z))
        p = np.maximum(edges[i, grades] - edges[i, grades + 1], 1e-9)
        upper, lower = slopes[i, grades] / p, slopes[i, grades + 1] / p
        dz = upper - lower  # of the log-likelihood by the score
        dcuts = np.zeros(levels - 1)
        np.add.at(dcuts, grades[grades > 0] - 1, -upper[grades > 0])
        np.add.at(dcuts, grades[grades < levels - 1], lower[grades < levels - 1])
        grad = np.empty_like(params)
        grad[:BUCKETS] = -np.bincount(at, dz[doc] * value, minlength=BUCKETS) / n + decay * w
        tail_sums = np.cumsum(dcuts[::-1])[::-1]
        grad[BUCKETS] = -tail_sums[0] / n
        grad[BUCKETS + 1 :] = -tail_sums[1:] * gaps / n
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    cuts = params[BUCKETS] + np.concatenate([[0], np.cumsum(np.exp(params[BUCKETS + 1 :]))])
    return OrdinalModel(params[:BUCKETS].astype(np.float32), cuts)


def grade_of(quality: Column, toxic: Column) -> Column:
    """The graded rating in the labels: 0 poor, 1 sound but toxic, 2 sound."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).when(quality == 1, 2)


def bounded_sample(df: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows, the same ones each time: those whose key hashes below a share."""
    total = df.count()
    if total <= most:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * most / total))


def train(
    docs: DataFrame, graded: DataFrame, levels: int = 3, sample: int = SAMPLE,
    id_col: str = "doc_id", text_col: str = "text",
) -> OrdinalModel:
    """Fit on about ``sample`` rows of ``graded`` (id, grade) that have a text in ``docs``.

    Rows without a grade are left out, a repeated id counts as often as it is there. Features are
    made by tasks; the driver gets those of the sample only, and fits them.
    """
    rated = bounded_sample(graded.where("grade IS NOT NULL"), F.col("id"), sample)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).join(
        rated, "id"
    ).select("t", F.col("grade").cast("int"))

    def make():
        features = Features()

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            made = [features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a.tobytes() for a, _ in made], pa.binary()),
                    pa.array([v.tobytes() for _, v in made], pa.binary()), batch.column(1),
                ],
                ["at", "value", "grade"],
            )

        return step

    got = per_batch(src, make, "at binary, value binary, grade int").toPandas()
    got = got.sort_values(["grade", "at", "value"], kind="stable")  # not by arrival
    rows = [
        (np.frombuffer(a, dtype=np.int32), np.frombuffer(v, dtype=np.float32))
        for a, v in zip(got["at"], got["value"])
    ]
    return fit(rows, got["grade"].to_numpy(dtype=np.int64), levels)


def score(df: DataFrame, model: OrdinalModel, tail: int = 1, text_col: str = "text") -> DataFrame:
    """``row`` (the input's columns), ``expected_grade`` and ``tail_probability``, P(grade >= tail).

    Null and empty texts have no features and get the thresholds' own probabilities.
    """

    def make():
        features = Features()

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            above = [model.above(*features(t.as_py())) for t in batch.column(1)]
            table = np.array(above).reshape(-1, len(model.thresholds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(table.sum(axis=1)), pa.array(table[:, tail - 1])],
                ["row", "expected_grade", "tail_probability"],
            )

        return step

    src = df.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("t"))
    out = StructType([
        src.schema["row"], StructField("expected_grade", DoubleType()),
        StructField("tail_probability", DoubleType()),
    ])
    return per_batch(src, make, out)


def select_quality(
    docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = SAMPLE
) -> DataFrame:
    """``score`` of ``docs`` by a model of ``labels`` (doc_id, quality, toxic), with ``kept``: the
    probability of more than the poorest grade is at least ``least``. With no labels all are kept."""
    graded = labels.select(
        F.col("doc_id").alias("id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade")
    )
    model = train(docs, graded, sample=sample)
    return score(docs, model).withColumn("kept", F.col("tail_probability") >= least)
