"""Toxicity: sentence scores joined by noisy-or, learned from document labels."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StringType, StructField, StructType,
)

from shopgrain.llm.common import per_batch, store
from shopgrain.llm.quality import bounded_sample
from shopgrain.llm.tokens import Remembered

SAMPLE = 8000  # labelled rows to learn from, about; a fixed bound
PREFIXES = (4, 5, 6, 7)  # characters; words of one stem share a prefix
_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGES = " \t\r\x0b\x0c,;:|\"'()[]#*$%&<>-_"


def _code(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "replace")) >> 33


def word_features(word: str) -> tuple[int, ...]:
    """31-bit codes of the word and its proper prefixes."""
    word = word.strip(_EDGES).lower()
    if not word:
        return ()
    return (_code("=" + word), *(_code(word[:n]) for n in PREFIXES if n < len(word)))


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Character ranges between full stops, exclamation and question marks and line ends."""
    return [m.span() for m in _SENTENCE.finditer(text or "") if not m[0].isspace()]


@dataclass
class NoisyOr:
    """P(document) = 1 - prod(1 - sigmoid(bias + weights of the sentence's features))."""

    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def scorer(self):
        get = self.weights.get
        memo = Remembered(lambda w: sum(get(f, 0.0) for f in word_features(w)))

        def scores(text: str | None) -> tuple[list[tuple[int, int]], np.ndarray]:
            spans = sentences(text)
            z = [sum(map(memo.__getitem__, text[a:b].split())) for a, b in spans]
            return spans, np.clip(np.array(z, dtype=float) + self.bias, -30, 30)

        return scores


def fit(
    codes: np.ndarray, features: np.ndarray, sentence_of: np.ndarray, doc_of: np.ndarray,
    labels: np.ndarray, steps: int = 150, rate: float = 0.2, decay: float = 1e-5,
) -> NoisyOr:
    """Maximum likelihood of the document labels, by Adam over the whole sample.

    ``features`` (places in ``codes``) and ``sentence_of`` list the feature occurrences, ``doc_of``
    the document of each sentence.
    """
    n = len(labels)
    w = np.zeros(len(codes) + 1)
    w[-1] = -5.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1 if n else 1):
        z = np.clip(np.bincount(sentence_of, w[features], minlength=len(doc_of)) + w[-1], -30, 30)
        none = np.bincount(doc_of, -np.logaddexp(0, z), minlength=n)  # log of no toxic sentence
        miss = np.exp(none) / np.maximum(-np.expm1(none), 1e-6)
        dz = np.where(labels == 1, miss, -1.0)[doc_of] / (1 + np.exp(-z))
        of_codes = np.bincount(features, dz[sentence_of], minlength=len(codes))
        grad = np.append(of_codes, dz.sum()) / -n
        grad[:-1] += decay * w[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
    return NoisyOr(float(w[-1]), dict(zip(codes.tolist(), w[:-1].tolist())))


def telling_features(
    rated: DataFrame, least_rows: int = 5, least_signal: float = 4.0
) -> np.ndarray:
    """Features in ``least_rows`` rows of ``rated`` (t, label) whose log-odds between the labels is
    ``least_signal`` standard errors from zero, counted by Spark. The many rare words of a sample
    would otherwise explain its toxic documents one by one."""

    def make():
        memo = Remembered(word_features)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                own = {f for w in set((text.as_py() or "").split()) for f in memo[w]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([label] * len(own), pa.int32())],
                    ["feature", "label"],
                )

        return step

    total = rated.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    toxic, clean = F.col("toxic") + 0.5, F.col("n") - F.col("toxic") + 0.5
    odds = F.log(toxic / (total["toxic"] + 1)) - F.log(clean / (total["n"] - total["toxic"] + 1))
    error = F.sqrt(1 / toxic + 1 / clean)
    found = (
        per_batch(rated, make, "feature int, label int")
        .groupBy("feature").agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
        .where((F.col("n") >= least_rows) & (F.abs(odds) > least_signal * error))
        .select("feature").collect()
    )
    return np.array(sorted(r["feature"] for r in found), dtype=np.int64)


def train(
    docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
    text_col: str = "text",
) -> NoisyOr:
    """Learn from about ``sample`` rows of ``labelled`` (id, label 0 or 1) that have a text.

    Rows without a label are left out. Tasks find the telling features and where they occur; the
    driver gets those of the sample and fits their weights. Without rows every text scores low.
    """
    chosen = bounded_sample(labelled.where("label IS NOT NULL"), F.col("id"), sample)
    rated = store(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
        .join(chosen, "id").select("t", F.col("label").cast("int").alias("label")),
        "rated",
    )
    codes = telling_features(rated)
    place = {code: i for i, code in enumerate(codes.tolist())}

    def make():
        memo = Remembered(lambda w: [place[f] for f in word_features(w) if f in place])

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            made = []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py()
                own = [
                    sorted({f for w in text[a:b].split() for f in memo[w]})
                    for a, b in sentences(text)
                ]
                made.append((
                    np.array([f for s in own for f in s], dtype=np.int32).tobytes(),
                    np.array([len(s) for s in own], dtype=np.int32).tobytes(), label,
                ))
            kinds = (pa.binary(), pa.binary(), pa.int32())
            columns = [pa.array([r[i] for r in made], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["features", "sizes", "label"])

        return step

    got = per_batch(rated, make, "features binary, sizes binary, label int").toPandas()
    got = got.sort_values(["label", "features", "sizes"], kind="stable")  # not by arrival
    each = [np.frombuffer(c, dtype=np.int32) for c in got["sizes"]]
    doc_of = np.repeat(np.arange(len(got)), [len(c) for c in each])
    sizes = np.concatenate(each) if each else np.zeros(0, dtype=np.int32)
    features = np.frombuffer(b"".join(got["features"]), dtype=np.int32)
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    return fit(codes, features, sentence_of, doc_of, got["label"].to_numpy())


def score(
    df: DataFrame, model: NoisyOr, offending: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``row`` (the input's columns), ``score`` (0 to 1) and ``sentences``: start, end (characters),
    probability and text of each sentence whose own probability is at least ``offending``.

    Texts without a sentence, null and empty ones too, score 0.
    """
    src = df.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("t"))
    found = StructType([
        StructField("start", IntegerType()), StructField("end", IntegerType()),
        StructField("probability", DoubleType()), StructField("text", StringType()),
    ])
    out = StructType([
        src.schema["row"], StructField("score", DoubleType()),
        StructField("sentences", ArrayType(found)),
    ])
    kind = pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64()),
        ("text", pa.string()),
    ]))
    least = float(np.log(offending / (1 - offending)))

    def make():
        scores = model.scorer()

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            totals, located = [], []
            for text in batch.column(1):
                text = text.as_py()
                spans, z = scores(text)
                totals.append(float(-np.expm1(-np.logaddexp(0, z).sum())))
                located.append([
                    {
                        "start": spans[i][0], "end": spans[i][1],
                        "probability": float(1 / (1 + np.exp(-z[i]))),
                        "text": text[spans[i][0] : spans[i][1]],
                    }
                    for i in np.flatnonzero(z >= least)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.float64()), pa.array(located, kind)],
                out.names,
            )

        return step

    return per_batch(src, make, out)
