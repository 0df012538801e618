"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to ``orders``-grams of a text's lower-cased letters and the
spaces between them, hashed to ``2 ** bits`` columns and weighted
``(1 + ln tf) * idf``, scaled to length one.

``fit``: the document frequencies behind idf and the class counts come from all
labelled rows, in one Spark aggregation.  The weights are trained on a bounded
sample, at most about ``per_class`` rows of each class taken by the hash of the
doc_id: one task runs follow-the-regularised-leader (FTRL-proximal) updates
with an elastic-net penalty, whose L1 part keeps most weights at zero.  A fifth
of the sample is left out of training and fits the calibration temperature.

``predict``: a narrow pass over all rows; the model (a matrix of
``2 ** bits`` x classes, well under 1 MB) travels with the tasks.

A text that is null or has no letter gets ``und`` with score 0.  With no
labelled row at all, every row is ``und``; with one class, that class.  Further
columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .common import in_batches

UNKNOWN = "und"


@dataclass
class Model:
    """Classes, idf, weights (features x classes), intercepts, temperature."""

    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    orders: int = 3
    info: dict = field(default_factory=dict)


def grams(text: str | None, bits: int, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram columns of a text and their counts; nothing for a text without a letter."""
    size = 1 << bits
    counts = np.zeros(size, np.int64)
    seen = False
    for at in range(0, len(text or ""), 1 << 20):  # bounded memory for any length; a cut loses no letter
        part = text[at:at + (1 << 20)].lower()
        spaced = "".join(c if c.isalpha() else " " for c in part) if not part.isalpha() else part
        joined = " ".join(spaced.split())
        if not joined:
            continue
        seen = True
        code = np.frombuffer(f" {joined} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
        value = np.zeros(len(code), np.uint64)
        for n in range(orders):
            if len(code) <= n:
                break
            value = value[:len(code) - n] * np.uint64(0x100000001B3) + code[n:] + np.uint64(n + 1)
            spread = value * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((spread >> np.uint64(64 - bits)).astype(np.int64), minlength=size)
    if not seen:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(counts)
    return at, counts[at]


def tfidf(columns: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[columns]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list, size: int, classes: int, alpha: float, beta: float, l1: float, l2: float,
         epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over ``(columns, values, class)`` rows; column ``size`` is the unpenalised intercept."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(at):
        zs = z[at]
        soft = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        soft[-1] = zs[-1]
        penalty = (beta + np.sqrt(n[at])) / alpha + l2
        penalty[-1] -= l2
        return -soft / penalty

    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            columns, values, label = rows[i]
            at, x = np.append(columns, size), np.append(values, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], w[size]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature (0.25 to 10) with the least held-back log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0
    rows = np.arange(len(labels))

    def loss(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[rows, labels], 1e-300)).mean()

    lo, hi, g = np.log(0.25), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _document_frequencies(texts: DataFrame, bits: int, orders: int) -> DataFrame:
    """``(column, n)``: documents that hold the column; column -1 counts the documents."""

    def run(batches):
        import pyarrow as pa

        df, total = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[grams(text, bits, orders)[0]] += 1
                total += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()),
                                          pa.array([total, *df[at].tolist()], pa.int64())], ["column", "n"])

    return (texts.select("text").transform(in_batches, run, "column int, n long").groupBy("column").agg(F.sum("n").alias("n")))


def _sample(rows: DataFrame, sizes: dict[str, int], per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each class, by the hash of doc_id; the hash threshold keeps what
    is sorted per class near that bound, whatever the size of the class."""
    place = F.xxhash64("doc_id", F.lit(7)).bitwiseAND((1 << 30) - 1)
    share = F.lit(0).cast("double")
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, 1.2 * per_class / max(n, 1))).otherwise(share)
    near = rows.withColumn("place", place).where(F.col("place") < share * (1 << 30))
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_class)


def fit(rows: DataFrame, bits: int = 14, orders: int = 3, per_class: int = 1000, alpha: float = 0.5,
        beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 2) -> Model:
    """Train on ``rows(doc_id, text, lang)`` with non-null lang; other columns are not looked at."""
    rows = rows.where("lang is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                                                 F.col("lang").cast("string"))
    size = 1 << bits
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    classes = sorted(sizes)
    df = np.zeros(size)
    documents = 0
    for column, n in _document_frequencies(rows, bits, orders).collect():  # at most 2 ** bits rows
        if column < 0:
            documents = n
        else:
            df[column] = n
    idf = np.log((1 + documents) / (1 + df)) + 1
    if len(classes) < 2:
        return Model(classes, idf, np.zeros((size, len(classes))), np.zeros(len(classes)), orders=orders)

    def train(batches):
        import pyarrow as pa

        data = []
        for batch in batches:
            for text, lang, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                columns, counts = grams(text, bits, orders)
                if len(columns):
                    data.append((place, columns, tfidf(columns, counts, idf), classes.index(lang)))
        data.sort(key=lambda r: (r[0], r[3], len(r[1])))
        kept = [r[1:] for i, r in enumerate(data) if i % 5]
        back = [r[1:] for i, r in enumerate(data) if not i % 5]
        w, bias = ftrl(kept, size, len(classes), alpha, beta, l1, l2, epochs)
        logits = np.array([x @ w[at] + bias for at, x, _ in back]).reshape(-1, len(classes))
        labels = np.array([c for _, _, c in back], np.int64)
        right = float((logits.argmax(axis=1) == labels).mean()) if len(back) else 1.0
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.astype("<f8").tobytes()], pa.binary()), pa.array([bias.astype("<f8").tobytes()], pa.binary()),
             pa.array([calibrate(logits, labels)]), pa.array([right])], ["w", "bias", "temperature", "accuracy"])

    sample = _sample(rows, sizes, per_class).select("text", "lang", "place")
    found = sample.repartition(1).transform(in_batches, train, "w binary, bias binary, temperature double, accuracy double").first()
    weights = np.frombuffer(found["w"], "<f8").reshape(size, len(classes))
    return Model(classes, idf, weights, np.frombuffer(found["bias"], "<f8"), found["temperature"], orders,
                 {"accuracy": found["accuracy"], "nonzero": float((weights != 0).mean())})


def classify(text: str | None, model: Model) -> tuple[str, float]:
    columns, counts = grams(text, int(np.log2(len(model.idf))), model.orders)
    if not len(columns) or not model.classes:
        return UNKNOWN, 0.0
    logits = tfidf(columns, counts, model.idf) @ model.weights[columns] + model.bias
    p = softmax(logits / model.temperature)
    best = int(p.argmax())
    return model.classes[best], float(min(1.0, p[best]))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = (), keep_text: bool = False,
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, *keep, [text,] lang_pred, score)``, one row per row."""
    rows = docs.select("doc_id", *keep, F.col("text").cast("string").alias("text"))
    kept = rows.schema if keep_text else rows.drop("text").schema
    schema = StructType([*kept.fields]).add(out[0], StringType()).add(out[1], DoubleType())

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [classify(t, model) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array([lang for lang, _ in found], pa.string()),
                 pa.array([score for _, score in found], pa.float64())], schema.names)

    return rows.transform(in_batches, run, schema)
