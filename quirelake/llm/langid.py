"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the n-grams of 1 to 3 characters of the lower-cased whole text (everything but letters counts as one
blank), hashed into a fixed number of cells, weighted by sqrt(count) and the inverse document frequency over all training
documents, and scaled to length 1. Weights are learned per coordinate by follow-the-regularised-leader with an L1 and an
L2 penalty, so most are exactly zero. A part of the sample is kept from learning and sets one temperature, by which the
logits are divided so that scores are calibrated.

The classifier is fitted on a bounded sample of the labelled documents: of each language the `per_language` different
texts with the smallest hash, and of all languages no more than `MOST_ROWS` (but one of each). Document frequencies and the
letters in use come from all training documents. Every fifth sampled text of a language calibrates, the others are learned.

How much of a text the model knows is the share of its n-grams that hold only letters of the training documents and fall
into a cell that one of them has. It does not depend on how many languages there are: a text in an unknown script is known
to a share of nearly 0 and is rejected by `filter_documents`, whatever the scores say.

A null text, or one without a letter, is `und` with score 0; so is every text if there is nothing to learn from. Of equal
scores the language that comes first in order is predicted. Texts are read in whole; a long one takes some 50 bytes per
character for a moment. Rows are judged one by one by their text alone, so repeated rows get equal results. A null id is
never held out. An empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quirelake.llm.common import slices, small_batches, unique_name
from quirelake.llm.pretoken import LETTER, _classes

CELLS = 1 << 15
ORDERS = (1, 2, 3)
#: Bound of the sample the classifier is fitted on: rows of each language.
PER_LANGUAGE = 1000
#: Bound of the whole sample, which one task learns from.
MOST_ROWS = 20_000
#: Salts that share the choice of a language's smallest hashes.
SALTS = 64
#: Code points, of which the model keeps those of its letters.
POINTS = 0x110000
#: The share of its n-grams that a document must have in common with the training documents.
LEAST_KNOWN = 0.5
UNKNOWN = "und"


@dataclass(frozen=True)
class Penalties:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3


def _points(text: str | None) -> np.ndarray | None:
    """The text's letters as code points, every run of others as one blank, and a blank around it all; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    letter = _classes()[points] == LETTER
    if not letter.any():
        return None
    points = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1]
    return np.concatenate([[np.uint64(32)], points[keep], [np.uint64(32)]])


def _grams(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order, the cells of the n-grams in text order."""
    gram = np.zeros(len(points), dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        gram = gram[: len(points) - order + 1] * np.uint64(POINTS) + points[order - 1 :]
        if order in ORDERS and len(gram):
            mixed = (gram + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            yield order, (mixed >> np.uint64(49)).astype(np.int64)


def _counted(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(CELLS, dtype=np.int64)
    for _, found in _grams(points):
        counts += np.bincount(found, minlength=CELLS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def cells(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """The cells a text's n-grams fall into, and how often; None without a letter."""
    points = _points(text)
    return None if points is None else _counted(points)


def weigh(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = np.sqrt(counts) * idf[found]
    return value / np.sqrt((value * value).sum())


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=0))
    return p / p.sum(axis=0)


class Ftrl:
    """Follow-the-regularised-leader, proximal, with a rate per coordinate and elastic-net penalties."""

    def __init__(self, classes: int, size: int, how: Penalties):
        self.z, self.n, self.how = np.zeros((classes, size)), np.zeros((classes, size)), how

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, how = self.z[:, at], self.n[:, at], self.how
        free = np.abs(z) > how.l1
        return np.where(free, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2), 0.0)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = _softmax(w @ value)
        p[label] -= 1
        g = p[:, None] * value
        n = self.n[:, at]
        grown = n + g * g
        self.z[:, at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.how.alpha * w
        self.n[:, at] = grown


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits.T / np.exp(log_t))
        return -np.log(np.maximum(p[labels, np.arange(len(labels))], 1e-12)).mean()

    lo, hi, ratio = np.log(0.01), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass(frozen=True)
class Model:
    """Bounded by the number of cells, code points and languages."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    seen: np.ndarray
    letters: np.ndarray

    def known(self, points: np.ndarray) -> float:
        """The share of n-grams of known letters in cells of the training documents."""
        strange = np.concatenate([[0], np.cumsum(~self.letters[points.astype(np.int64)])])
        right = total = 0
        for order, found in _grams(points):
            right += int((self.seen[found] & (strange[order:] == strange[:-order])).sum())
            total += len(found)
        return right / total

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """The language, its probability, and how much of the text is known."""
        points = _points(text)
        if points is None or not self.languages:
            return UNKNOWN, 0.0, 0.0
        found, counts = _counted(points)
        p = _softmax(self.weights[:, found] @ weigh(found, counts, self.idf) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), self.known(points)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Documents with a letter, in how many of them each cell occurs, and which code points are letters of some document,
    over the whole frame's one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS + 1, dtype=np.int64)
        letters = np.zeros(POINTS, dtype=bool)
        for batch in slices(batches):
            for text in batch.column(0):
                points = _points(text.as_py())
                if points is not None:
                    total[_counted(points)[0]] += 1
                    total[CELLS] += 1
                    letters[points.astype(np.int64)] = True
        at, used = np.flatnonzero(total), np.flatnonzero(letters) + CELLS + 1
        n = np.concatenate([total[at], np.ones(len(used), dtype=np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, used]), pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    counts = np.zeros(CELLS + 1 + POINTS, dtype=np.int64)
    # One row per cell and letter reaches the driver, whatever the corpus holds.
    for row in texts.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    return int(counts[CELLS]), counts[:CELLS], counts[CELLS + 1 :] > 0


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """Of each language the different texts with the smallest hashes: label, text, order.

    Copies are one before anything is ranked, and the ranks of a language are shared by `SALTS` tasks first.
    """
    hashed = labelled.withColumn("order", F.xxhash64("text"))
    keys = hashed.select("label", "order").distinct()

    def smallest(rows: DataFrame, *keys_: str | Column) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys_).orderBy("order"))
        return rows.withColumn("__r", rank).filter(F.col("__r") <= per_language).drop("__r")

    ends = smallest(smallest(keys, "label", F.pmod("order", F.lit(SALTS))), "label")
    # A row per language.
    ends = F.broadcast(ends.groupBy("label").agg(F.max("order").alias("__end")))
    return hashed.join(ends, "label").filter(F.col("order") <= F.col("__end")).drop("__end").dropDuplicates(["label", "order"])


def _parted(labels: list) -> np.ndarray:
    """Which of the rows calibrate: every fifth of each label."""
    so_far: dict = {}
    out = np.zeros(len(labels), dtype=bool)
    for i, label in enumerate(labels):
        so_far[label] = so_far.get(label, 0) + 1
        out[i] = so_far[label] % 5 == 0
    return out


def _fit(sample: DataFrame, idf: np.ndarray, how: Penalties) -> DataFrame:
    """Learn in one task from the bounded sample; a row per language with the weights that aren't zero."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            label, text, order = (batch.column(batch.schema.names.index(c)) for c in ("label", "text", "order"))
            out = {"label": [], "order": [], "at": [], "value": []}
            for i in range(batch.num_rows):
                found = cells(text[i].as_py())
                if found is not None:
                    for k, v in zip(out, (label[i].as_py(), order[i].as_py(), found[0], weigh(*found, idf)), strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["label"], pa.string()), pa.array(out["order"], pa.int64()), pa.array(out["at"], pa.list_(pa.int32())), pa.array(out["value"], pa.list_(pa.float64()))],
                list(out),
            )

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for part in frames for r in part.itertuples(index=False)]
        if not rows:
            return
        rows.sort(key=lambda r: (r.order, r.label))
        languages = sorted({r.label for r in rows})
        number = {x: i for i, x in enumerate(languages)}
        rows = [(np.asarray(r.at), np.asarray(r.value), number[r.label]) for r in rows]
        apart = _parted([label for *_, label in rows])
        calibration, learning = ([r for r, c in zip(rows, apart, strict=True) if c == part] for part in (True, False))
        model = Ftrl(len(languages), CELLS, how)
        for _ in range(how.epochs):
            for at, value, label in learning:
                model.learn(at, value, label)
        weights = model.weights()
        logits = np.array([weights[:, at] @ value for at, value, _ in calibration]).reshape(len(calibration), len(languages))
        warmth = temperature(logits, np.array([label for *_, label in calibration], dtype=int))
        found = [np.flatnonzero(w) for w in weights]
        yield pd.DataFrame({
            "label": languages, "at": [f.astype("int32") for f in found],
            "weight": [w[f] for w, f in zip(weights, found, strict=True)], "temperature": [warmth] * len(languages),
        })

    rows = sample.mapInArrow(features, "label string, order bigint, at array<int>, value array<double>")
    return rows.repartition(1).mapInPandas(learn, "label string, at array<int>, weight array<double>, temperature double")


def fit(
    docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE, how: Penalties = Penalties(),
) -> Model:
    """Learn from the documents that are not held out and have a label."""
    small_batches(docs.sparkSession)
    training = docs.filter(~held_out(doc_id) & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label")
    )
    n, counts, letters = document_frequencies(training.select("text"))
    idf = np.log((1 + n) / (1 + counts)) + 1
    languages = training.select("label").distinct().count()
    rows = _fit(_sample(training, max(1, min(per_language, MOST_ROWS // max(languages, 1)))), idf, how).collect()
    weights = np.zeros((len(rows), CELLS))
    for i, row in enumerate(rows):
        weights[i, np.asarray(row["at"], dtype=int)] = row["weight"]
    return Model(tuple(r["label"] for r in rows), idf, weights, rows[0]["temperature"] if rows else 1.0, counts > 0, letters)


def predictor(docs: DataFrame, model: Model):
    """A Column function: text -> struct of lang_pred, score and known."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("known", DoubleType())])

    @F.pandas_udf(schema)
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(t) for t in texts], columns=["lang_pred", "score", "known"])

    return judge


def predict(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    small_batches(docs.sparkSession)
    judged = docs.select(F.col(doc_id).alias("doc_id"), predictor(docs, model)(F.col(text)).alias("__judged"))
    return judged.select("doc_id", held_out("doc_id").alias("held_out"), "__judged.lang_pred", "__judged.score")


def filter_documents(docs: DataFrame, model: Model, least_known: float = LEAST_KNOWN, text: str = "text") -> DataFrame:
    """The documents in a language, of whose n-grams the model knows at least such a share, with the columns they came with."""
    small_batches(docs.sparkSession)
    judged = unique_name(docs.columns, "__judged")
    sure = (F.col(judged)["lang_pred"] != UNKNOWN) & (F.col(judged)["known"] >= least_known)
    return docs.withColumn(judged, predictor(docs, model)(F.col(text))).filter(sure).drop(judged)
