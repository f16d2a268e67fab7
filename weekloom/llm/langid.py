"""Language of texts: blended-spectrum presence kernel, Nyström landmarks, kernel ridge.

Kernel. A text is the set of its byte n-grams (1 to 3 bytes, lower case), each counted once.
Of two texts the kernel is the number of common n-grams over the geometric mean of their
numbers, all among the n-grams that occur in a landmark.

Model. Landmarks are texts of each language; the Nyström map through their kernel matrix
turns texts into vectors, on which one ridge regression a language (against all others, +1
and -1) is solved. Scores are one matrix product for a batch: presence times weights, the
landmarks multiplied into the weights beforehand.

Learning uses a bounded sample of labelled rows, ``per_language`` of each language at most,
drawn by a hash of id and text and cut to that bound in Spark, in every task before rows move;
n-gram sets are made in tasks, and only those of the sample reach the driver.
Prediction covers every row and whole texts, in slices of bounded size.

A NULL text, or one without a letter, is ``und`` with score 0; so is every text if nothing
could be learned. Score is (value + 1) / 2 of the best language, held to 0..1. Equal values
go to the language first in order. Extra columns are ignored, repeated rows judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .text import pieces

PER_LANGUAGE = 400
LANDMARKS = 64
MAX_LANGUAGES = 256
RIDGE = 1e-3
UNKNOWN = "und"
CODES = 256 + (1 << 16) + (1 << 24)
SLICE = 1 << 20
ROWS = 256


def slices(text: bytes) -> Iterator[np.ndarray]:
    """The text's n-gram codes, a slice at a time; slices overlap by two bytes."""
    for i in range(0, max(len(text), 1), SLICE):
        b = np.frombuffer(text[i : i + SLICE + 2], np.uint8).astype(np.int32)
        yield np.concatenate([b, 256 + (b[:-1] << 8 | b[1:]), 65792 + (b[:-2] << 16 | b[1:-1] << 8 | b[2:])])


def presence(text: bytes) -> np.ndarray:
    """Distinct n-gram codes of a text."""
    out = np.zeros(0, np.int32)
    for codes in slices(text):
        out = np.union1d(out, codes)
    return out


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # codes, ascending
    weights: np.ndarray  # gram x language
    bias: np.ndarray

    def table(self) -> np.ndarray:
        """Code to gram number; the last number stands for all others."""
        out = np.full(CODES, len(self.grams), np.int32)
        out[self.grams] = np.arange(len(self.grams))
        return out

    def values(self, texts: list[bytes], table: np.ndarray) -> np.ndarray:
        there = np.zeros((len(texts), len(self.grams) + 1), np.float32)
        for row, text in zip(there, texts):
            for codes in slices(text):
                row[table[codes]] = 1
        there = there[:, :-1]
        size = np.sqrt(np.maximum(there.sum(axis=1), 1))
        return there @ self.weights.astype(np.float32) / size[:, None] + self.bias


def fit(sets: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """``sets``: n-gram codes of each labelled text, in the order in which they are preferred."""
    languages = sorted(set(labels))
    if not languages:
        return None
    y = np.array([languages.index(x) for x in labels])
    chosen = np.concatenate([np.flatnonzero(y == i)[:landmarks] for i in range(len(languages))])
    grams = np.unique(np.concatenate([sets[i] for i in chosen] or [np.zeros(0, np.int32)]))

    def matrix(rows) -> np.ndarray:
        out = np.zeros((len(rows), len(grams)), np.float32)
        for row, i in zip(out, rows):
            at = np.searchsorted(grams, sets[i])
            at = at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == sets[i])] if len(grams) else at[:0]
            row[at] = 1
        return out / np.sqrt(np.maximum(out.sum(axis=1), 1))[:, None]

    marks = matrix(chosen)
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])  # K ** -1/2 on its range
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    phi = np.concatenate([(matrix(range(i, min(i + 512, len(sets)))) @ marks.T) for i in range(0, len(sets), 512)]) @ root
    mean, bias = phi.mean(axis=0), target.mean(axis=0)
    centred = phi - mean
    gram = centred.T @ centred + ridge * len(sets) * np.eye(phi.shape[1])
    solved = np.linalg.solve(gram, centred.T @ (target - bias))
    return Model(languages, grams, marks.T.astype(np.float64) @ (root @ solved), bias - mean @ solved)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(rows: DataFrame, share: Column, per_language: int) -> DataFrame:
    """(text, lang, draw, place): rows whose draw is below ``share``, at most ``per_language`` a language."""
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1 << 30))
    drawn = rows.select("text", "lang", draw.alias("draw")).where(F.col("draw") < share)
    # A bounded rank (up to 1000): Spark cuts each task's rows to it before the exchange.
    place = F.row_number().over(W.partitionBy("lang").orderBy("draw", "text"))
    return drawn.withColumn("place", place).where(F.col("place") <= per_language)


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model | None:
    """Model from (doc_id, text, lang), all rows allowed for learning."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # Shares a little above the bound; the rest is cut off by the order of the hash. Equal rows draw alike.
    share = F.lit(0)
    for lang, n in counts.items():
        wide = min(1.0, (per_language + 4 * per_language**0.5) / n)
        share = F.when(F.col("lang") == lang, int(wide * (1 << 30))).otherwise(share)
    drawn = sample(rows, share, per_language)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = [presence(t.lower().encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("lang", "draw", "place")), pa.array(made, pa.list_(pa.int32()))],
                names=["lang", "draw", "place", "grams"],
            )

    found = drawn.mapInArrow(sets, "lang string, draw bigint, place int, grams array<int>").toPandas()
    found["grams"] = [np.asarray(g, np.int32) for g in found["grams"]]
    found = found.sort_values(["draw", "lang", "place"], kind="stable")
    return fit(list(found["grams"]), list(found["lang"]), landmarks)


def lettered(docs: DataFrame) -> DataFrame:
    """The rows whose text has a letter, unchanged."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = [bool(t) and any(map(str.isalpha, t)) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row with ``lang_pred`` and ``score``; input columns of these names give way."""
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = model.table() if model else None
        for batch in pieces(batches):
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                texts = piece.column("text").to_pylist()
                some = [i for i, t in enumerate(texts) if t and model and any(map(str.isalpha, t))]
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if some:
                    values = model.values([texts[i].lower().encode() for i in some], table)
                    best = values.argmax(axis=1)
                    score[some] = np.clip((values[np.arange(len(some)), best] + 1) / 2, 0, 1)
                    for i, k in zip(some, best.tolist()):
                        lang[i] = model.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in columns), pa.array(lang, pa.string()), pa.array(score)],
                    names=[*columns, "lang_pred", "score"],
                )

    schema = StructType(list(docs.schema.fields)).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(rows, schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); learned from the rows that are not held out."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    out = held_out(F.col("doc_id"))
    model = learn(texts.where(~out & F.col("doc_id").isNotNull()), per_language, landmarks)
    found = predict(texts.select("doc_id", out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
