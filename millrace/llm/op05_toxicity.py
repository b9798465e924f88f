"""Toxicity by multiple-instance learning.

A document is a bag of sentences of which only the document's label is known. A sentence's
score is how much a logistic function of hashed words and character 4-grams exceeds its value for
a sentence without any learned feature; a document's score is the noisy-or of its sentences that
score THRESHOLD or more, 1 - product(1 - p), and without such a sentence that of its worst one.
No weight is negative, so a sentence without evidence scores 0, and many sentences of little
evidence do not add up: length alone never rejects a document. The weights are learned from
document labels alone, by the noisy-or of all sentences, and the same sentence scores then show
where a document offends.

The model is fitted on the driver from a bounded sample of labelled documents, long ones too:
SAMPLE toxic and 2 * SAMPLE others, in the order of a hash of their id, as far as TRAINING_CHARS
characters of each label go (whole toxic texts; of another text what is left, as any part of it
is clean, too).
Every document is scored whole, row by row and without a shuffle; memory holds about
CHUNK_CHARS characters or the longest text.

Cases: a null or empty text, or one without letters and digits, has no sentences and scores 0;
without any label of one kind the model is constant and scores 0; null labels teach nothing;
repeated rows score alike; a null id is never held out (its crc32 is null) and teaches nothing;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    chunks,
    code_points,
    mix,
    pick,
    run_hashes,
    spans_of,
    word_tables,
)

# Fixed values of the contract.
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2

SAMPLE = 1000  # of toxic rows; of others twice as many
TRAINING_CHARS = 32_000_000  # of each label, all texts together
CHUNK_CHARS = 500_000  # a character takes about 70 bytes while its piece is scored
DIMENSION = 1 << 20
GRAM = 4
EPOCHS, RATE, BIAS_RATE, FIRST_BIAS = 200, 0.5, 0.5, -9.0
# A feature is learned if toxic documents hold it more often than chance by so many deviations.
LEAST_Z = 3.0
# A feature gets a weight only if more than about so many documents ask for it (L1).
LEAST_DOCUMENTS = 0.05
# Of the loss, the share of the toxic documents.
TOXIC_SHARE = 0.2
# The odds that a document is called toxic without evidence: bounds its pull on the weights.
NO_EVIDENCE = 0.02
SENTENCE_ENDS = ".!?\n"


class Model(NamedTuple):
    bias: float
    weights: np.ndarray


class Bags(NamedTuple):
    """Features of texts: hashed feature, its sentence; a sentence's text, begin and end."""

    feature: np.ndarray
    sentence: np.ndarray
    owner: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def bags(texts: list[str]) -> Bags:
    points, starts = code_points(texts)
    word, lower = word_tables()
    points = lower[points]
    inside = word[points]
    first, end = spans_of(inside, starts)
    # A sentence ends after an end mark and where its text ends.
    ends = np.isin(points, np.frombuffer(SENTENCE_ENDS.encode("utf-32-le"), "<u4"))
    opens = np.zeros(len(points) + 1, bool)
    opens[1:] = ends
    opens[starts] = True
    number = np.cumsum(opens[:-1], dtype=np.int32) - 1 if len(points) else np.zeros(0, np.int32)
    begins = np.flatnonzero(opens[:-1])
    # What is as long as the texts is small in type, changed in place and given up early.
    del ends, opens
    features = [(run_hashes(points, first, end) % np.uint64(DIMENSION)).astype(np.int32)]
    sentences = [number[first]]
    if len(points) >= GRAM:
        n = len(points) - GRAM + 1
        within = np.ones(n, bool)
        key = np.zeros(n, np.uint64)
        for k in range(GRAM):
            within &= inside[k : n + k]
            key *= np.uint64(0x110000 + 3)
            key += points[k : n + k]
        cut = starts[1:-1]
        for k in range(1, GRAM):
            before = cut - k
            within[before[(before >= 0) & (before < n)]] = False
        key = key[within]
        sentences.append(number[:n][within])
        del within, number
        key += np.uint64(1)
        key = mix(key)
        key %= np.uint64(DIMENSION)
        features.append(key.astype(np.int32))
        del key
    owner = np.searchsorted(starts, begins, side="right") - 1
    stop = np.append(begins[1:], len(points)) if len(begins) else begins
    offset = starts[owner]
    return Bags(np.concatenate(features), np.concatenate(sentences), owner, begins - offset, stop - offset)


def _logistic(z: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def above_floor(evidence: np.ndarray, bias: float) -> np.ndarray:
    """The probability p of sentences with so much evidence (0 or more): 1 - p is by how much it
    lowers 1 - logistic(bias), so that no evidence gives exactly 0."""
    return 0.0 - np.expm1(np.logaddexp(0, bias) - np.logaddexp(0, bias + evidence))


def sentence_scores(b: Bags, model: Model) -> np.ndarray:
    """The probability of each sentence; one without a feature that has a weight has 0."""
    return above_floor(
        np.bincount(b.sentence, model.weights[b.feature], minlength=len(b.owner)), model.bias
    )


def noisy_or(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n))


def document_scores(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The noisy-or of each document's offending sentences, or else its worst sentence's score."""
    worst = np.zeros(n)
    np.maximum.at(worst, owner, p)
    return np.where(worst < THRESHOLD, worst, noisy_or(np.where(p < THRESHOLD, 0, p), owner, n))


class Training(NamedTuple):
    """Of the training texts: telling features (their numbers), where they occur (the feature's
    place among them and its sentence) and the sentences' texts."""

    used: np.ndarray
    feature: np.ndarray
    sentence: np.ndarray
    owner: np.ndarray


def _telling(texts: list[str], y: np.ndarray) -> Training:
    """The features that documents of label 1 hold more often than chance by LEAST_Z deviations.

    Texts are taken apart piece by piece, and again for the few features that are of use: all of
    them would take several times the texts' memory.
    """
    n, n_toxic = len(y), y.sum()
    found, toxic = np.zeros(DIMENSION, np.int64), np.zeros(DIMENSION)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    at = 0
    for part, own in chunks([batch], "text", 500_000):
        b = bags(own)
        pairs = np.unique(b.owner[b.sentence] * DIMENSION + b.feature)
        of = pairs % DIMENSION
        found += np.bincount(of, minlength=DIMENSION)
        toxic += np.bincount(of, y[at + pairs // DIMENSION], minlength=DIMENSION)
        at += part.num_rows
    share = (found + 0.5) / (n + 1)
    used = np.flatnonzero(toxic - n_toxic * share >= LEAST_Z * np.sqrt(n_toxic * share * (1 - share)))
    number = np.full(DIMENSION, -1, np.int32)
    number[used] = np.arange(len(used))
    features, sentences, owners, done, at = [], [], [], 0, 0
    for part, own in chunks([batch], "text", 500_000):
        b = bags(own)
        hit = np.flatnonzero(number[b.feature] >= 0)
        features.append(number[b.feature[hit]])
        sentences.append(b.sentence[hit].astype(np.int64) + done)
        owners.append(b.owner + at)
        done += len(b.owner)
        at += part.num_rows
    return Training(used, *map(np.concatenate, (features, sentences, owners)))


def fit(texts: list[str], labels: list[int]) -> Model:
    """Weights that lower the log loss of the documents' noisy-or.

    Whole gradients with AdaGrad steps; with each step weights shrink towards 0 by the L1
    penalty, so that the many words of few documents keep none. None goes below 0.
    """
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(-40.0, np.zeros(DIMENSION))
    n, n_toxic = len(y), y.sum()
    used, feature, sentence, owner = _telling(texts, y)
    w, bias = np.zeros(len(used)), FIRST_BIAS
    seen, seen_bias = np.full(len(used), 1e-12), 1e-12
    weight = np.where(y > 0, TOXIC_SHARE / n_toxic, (1 - TOXIC_SHARE) / (n - n_toxic))
    penalty = LEAST_DOCUMENTS * TOXIC_SHARE / n_toxic
    for _ in range(EPOCHS):
        evidence = np.bincount(sentence, w[feature], minlength=len(owner))
        doc = np.clip(noisy_or(above_floor(evidence, bias), owner, n), 0, 1 - 1e-9)
        slope = np.where(y > 0, -(1 - doc) / (doc + NO_EVIDENCE), 1.0) * weight
        error = slope[owner] * _logistic(bias + evidence)
        gradient = np.bincount(feature, error[sentence], minlength=len(used))
        seen += gradient**2
        step = RATE / np.sqrt(seen)
        w = np.maximum(0, w - step * (gradient + penalty))
        total = (error - slope[owner] * _logistic(bias)).sum()
        seen_bias += total**2
        bias -= BIAS_RATE * total / np.sqrt(seen_bias)
    weights = np.zeros(DIMENSION)
    weights[used] = w
    return Model(float(bias), weights)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(
        F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False)
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model learned from at most sample toxic and 2 * sample other documents, none of them
    in the held-out fold."""
    rows = pick(labels, "doc_id", "toxic").where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    order = F.xxhash64("doc_id")
    chosen = (
        rows.where("toxic = 1")
        .orderBy(order, "doc_id")
        .limit(sample)
        .unionByName(rows.where("toxic = 0").orderBy(order, "doc_id").limit(2 * sample))
        .withColumnRenamed("doc_id", "_id")
    )
    # At most 3 * sample rows of two numbers are broadcast; the sizes come first, so that what is
    # collected then is bounded.
    rows = (
        pick(docs, "doc_id", "text")
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("doc_id", "text", "toxic", F.length("text").alias("size"))
    )
    by = (order, "doc_id", "size", "toxic")
    sizes = rows.select("doc_id", "size", "toxic").orderBy(*by).limit(3 * sample).collect()
    takes = pieces(sizes)
    if not takes:
        return fit([], [])
    known = (
        rows.join(
            F.broadcast(
                docs.sparkSession.createDataFrame(
                    takes, "_doc bigint, _size int, _toxic int, _take int"
                ).distinct()
            ),
            (F.col("doc_id") == F.col("_doc"))
            & (F.col("size") == F.col("_size"))
            & (F.col("toxic") == F.col("_toxic")),
        )
        .select("doc_id", "size", "toxic", F.expr("substring(text, 1, _take)").alias("text"))
        .orderBy(*by, "text")
        .limit(len(takes))
        .collect()
    )
    return fit([r["text"] for r in known], [r["toxic"] for r in known])


def pieces(rows: list[tuple[int, int, int]], most: int = 0) -> list[tuple[int, int, int, int]]:
    """How much is learned from rows (doc_id, size, toxic), in order, as a last column: most
    characters (TRAINING_CHARS) of each label, of toxic texts all or nothing."""
    left = dict.fromkeys((0, 1), most or TRAINING_CHARS)
    found = []
    for doc_id, size, toxic in rows:
        take = min(size, left[toxic])
        if take == size or take and not toxic:
            found.append((doc_id, size, toxic, take))
            left[toxic] -= take
    return found


RESULT = "score double, n_offending bigint, worst_start bigint, worst_end bigint"


def scored(docs: DataFrame, model: Model, keep: dict[str, str] | None = None) -> DataFrame:
    """The kept columns (name: type; doc_id by default) of each row, its score, how many
    sentences score THRESHOLD or more, and the range of the worst one (null if none)."""
    keep = keep or {"doc_id": "bigint"}
    session = docs.sparkSession
    shared = session.sparkContext.broadcast(Model(model.bias, model.weights.astype(np.float32)))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "_text", CHUNK_CHARS):
            n = len(texts)
            b = bags(texts)
            p = sentence_scores(b, shared.value)
            score = document_scores(p, b.owner, n)
            bad = np.flatnonzero(p >= THRESHOLD)
            count = np.bincount(b.owner[bad], minlength=n)
            worst = np.full(n, -1)
            order = bad[np.lexsort((-b.begin[bad], p[bad]))]
            worst[b.owner[order]] = order  # the last one written is the worst, then the first
            none = worst < 0
            spans = [
                pa.array(x[worst] if len(x) else worst, pa.int64(), mask=none)
                for x in (b.begin, b.end)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(score), pa.array(count, pa.int64()), *spans],
                names=[*names, "score", "n_offending", "worst_start", "worst_end"],
            )

    numbered = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = {c: f"_c{i}" for i, c in reversed(list(enumerate(docs.columns)))}
    rows = numbered.select(*[F.col(at[c]).alias(c) for c in names], F.col(at["text"]).alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in keep.items())
    return rows.mapInArrow(run, f"{schema}, {RESULT}")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that score below threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(
        Model(model.bias, model.weights.astype(np.float32))
    )
    names = [f"_c{i}" for i in range(len(docs.columns))]
    text = f"_c{docs.columns.index('text')}"
    numbered = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, text, CHUNK_CHARS):
            b = bags(texts)
            score = document_scores(sentence_scores(b, shared.value), b.owner, len(texts))
            yield batch.filter(pa.array(score < threshold))

    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)


def offending(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end (code points, end exclusive) and score of every offending sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text", CHUNK_CHARS):
            b = bags(texts)
            p = sentence_scores(b, shared.value)
            bad = np.flatnonzero(p >= threshold)
            ids = batch["doc_id"].take(pa.array(b.owner[bad]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(b.begin[bad]), pa.array(b.end[bad]), pa.array(p[bad])],
                names=["doc_id", "start", "end", "score"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, start bigint, end bigint, score double"
    )


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, and where the document offends."""
    return scored(docs, train(docs, labels, sample)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_offending",
        "worst_start",
        "worst_end",
    )
