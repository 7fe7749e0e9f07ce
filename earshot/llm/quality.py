"""Text quality by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1 outside the held-out fold;
every document of the corpus is unlabelled text; the class prior is the share
of quality 1 among the labelled rows outside that fold.  The score is linear in
bounded text measures and minimises the non-negative unbiased risk with squared
loss l(z) = (1 - z)**2 / 4:

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

Both expectations are quadratic in the weights, so first and second moments of
the measures, summed by Spark over *all* documents and all trusted positives,
are all that fitting needs: a few thousand numbers, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm import tokens
from earshot.llm.memory import giving_back
from earshot.llm.tables import keep

FOLDS, HELD_OUT = 3, 1
RIDGE = 1e-4
STEPS, RATE = 60, 0.5
GOOD = 0.5
# A measure enters as it is and as min(x / knee, 1) for each knee.
KNEES = (0.03, 0.15)
# Words added before repetition is judged: one repeated word says little in a
# short text.
FEW = 20

_CLASSES = np.zeros(256, dtype=np.int64)
_CLASSES[33:48] = _CLASSES[58:65] = _CLASSES[91:97] = _CLASSES[123:127] = 5  # other signs
_CLASSES[[ord(c) for c in ".,'\"-:;?()"]] = 0  # signs of ordinary prose
_CLASSES[65:91] = 1
_CLASSES[97:123] = 2
_CLASSES[48:58] = 3
_CLASSES[ord("!")] = 4
_CLASSES[ord("|")] = 6
_CLASSES[10] = 7
_CLASSES[0xC0:] = 8
_N_CLASSES = 9

_MEASURES = 10
WIDTH = 2 + _MEASURES * (1 + len(KNEES))


def _measured(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, WIDTH) in [0, 1]: a constant, whether there are no words, and
    the measures."""
    n = len(bounds) - 1
    text = np.repeat(np.arange(n), np.diff(bounds))
    count = np.bincount(text * _N_CLASSES + _CLASSES[data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    found = tokens.words(data, bounds, tokens.NOT_SPACE)
    words = found.counts
    of = np.repeat(np.arange(n), words)
    again = []
    for lag in (1, 2):
        same = (found.hashes[lag:] == found.hashes[:-lag]) & (of[lag:] == of[:-lag])
        again.append(np.bincount(of[lag:][same], minlength=n))
    share = lambda a, b: a / np.maximum(b, 1)
    size = np.diff(bounds)
    letters = count[:, 1] + count[:, 2]
    measures = np.column_stack(
        [
            share(count[:, 1], letters), share(count[:, 4], words), share(count[:, 6], words), share(count[:, 5], words),
            share(again[0], words + FEW), share(again[1], words + FEW), share(count[:, 3], size), share(count[:, 7], words),
            share(count[:, 8], letters + count[:, 8]), share(size, words) / 40,
        ]
    ).clip(0, 1)
    bent = [np.minimum(measures / knee, 1) for knee in KNEES]
    return np.column_stack([np.ones(n), words == 0, measures, *bent]).astype(np.float32)


def _floats(batch_rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(batch_rows, dtype=np.float32).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, batch_rows.shape[1]).cast(pa.list_(pa.float32()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, WIDTH)


def measure(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measures) of every row, whole texts."""
    given = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in tokens.slices(batch.column(1)):
                rows = _measured(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(rows)), _floats(rows)], ["doc_id", "measures"]
                )

    id_type = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(giving_back(run), f"doc_id {id_type}, measures array<float>")


def _moments(measured: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and second moment of the measures: partial sums by task, then
    one sum for each entry of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WIDTH, WIDTH))
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0))
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH * WIDTH)), pa.array(total.ravel())], ["place", "value"])

    sums = measured.select("measures").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(WIDTH * WIDTH)
    table = sums.toArrow()  # WIDTH * WIDTH rows
    total[table.column("place").to_numpy()] = table.column("value").to_numpy()
    total = total.reshape(WIDTH, WIDTH)
    n = int(round(total[0, 0]))  # the first measure is constant 1
    scaled = total / max(n, 1)
    return n, scaled[0], scaled


def _fit(prior: float, positive: tuple, unlabelled: tuple) -> np.ndarray:
    """Weights of least non-negative risk: full steps while the negative part
    is not below zero, else steps that raise it."""
    (_, mean_p, second_p), (_, mean_u, second_u) = positive, unlabelled
    scale = np.linalg.inv(second_u / 2 + RIDGE * np.eye(WIDTH))
    weights, best = np.zeros(WIDTH), (np.inf, np.zeros(WIDTH))
    for _ in range(STEPS):
        away = lambda mean, second: (1 + 2 * weights @ mean + weights @ second @ weights) / 4  # noqa: E731, B023
        negative = away(mean_u, second_u) - prior * away(mean_p, second_p)
        risk = prior * (away(mean_p, second_p) - weights @ mean_p) + max(0.0, negative)
        if risk < best[0]:
            best = (risk, weights)
        fall_negative = (mean_u + second_u @ weights) / 2 - prior * (mean_p + second_p @ weights) / 2
        fall_positive = prior * (second_p @ weights - mean_p) / 2
        step = fall_positive + fall_negative if negative >= 0 else -fall_negative
        weights = weights - RATE * (scale @ (step + RIDGE * weights))
    return best[1]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit_weights(measured: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights of the measures; None without any trusted positive.

    ``labels`` (doc_id, quality): only rows outside the held-out fold are read;
    an id labelled both 0 and 1, or null, is no trusted positive.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    judged = known.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    judged = judged.where(F.col("low") == F.col("high"))
    n_trusted, n_judged = judged.agg(F.count_if(F.col("low") == 1), F.count("*")).first()
    if not n_trusted:
        return None
    positive = _moments(measured.join(judged.where(F.col("low") == 1), "doc_id", "left_semi"))
    return _fit(n_trusted / n_judged, positive, _moments(measured)) if positive[0] else None


def _scores(rows: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    if weights is None:
        return np.ones(len(rows))
    return ((rows.astype(np.float64) @ weights + 1) / 2).clip(0, 1)


def score_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``documents``.

    Without any trusted positive every score is 1.  Empty and null texts are
    scored by the constant terms.  Repeated rows are scored alike; null ids are
    scored, and are not held out; other columns are ignored.
    """
    measured = keep(measure(documents, id_col, text_col), "measures")
    weights = fit_weights(measured, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = _scores(_matrix(batch.column(1)), weights)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    id_type = measured.schema["doc_id"].dataType.simpleString()
    return measured.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def drop_poor(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns kept, whose score is at least ``GOOD``.

    Each row is judged where it is, by its text; no row is moved.
    """
    weights = fit_weights(keep(measure(documents, id_col, text_col), "measures"), labels)
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in tokens.slices(batch.column(place)):
                good = _scores(_measured(data, bounds), weights) >= GOOD
                yield batch.slice(at, len(good)).filter(pa.array(good))

    return documents.mapInArrow(giving_back(run), documents.schema)
