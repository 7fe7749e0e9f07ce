"""Three-class sentiment and its reports.

The default scorer counts the distinct listed words of each polarity; the
outcome has the contract of a trained three-class model (probabilities in the
order negative, neutral, positive), not its judgement.  Plug a model in with
``score_with``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from earshot import constants as C
from earshot.functions import text as X
from earshot.operators.embed import batched
from earshot.operators.models import kept

# Fixed value: texts handed to a plugged-in scorer at a time.
SCORER_BATCH = 16

Scorer = Callable[[list[str]], np.ndarray]


def _attach(scored: DataFrame, logits: list[Column]) -> DataFrame:
    """Softmax, arg-max (first of equals) and confidence from three logits."""
    names = ["_" + label for label in C.SENTIMENT_LABELS]
    with_logits = scored.withColumns(dict(zip(names, logits)))
    peak = F.greatest(*names)
    powers = [F.exp(F.col(n) - peak) for n in names]
    total = powers[0] + powers[1] + powers[2]
    chances = [p / total for p in powers]
    label = F.coalesce(*(F.when(F.col(n) == peak, n[1:]) for n in names))
    return (
        with_logits.withColumn("sentiment_label", label)
        .withColumn("sentiment_confidence", F.lit(1.0) / total)
        .withColumn(
            "sentiment_scores",
            F.struct(*(c.alias(l) for c, l in zip(chances, C.SENTIMENT_LABELS))),
        )
        .drop(*names)
    )


def score_sentiment(contacts: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    """Add ``sentiment_label``, ``sentiment_confidence`` and
    ``sentiment_scores`` with the default word-list scorer."""
    lexicon = lambda listed: F.array(*(F.lit(w) for w in listed))
    cue_count = lambda listed: F.size(F.array_intersect("_words", lexicon(listed)))
    logit = lambda n: 2.0 * F.log(n + F.lit(1.0))
    worded = contacts.withColumn("_words", X.words(X.fold_case(F.coalesce(text_col, F.lit("")))))
    return _attach(
        worded,
        [
            logit(cue_count(C.NEGATIVE_WORDS)),
            F.lit(C.NEUTRAL_LOGIT),
            logit(cue_count(C.POSITIVE_WORDS)),
        ],
    ).drop("_words")


def score_with(
    contacts: DataFrame,
    load_scorer: Callable[[], Scorer],
    text_col: str = "cleaned_text",
    batch_size: int = SCORER_BATCH,
    name: str | None = None,
) -> DataFrame:
    """The same columns from a plugged-in model: texts -> (n, 3) logits.

    ``load_scorer`` runs on the executor when the first batch arrives: once for
    each worker process where the model has a ``name``, else for each task."""

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = None
        for batch in batches:
            scorer = scorer or kept(name, load_scorer)
            logits = batched(batch.to_pylist(), batch_size, scorer, 3)
            yield pa.array(list(logits), type=pa.list_(pa.float64()))

    rows = contacts.withColumn("_logits", run(F.coalesce(text_col, F.lit(""))))
    return _attach(rows, [F.col("_logits")[i] for i in range(3)]).drop("_logits")


def score_one(
    spark: SparkSession, text: str, score: Callable[[DataFrame], DataFrame] = score_sentiment
) -> Row:
    """Label, confidence and scores of one text."""
    return score(spark.createDataFrame([(text,)], "cleaned_text string")).first()


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    """(sentiment_label, n, pct): the three labels in fixed order, zeros
    shown; 0.0 % on empty input.  One global aggregate, then three rows."""
    counts = scored.agg(
        F.count("*").alias("_all"),
        *(F.count_if(F.col("sentiment_label") == l).alias(l) for l in C.SENTIMENT_LABELS),
    )
    rows = F.array(
        *(
            F.struct(F.lit(i).alias("ordinal"), F.lit(l).alias("sentiment_label"), F.col(l).alias("n"))
            for i, l in enumerate(C.SENTIMENT_LABELS)
        )
    )
    pct = F.coalesce(F.try_divide(100.0 * F.col("n"), F.col("_all")), F.lit(0.0))
    return counts.select("_all", F.inline(rows)).select(
        "ordinal", "sentiment_label", "n", pct.alias("pct")
    )


def sentiment_by(scored: DataFrame, key: str) -> DataFrame:
    """(key, negative, neutral, positive, total), largest total first."""
    counts = [F.count_if(F.col("sentiment_label") == l).alias(l) for l in C.SENTIMENT_LABELS]
    total = sum((F.col(l) for l in C.SENTIMENT_LABELS[1:]), F.col(C.SENTIMENT_LABELS[0]))
    return (
        scored.groupBy(key)
        .agg(*counts)
        .withColumn("total", total)
        .orderBy(F.desc("total"), key)
    )


def top_negative(
    scored: DataFrame, n: int = 3, id_col: str = "contact_id", text_col: str = "cleaned_text"
) -> DataFrame:
    """The n negative contacts scored most confidently, with a preview.

    A running top n per task, then n rows: nothing is sorted as a whole.
    Negatives are put first rather than filtered first: a filter would be
    pushed below the scoring and score every text twice.
    """
    negative = F.col("sentiment_label") == "negative"
    text = F.col(text_col)
    preview = F.concat(F.substring(text, 1, 110), F.when(F.length(text) > 110, "...").otherwise(""))
    return (
        scored.orderBy(F.desc(negative), F.desc("sentiment_confidence"), id_col)
        .limit(n)
        .where(negative)
        .select(id_col, "intent", "channel", "sentiment_confidence", preview.alias("preview"))
    )
