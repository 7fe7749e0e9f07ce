"""Unsupervised topics: fitting, describing, comparing with intents.

Fitting splits the embeddings into as many clusters as the data show
(``splitting``), or into a given number with Spark's k-means.  It keeps the
contract of density clustering (dense topics, small groups as outliers, optional
merge to a wished number), not its clusters.  Everything after fitting takes any
table with a ``topic`` column.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot import constants as C
from earshot.functions import text as X
from earshot.operators.embed import embed_hashing
from earshot.operators.hold import hold, small_side
from earshot.operators.similar import RANK_DECIMALS
from earshot.operators.splitting import cluster_of, find_centres

OTHER_INTENT = "OTHER"
# Rows less like their centre (cosine) than this belong to no topic.
MIN_SIMILARITY = 0.1


def merge_topics(
    centres: np.ndarray, sizes: np.ndarray, min_topic_size: int, nr_topics: int | None
) -> list[int]:
    """Topic of each cluster: small clusters are outliers, the most similar
    pair merges until ``nr_topics`` are left, ids go by size.  Works on the
    centres, never on rows."""
    groups = {i: [i] for i in range(len(sizes)) if sizes[i] >= min_topic_size}
    weight = {i: float(sizes[i]) for i in groups}
    centre = {i: centres[i].astype(float) for i in groups}
    while nr_topics is not None and len(groups) > max(1, nr_topics):
        names = sorted(groups)
        unit = np.stack([centre[i] / (np.linalg.norm(centre[i]) or 1.0) for i in names])
        alike = np.triu(unit @ unit.T + 2.0, 1)
        a, b = (names[i] for i in np.unravel_index(alike.argmax(), alike.shape))
        both = weight[a] + weight[b]
        centre[a] = (centre[a] * weight[a] + centre[b] * weight[b]) / both
        weight[a] = both
        groups[a] += groups.pop(b)
    topic = [C.OUTLIER_TOPIC] * len(sizes)
    for number, name in enumerate(sorted(groups, key=lambda i: (-weight[i], i))):
        for cluster in groups[name]:
            topic[cluster] = number
    return topic


def fit_topics(
    contacts: DataFrame,
    min_topic_size: int = 5,
    nr_topics: int | None = None,
    vector_col: str = "embedding",
    max_topics: int | None = None,
    seed: int = 42,
    min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """Add ``topic``: 0 is the largest, -1 an outlier.

    Without ``max_topics`` the number of clusters follows the data.  With it, as
    many are fitted, but no more than could have ``min_topic_size`` rows each.
    In either case the most similar ones merge down to ``nr_topics``.  A row is an outlier when its cosine with its
    cluster's centre is below ``min_similarity``, whatever the size of the
    table, or when fewer than ``min_topic_size`` rows are left in its cluster.

    The rows are read several times, so they are held; pass only the columns
    needed afterwards.
    """
    if max_topics is not None and max_topics < 1:
        raise ValueError("max_topics must be at least 1")
    contacts = hold(contacts)
    rows = contacts.count()
    if rows == 0:
        raise ValueError("fit_topics() needs at least one contact")
    if max_topics is None:
        centres = find_centres(contacts, vector_col, seed)
    else:
        wanted = min(max_topics, max(1, rows // max(1, min_topic_size)))
        vectors = contacts.select(array_to_vector(vector_col).alias("_features"))
        # The row solver copes with fewer distinct vectors than clusters.
        model = KMeans(k=max(2, wanted), seed=seed, solver="row", featuresCol="_features")
        centres = np.stack(model.fit(vectors).clusterCenters())
    table = [(i, [float(x) for x in c], float(np.linalg.norm(c))) for i, c in enumerate(centres)]
    known = contacts.sparkSession.createDataFrame(table, "_cluster int, _centre array<double>, _length double")
    near = _cosine(vector_col) >= min_similarity
    placed = contacts.withColumn("_cluster", cluster_of(vector_col, centres))
    assigned = hold(placed.join(small_side(known), "_cluster").withColumn("_near", near).drop("_centre", "_length"))
    counted = assigned.where("_near").groupBy("_cluster").count().collect()  # a row for each cluster
    sizes = np.zeros(len(centres), dtype=np.int64)
    for row in counted:
        sizes[row["_cluster"]] = row["count"]
    topic = merge_topics(centres, sizes, min_topic_size, nr_topics)
    of_cluster = F.element_at(F.lit(topic), F.col("_cluster") + 1)
    named = F.when(F.col("_near"), of_cluster).otherwise(C.OUTLIER_TOPIC)
    return assigned.withColumn("topic", named).select(*contacts.columns, "topic")


def _cosine(vector_col: str) -> Column:
    """With ``_centre``, whose length is ``_length``; 0 where either is zero."""
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, c: x.cast("double") * c), F.lit(0.0), lambda t, x: t + x
    )
    own = F.sqrt(dot(vector_col, vector_col))
    return F.coalesce(F.try_divide(dot(vector_col, "_centre"), own * F.col("_length")), F.lit(0.0))


def term_counts(contacts: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    """(topic, term, tf) for lower-case words of two or more characters."""
    terms = X.words(F.lower(F.coalesce(text_col, F.lit(""))))
    return (
        contacts.select("topic", F.explode(terms).alias("term"))
        .where(F.length("term") >= 2)
        .groupBy("topic", "term")
        .agg(F.count("*").alias("tf"))
    )


def top_words(
    contacts: DataFrame, n_words: int = 5, text_col: str = "cleaned_text"
) -> DataFrame:
    """(topic, rank, term, weight): the n most telling terms per topic.

    Class-based TF-IDF (arXiv:2203.05794): ``tf * ln(1 + A / f)`` with f the
    term's total and A the mean number of terms per topic.  Outliers count
    towards f and A but are not listed.

    Counting shrinks the text to one row per topic and term before the first
    shuffle, and the mean reuses that shuffle.  The window over a term holds
    one row per topic; it also keeps the outlier filter from being pushed into
    the counts, which would then be made twice.
    """
    counts = term_counts(contacts, text_col)
    totals = counts.groupBy("topic").agg(F.sum("tf").alias("terms"))
    mean_terms = totals.agg(F.avg("terms")).scalar()
    overall = F.sum("tf").over(Window.partitionBy("term"))
    weight = F.round(F.col("tf") * F.log(1 + mean_terms / F.col("f")), RANK_DECIMALS)
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return (
        counts.withColumn("f", overall)
        .where(F.col("topic") != C.OUTLIER_TOPIC)
        .select("topic", "term", weight.alias("weight"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n_words)
        .select("topic", "rank", "term", "weight")
    )


def representatives(
    contacts: DataFrame,
    n: int = 3,
    id_col: str = "contact_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(topic, rank, id, similarity): the n rows nearest to a topic's mean."""
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    centres = (
        contacts.groupBy("topic")
        .agg(Summarizer.mean(array_to_vector(vector_col)).alias("_mean"))
        .select("topic", vector_to_array("_mean").alias("_centre"))
        .withColumn("_length", length("_centre"))
    )
    dot = F.aggregate(
        F.zip_with(vector_col, "_centre", lambda x, c: x.cast("double") * c),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    similarity = F.round(F.coalesce(F.try_divide(dot, F.col("_length")), F.lit(0.0)), RANK_DECIMALS)
    nearest = Window.partitionBy("topic").orderBy(F.desc("similarity"), id_col)
    return (
        contacts.select("topic", id_col, vector_col)
        .join(small_side(centres), "topic")
        .select("topic", id_col, similarity.alias("similarity"))
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= n)
        .select("topic", "rank", id_col, "similarity")
    )


def topic_info(
    contacts: DataFrame,
    n_words: int = 5,
    n_docs: int = 3,
    id_col: str = "contact_id",
    text_col: str = "cleaned_text",
    vector_col: str = "embedding",
) -> DataFrame:
    """(topic, n, name, words, representative_ids), largest topic first and
    outliers last."""
    # Read three times, and texts and vectors may be costly to make.
    contacts = hold(contacts.select(*dict.fromkeys(["topic", id_col, text_col, vector_col])))
    in_order = lambda value: F.transform(
        F.sort_array(F.collect_list(F.struct("rank", F.col(value).alias("v")))), lambda r: r["v"]
    )
    words = top_words(contacts, n_words, text_col).groupBy("topic").agg(in_order("term").alias("words"))
    docs = representatives(contacts, n_docs, id_col, vector_col)
    docs = docs.groupBy("topic").agg(in_order(id_col).alias("representative_ids"))
    outlier = F.col("topic") == C.OUTLIER_TOPIC
    known = F.coalesce("words", F.array().cast("array<string>"))
    label = F.when(outlier, "outliers").otherwise(F.array_join(F.slice(known, 1, 4), "_"))
    return (
        contacts.groupBy("topic")
        .agg(F.count("*").alias("n"))
        .join(words, "topic", "left")
        .join(docs, "topic", "left")
        .select(
            "topic",
            "n",
            F.concat(F.col("topic").cast("string"), F.lit("_"), label).alias("name"),
            known.alias("words"),
            "representative_ids",
        )
        .orderBy(outlier, F.desc("n"), "topic")
    )


def assignments(contacts: DataFrame, id_col: str = "contact_id") -> DataFrame:
    return contacts.select(id_col, "topic")


def _intent(intent_col: str):
    return F.coalesce(intent_col, F.lit(C.UNKNOWN_INTENT)).alias("intent")


def crosstab(contacts: DataFrame, intent_col: str = "intent") -> DataFrame:
    """(topic, intent, n); a missing intent counts as UNKNOWN."""
    return contacts.groupBy("topic", _intent(intent_col)).agg(F.count("*").alias("n"))


def crosstab_dense(
    contacts: DataFrame, intents: list[str] | None = None, intent_col: str = "intent"
) -> DataFrame:
    """One row per topic, one column per intent (alphabetical), zeros filled;
    outliers last.

    With ``intents`` given there is no pass to find them; missing intents are
    then counted as UNKNOWN and all that are not listed as OTHER, so every row
    counts somewhere.
    """
    outlier = F.col("topic") == C.OUTLIER_TOPIC
    counts, columns = crosstab(contacts, intent_col), None
    if intents is not None:
        columns = [*sorted({*intents} - {C.UNKNOWN_INTENT, OTHER_INTENT}), C.UNKNOWN_INTENT, OTHER_INTENT]
        listed = F.when(F.col("intent").isin(columns), F.col("intent")).otherwise(OTHER_INTENT)
        counts = counts.withColumn("intent", listed)
    return (
        counts.groupBy("topic")
        .pivot("intent", columns)
        .agg(F.sum("n"))
        .na.fill(0)
        .orderBy(outlier, "topic")
    )


def alignment(contacts: DataFrame, intent_col: str = "intent") -> DataFrame:
    """(aligned_topics, total_topics, verdict): a topic is aligned if one
    intent has at least 70 % of it."""
    per_topic = (
        crosstab(contacts, intent_col)
        .where(F.col("topic") != C.OUTLIER_TOPIC)
        .groupBy("topic")
        .agg((F.max("n") / F.sum("n") >= C.ALIGNED_SHARE).alias("aligned"))
    )
    aligned, total = F.col("aligned_topics"), F.col("total_topics")
    verdict = (
        F.when(total == 0, "none")
        .when(aligned == total, "strong")
        .when(aligned >= F.floor(total / 2), "partial")
        .otherwise("weak")
    )
    return per_topic.agg(
        F.count_if("aligned").alias("aligned_topics"), F.count("*").alias("total_topics")
    ).withColumn("verdict", verdict)


class TopicModeller:
    """Fit on cleaned contacts, then ask for the descriptions.

    ``embed`` maps a DataFrame with ``cleaned_text`` to one with ``embedding``.
    """

    def __init__(
        self,
        min_topic_size: int = 5,
        nr_topics: int | None = None,
        embed: Callable[[DataFrame], DataFrame] = embed_hashing,
        id_col: str = "contact_id",
        max_topics: int | None = None,
    ):
        self.min_topic_size, self.nr_topics, self.max_topics = min_topic_size, nr_topics, max_topics
        self.embed, self.id_col = embed, id_col
        self._fitted: DataFrame | None = None

    def fit(self, contacts: DataFrame) -> TopicModeller:
        rows = self.embed(contacts.select(self.id_col, "intent", "cleaned_text"))
        self._fitted = fit_topics(rows, self.min_topic_size, self.nr_topics, max_topics=self.max_topics)
        return self

    @property
    def fitted(self) -> DataFrame:
        if self._fitted is None:
            raise RuntimeError("fit() has not been called")
        return self._fitted

    def topic_info(self, n_words: int = 5) -> DataFrame:
        return topic_info(self.fitted, n_words, id_col=self.id_col)

    def top_words_per_topic(self, n_words: int = 5) -> DataFrame:
        return top_words(self.fitted, n_words)

    def assignments(self) -> DataFrame:
        return assignments(self.fitted, self.id_col)

    def cross_tab_against_intents(self) -> DataFrame:
        return crosstab(self.fitted)
