"""

Contacts are derived from ``documents`` (``checks.demo_contacts``), every row
and whole texts.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.demo_contacts import contacts_from_documents, with_demo_time
from checks.oracle import statements
from earshot import constants as C
from earshot.functions import channels
from earshot.operators import classify, clean, embed, evaluate, journeys, knn, linkage, lists, sentiment, similar, spikes, topics
from earshot.operators.hold import shared_folder
from earshot.operators.linkage import Field
from earshot.session import prepare_session
from earshot.sources.contacts import CLEANED_CONTACT, read_contacts, write_contacts

try:  # The subpackage for training data may be removed, corpus_pipeline.py with it.
    from earshot.llm import oracle as llm_oracle
    from earshot.llm import queries as llm_queries
except ImportError as error:
    if error.name not in ("earshot.llm", "corpus_pipeline"):
        raise
    llm_oracle = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# Seconds without an event that end a session; seconds within which a contact
# counts as repeated, or a visit as not deflected.
SESSION_GAP, CONTACT_WINDOW = 6 * 3600, 2 * 86_400

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def read_demo_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """A file of one row group is one task, however many cores wait: with fewer
    splits than cores, the caller deals the rows out.  The library never does."""
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    cores = spark.sparkContext.defaultParallelism
    few = documents.rdd.getNumPartitions() < cores
    return contacts_from_documents(documents.repartition(cores) if few else documents)


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.preprocess(read_demo_contacts(spark, sf))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify.classify_with_confidence(_cleaned(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.score_sentiment(_cleaned(spark, sf))


def _given_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def _given_topics(spark: SparkSession, sf: str) -> DataFrame:
    """All contacts, with a topic from -1 to 8 and the default vector; every
    seventh has no intent."""
    known = F.when(F.col("contact_id") % 7 != 3, F.col("intent"))
    topic = (F.col("contact_id") % 10 - 1).cast("int")
    return embed.embed_hashing(_cleaned(spark, sf).withColumns({"intent": known, "topic": topic}))


def _rounded(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({c: F.round(c, 6) for c in columns})


def _cleaner(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        contacts = read_demo_contacts(spark, sf)
        return contacts.select("contact_id", channels.CLEANERS[name]("text").alias("cleaned_text"))

    return run


def clean_chat_turns(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return turns.select("conv_id", "turn", channels.clean_chat("text").alias("cleaned_text"))


def preprocess_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)


def _scores(table: DataFrame) -> DataFrame:
    return table.select("contact_id", *(F.col(i).alias(i.lower()) for i in C.INTENTS))


def score_intents(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(classify.score_intents(_cleaned(spark, sf)))


def score_intents_raw(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(classify.score_intents(read_demo_contacts(spark, sf), text_col="text"))


def classify_min_score(spark: SparkSession, sf: str) -> DataFrame:
    found = classify.classify(_cleaned(spark, sf), min_score=1)
    return found.select("contact_id", "predicted_intent", "score")


def classify_confidence(spark: SparkSession, sf: str) -> DataFrame:
    scores = (F.col("all_scores")[i].alias(i.lower()) for i in C.INTENTS)
    return _classified(spark, sf).select(
        "contact_id", "predicted_intent", "confidence", "top_score", *scores
    )


def rule_eval(spark: SparkSession, sf: str) -> DataFrame:
    result = evaluate.evaluate_rules(_classified(spark, sf))
    return _rounded(result, "accuracy_when_classified", "coverage")


def rule_eval_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    result = evaluate.evaluate_rules(_classified(spark, sf), by=["channel"])
    return _rounded(result, "accuracy_when_classified", "coverage")


def channel_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.distribution(read_demo_contacts(spark, sf), "channel")


def intent_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.distribution(read_demo_contacts(spark, sf), "intent")


def preview_per_channel(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.preview_per_channel(read_demo_contacts(spark, sf))


def holdout_per_channel(spark: SparkSession, sf: str) -> DataFrame:
    held, rest = evaluate.hold_out_one_per_key(read_demo_contacts(spark, sf))
    side = lambda t, is_query: t.select("contact_id", "channel", F.lit(is_query).alias("is_query"))
    return side(held, True).unionByName(side(rest, False))


def embed_hashing(spark: SparkSession, sf: str) -> DataFrame:
    # The outer form: the plain one adds a filter that encodes every text twice.
    vectors = embed.embed_hashing(_cleaned(spark, sf))
    return (
        vectors.select("contact_id", F.posexplode_outer("embedding").alias("bucket", "value"))
        .where(F.col("value") != 0)
        .select("contact_id", F.col("bucket").cast("long"), F.round(F.col("value").cast("double"), 6).alias("value"))
    )


def topk_similar(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _given_vectors(spark, sf)
    return _rounded(similar.top_k_similar(vectors, vectors, 5, id_col="vec_id"), "similarity")


def topk_similar_cells(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _given_vectors(spark, sf)
    found = similar.top_k_similar(vectors, vectors, 5, id_col="vec_id", method="tiles")
    return _rounded(found, "similarity")


def _searched_lists(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = _given_vectors(spark, sf)
    index = lists.build_lists(vectors, id_col="vec_id")
    probes = lists.probes_for(index, vectors, 5, id_col="vec_id")
    return vectors, lists.search_lists(index, vectors, 5, probes, id_col="vec_id")


def topk_lists(spark: SparkSession, sf: str) -> DataFrame:
    """As ``topk_similar``, but of the lists that a query probes."""
    return _rounded(_searched_lists(spark, sf)[1], "similarity")


def topk_lists_recall(spark: SparkSession, sf: str) -> DataFrame:
    """How much of the exact result the lists give."""
    vectors, found = _searched_lists(spark, sf)
    return lists.measure_recall(found, similar.top_k_similar(vectors, vectors, 5, id_col="vec_id"))


def topk_per_channel(spark: SparkSession, sf: str) -> DataFrame:
    contacts = read_demo_contacts(spark, sf)
    return _rounded(evaluate.held_out_neighbours(contacts, 3), "similarity")


def knn_predict(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _given_vectors(spark, sf).withColumn("label", F.col("label").cast("string"))
    train, test = evaluate.split_train_test(vectors, id_col="vec_id")
    found = knn.knn_predict(test, train, 5, id_col="vec_id", label_col="label")
    ids = F.transform("neighbours", lambda n: n["neighbour_id"].cast("string"))
    return _rounded(
        found.select("query_id", "predicted_intent", "confidence", F.array_join(ids, ",").alias("neighbour_ids")),
        "confidence",
    )


def _knn_on_contacts(contacts: DataFrame) -> tuple[DataFrame, DataFrame]:
    train, test = evaluate.split_train_test(contacts)
    return test, knn.NearestNeighbourClassifier(k=5).fit(train).predict(test)


def knn_eval(spark: SparkSession, sf: str) -> DataFrame:
    test, predictions = _knn_on_contacts(_cleaned(spark, sf))
    return _rounded(evaluate.evaluate_knn(predictions, test), "accuracy")


def disagreements(spark: SparkSession, sf: str) -> DataFrame:
    test, predictions = _knn_on_contacts(_cleaned(spark, sf))
    differing = evaluate.disagreements(classify.classify_with_confidence(test), predictions)
    return _rounded(differing, "knn_confidence")


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = evaluate.split_train_test(read_demo_contacts(spark, sf))
    side = lambda t, is_train: t.select("contact_id", F.lit(is_train).alias("is_train"))
    return side(train, True).unionByName(side(test, False))


def sentiment_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf).select(
        "contact_id", "sentiment_label", "sentiment_confidence", "sentiment_scores.*"
    )
    return _rounded(scored, "sentiment_confidence", *C.SENTIMENT_LABELS)


def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(sentiment.sentiment_distribution(_scored(spark, sf)), "pct")


def sentiment_by_intent(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.sentiment_by(_scored(spark, sf), "intent")


def sentiment_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.sentiment_by(_scored(spark, sf), "channel")


def top_negative(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(sentiment.top_negative(_scored(spark, sf)), "sentiment_confidence")


def negative_spikes(spark: SparkSession, sf: str) -> DataFrame:
    """Weeks, and those in which an intent turned negative."""
    contacts = with_demo_time(_scored(spark, sf))
    found = _rounded(spikes.find_spikes(spikes.weekly_counts(contacts)), "share", "usual", "z")
    return found.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def contact_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of each user, parted by six hours without an event."""
    found = journeys.sessions(_events(spark, sf), SESSION_GAP)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("started", "ended")})


def next_contact(spark: SparkSession, sf: str) -> DataFrame:
    """The user's next error behind each event, within two days."""
    found = journeys.next_event(_events(spark, sf), F.col("event_type") == "error", CONTACT_WINDOW)
    return found.select("event_id", "next_id")


def repeat_contact(spark: SparkSession, sf: str) -> DataFrame:
    found = journeys.repeat_contacts(_events(spark, sf), F.col("event_type") == "error", CONTACT_WINDOW)
    return _rounded(found, "rate")


def contact_deflection(spark: SparkSession, sf: str) -> DataFrame:
    served = F.col("event_type").isin("view", "click")
    found = journeys.deflection(_events(spark, sf), served, F.col("event_type") == "error", CONTACT_WINDOW)
    return _rounded(found, "rate")


def crm_links(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, and a list of four in five of them with errors and gaps, whose
    ids are larger by a million, linked without their ids."""
    known = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )
    one_in = lambda n, k: F.col("id") % n == k
    listed = known.where(~one_in(5, 4)).select(
        (F.col("id") + 1_000_000).alias("id"),
        F.when(one_in(3, 0), F.translate("name", "#", "")).otherwise(F.col("name")).alias("name"),
        F.when(~one_in(11, 3), F.col("nation")).alias("nation"),
        F.when(~one_in(13, 5), F.col("segment")).alias("segment"),
        F.when(one_in(4, 1), F.col("balance") + 0.3).otherwise(F.col("balance")).alias("balance"),
    )
    fields = [Field("name", "text", 1), Field("nation"), Field("segment"), Field("balance", "number", 0.5)]
    blocks = [lambda t: F.concat("nation", F.lit("|"), "segment"), lambda t: F.floor(F.col("balance") / 5)]
    return _rounded(linkage.link_records(known, listed, fields, blocks, "id", "id"), "weight", "probability")


def topic_info(spark: SparkSession, sf: str) -> DataFrame:
    info = topics.topic_info(_given_topics(spark, sf), n_words=6)
    ids = F.transform("representative_ids", lambda i: i.cast("string"))
    return info.withColumns(
        {"words": F.array_join("words", ","), "representative_ids": F.array_join(ids, ",")}
    )


def topic_top_words(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(topics.top_words(_given_topics(spark, sf), n_words=6), "weight")


def topic_assignments(spark: SparkSession, sf: str) -> DataFrame:
    return topics.assignments(_given_topics(spark, sf))


def topic_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return topics.crosstab(_given_topics(spark, sf))


def topic_crosstab_dense(spark: SparkSession, sf: str) -> DataFrame:
    dense = topics.crosstab_dense(_given_topics(spark, sf), list(C.INTENTS))
    return dense.select("topic", *(F.col(i).alias(i.lower()) for i in dense.columns[1:]))


def topic_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return topics.alignment(_given_topics(spark, sf))


def topic_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted topics, as many as the contacts show, against the intents."""
    vectors = embed.embed_hashing(_cleaned(spark, sf)).select("contact_id", "intent", "embedding")
    return topics.crosstab(topics.fit_topics(vectors, min_topic_size=5))


def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned contacts written as JSON lines with a notice, and read back."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    write_contacts(_cleaned(spark, sf), path, notice="illustrative data")
    return read_contacts(spark, path, CLEANED_CONTACT)


def entry(spark: SparkSession) -> DataFrame:
    """Clean, classify, and report accuracy and coverage per channel."""
    return rule_eval_by_channel(spark, FLAGSHIP_DIR)


def _shipped(query: Query) -> Query:
    return lambda spark, sf: query(prepare_session(spark), sf)


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {f"clean_{c}": _cleaner(c) for c in C.CHANNELS}
    for query in (
        clean_chat_turns, preprocess_dispatch, score_intents, score_intents_raw,
        classify_min_score, classify_confidence, rule_eval, rule_eval_by_channel,
        channel_distribution, intent_distribution, preview_per_channel,
        holdout_per_channel, embed_hashing, topk_similar, topk_similar_cells,
        topk_lists, topk_lists_recall, topk_per_channel, knn_predict, knn_eval, disagreements, train_test_split,
        sentiment_score, sentiment_distribution, sentiment_by_intent,
        sentiment_by_channel, top_negative, negative_spikes, contact_sessions,
        next_contact, repeat_contact, contact_deflection, crm_links, topic_info, topic_top_words,
        topic_assignments, topic_crosstab, topic_crosstab_dense, topic_alignment,
        topic_fit, jsonl_roundtrip,
    ):
        named[query.__name__] = query
    if llm_queries:
        named |= llm_queries.queries()
    return {name: _shipped(query) for name, query in named.items()}


def oracle_sql() -> dict[str, str]:
    sql = statements() | (llm_oracle.statements() if llm_oracle else {})
    sql["topk_similar_cells"] = sql["topk_similar"]
    return sql
