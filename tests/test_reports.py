"""Sentiment, topics, splits and evaluation on small hand-made tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot import constants as C
from earshot.operators import evaluate, sentiment, topics
from earshot.plans import jobs
from earshot.operators.embed import embed_hashing, embed_one


def scored(spark, rows):
    return spark.createDataFrame(
        rows,
        "contact_id int, intent string, channel string, cleaned_text string, "
        "sentiment_label string, sentiment_confidence double",
    )


def test_default_sentiment(spark):
    texts = ["terrible, awful service", "great help, thanks", "where is it", "great but awful", "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, cleaned_text string")
    rows = sentiment.score_sentiment(table).orderBy("i").collect()
    assert [r["sentiment_label"] for r in rows] == [
        "negative", "positive", "neutral", "negative", "neutral", "neutral",
    ]  # a tie goes to the first label
    for row in rows:
        chances = row["sentiment_scores"].asDict()
        assert list(chances) == list(C.SENTIMENT_LABELS)
        assert math.isclose(sum(chances.values()), 1.0)
        assert math.isclose(chances[row["sentiment_label"]], row["sentiment_confidence"])
    two = math.exp(2 * math.log(3))
    assert math.isclose(rows[0]["sentiment_confidence"], two / (two + math.e + 1))


def test_single_texts(spark):
    row = sentiment.score_one(spark, "awful and useless")
    assert row["sentiment_label"] == "negative"
    assert math.isclose(sum(x * x for x in embed_one(spark, "one two two")), 1.0, rel_tol=1e-6)


def test_plugged_in_scorer(spark):
    def load():
        return lambda texts: np.array([[0.0, 0.0, len(t)] for t in texts])

    table = spark.createDataFrame([(1, "abc"), (2, ""), (3, None)], "i int, cleaned_text string")
    rows = sentiment.score_with(table, load, batch_size=2).orderBy("i").collect()
    assert [r["sentiment_label"] for r in rows] == ["positive", "negative", "negative"]
    assert math.isclose(rows[0]["sentiment_confidence"], math.exp(3) / (math.exp(3) + 2))
    assert "_logits" not in rows[0].asDict()


def test_sentiment_reports(spark):
    rows = [
        (1, "A", "phone", "x" * 120, "negative", 0.9),
        (2, "A", "chat", "short", "negative", 0.9),
        (3, "B", "chat", "z", "positive", 0.99),
        (4, "A", "phone", "y", "negative", 0.5),
    ]
    table = scored(spark, rows)
    got = [tuple(r) for r in sentiment.sentiment_distribution(table).orderBy("ordinal").collect()]
    assert got == [(0, "negative", 3, 75.0), (1, "neutral", 0, 0.0), (2, "positive", 1, 25.0)]
    got = sentiment.sentiment_distribution(table.limit(0)).orderBy("ordinal").collect()
    assert [(r["n"], r["pct"]) for r in got] == [(0, 0.0)] * 3
    assert [tuple(r) for r in sentiment.sentiment_by(table, "intent").collect()] == [
        ("A", 3, 0, 0, 3), ("B", 0, 0, 1, 1),
    ]
    top = sentiment.top_negative(table, 2).collect()
    assert [r["contact_id"] for r in top] == [1, 2]
    assert top[0]["preview"] == "x" * 110 + "..." and top[1]["preview"] == "short"
    assert sentiment.top_negative(table, 10).count() == 3


def topic_table(spark, rows):
    return spark.createDataFrame(rows, "contact_id int, topic int, intent string, cleaned_text string")


@pytest.mark.parametrize(
    "intents, want",
    [
        ({0: "AAAAAAABBB", 1: "BBBB", -1: "AB"}, (2, 2, "strong")),
        ({0: "AAAAAABBBB", 1: "BBBB", 2: "AB"}, (1, 3, "partial")),
        ({0: "AB"}, (0, 1, "partial")),  # half of one topic is none
        ({0: "AB", 1: "AB"}, (0, 2, "weak")),
        ({-1: "AB"}, (0, 0, "none")),
        ({}, (0, 0, "none")),
    ],
)
def test_alignment(spark, intents, want):
    rows = [(0, t, i, "") for t, letters in intents.items() for i in letters]
    assert tuple(topics.alignment(topic_table(spark, rows)).first()) == want


def test_crosstab(spark):
    rows = [(1, 0, "A", ""), (2, 0, "A", ""), (3, 0, None, ""), (4, -1, "B", ""), (5, 3, "B", "")]
    table = topic_table(spark, rows)
    assert sorted(tuple(r) for r in topics.crosstab(table).collect()) == [
        (-1, "B", 1), (0, "A", 2), (0, "UNKNOWN", 1), (3, "B", 1),
    ]
    dense = topics.crosstab_dense(table)
    assert dense.columns == ["topic", "A", "B", "UNKNOWN"]
    assert [tuple(r) for r in dense.collect()] == [(0, 2, 0, 1), (3, 0, 1, 0), (-1, 0, 1, 0)]
    dense = topics.crosstab_dense(table, ["A", "C"])  # every row counts somewhere
    assert dense.columns == ["topic", "A", "C", "UNKNOWN", "OTHER"]
    assert [tuple(r) for r in dense.collect()] == [(0, 2, 0, 1, 0), (3, 0, 0, 0, 1), (-1, 0, 0, 0, 1)]
    assert [tuple(r) for r in topics.assignments(table).orderBy("contact_id").collect()][:1] == [(1, 0)]


def test_top_words(spark):
    rows = [
        (1, 0, "A", "parcel parcel the a"), (2, 0, "A", "The parcel late"),
        (3, 1, "A", "login the app"), (4, -1, "A", "the app junk"),
    ]
    got = topics.top_words(topic_table(spark, rows), 2).orderBy("topic", "rank").collect()
    mean = (6 + 3 + 3) / 3
    weight = lambda tf, f: round(tf * math.log(1 + mean / f), 9)
    assert [tuple(r) for r in got] == [
        (0, 1, "parcel", weight(3, 3)), (0, 2, "late", weight(1, 1)),
        (1, 1, "login", weight(1, 1)), (1, 2, "app", weight(1, 2)),
    ]


def test_fit_topics(spark):
    rng = np.random.default_rng(0)
    centres = np.eye(4, 8)
    points = np.vstack([np.repeat(centres[:3], [40, 30, 20], axis=0), centres[3:]])
    points = points + 0.01 * rng.normal(size=points.shape)
    rows = [(i, "AB"[i % 2], "some words here", [float(x) for x in p]) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "contact_id int, intent string, cleaned_text string, embedding array<float>")
    fitted = topics.fit_topics(table, min_topic_size=5, nr_topics=3)
    sizes = dict(fitted.groupBy("topic").count().collect())
    assert sum(sizes.values()) == len(points) and set(sizes) - {-1} == set(range(len(sizes) - (-1 in sizes)))
    kept = [sizes[t] for t in sorted(set(sizes) - {-1})]
    assert kept == sorted(kept, reverse=True) and len(kept) <= 3 and min(kept) >= 5
    info = topics.topic_info(fitted, n_words=2)
    assert info.columns == ["topic", "n", "name", "words", "representative_ids"]
    assert all(len(r["representative_ids"]) <= 3 for r in info.collect())
    with pytest.raises(ValueError):
        topics.fit_topics(table.limit(0))


def test_outliers_do_not_depend_on_the_number_of_rows(spark):
    rng = np.random.default_rng(1)
    shares = []
    for times in (1, 100):
        dense = np.repeat(np.eye(3, 60), 30 * times, axis=0) + 0.01 * rng.normal(size=(90 * times, 60))
        noise = np.hstack([np.zeros((10 * times, 3)), rng.normal(size=(10 * times, 57))])
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        points = np.vstack([dense, noise])
        rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
        table = spark.createDataFrame(rows, "contact_id int, embedding array<float>")
        fitted = topics.fit_topics(table, min_topic_size=5, max_topics=3, min_similarity=0.5)
        n_out = fitted.where("topic = -1").count()
        assert fitted.where("topic = -1 AND contact_id < {}".format(len(dense))).count() == 0
        shares.append(n_out / len(points))
    assert shares == [0.1, 0.1]


def test_max_topics_is_honoured(spark):
    rng = np.random.default_rng(2)
    points = np.repeat(np.eye(80, 80), 6, axis=0) + 0.001 * rng.normal(size=(480, 80))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "contact_id int, embedding array<float>")
    fitted = topics.fit_topics(table, min_topic_size=5, max_topics=80)
    assert fitted.where("topic >= 0").select("topic").distinct().count() > 64
    with pytest.raises(ValueError):
        topics.fit_topics(table, max_topics=0)


def test_more_topics_than_the_default(spark):
    rng = np.random.default_rng(2)
    points = np.repeat(np.eye(80, 80), 6, axis=0) + 0.001 * rng.normal(size=(480, 80))
    rows = [(i, "A", str([float(x) for x in p])) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "contact_id int, intent string, cleaned_text string")
    embed = lambda t: t.withColumn("embedding", F.from_json("cleaned_text", "array<float>"))
    count = lambda fitted: fitted.where("topic >= 0").select("topic").distinct().count()
    assert 64 < count(topics.TopicModeller(nr_topics=80, embed=embed).fit(table).assignments()) <= 80
    assert 64 < count(topics.TopicModeller(max_topics=80, embed=embed).fit(table).assignments()) <= 80
    assert 64 < count(jobs.topics_job(table, nr_topics=80, embedder=embed)["assigned"]) <= 80
    assert 64 < count(jobs.topics_job(table, nr_topics=None, embedder=embed, max_topics=80)["assigned"]) <= 80
    assert count(topics.TopicModeller(nr_topics=80, embed=embed, max_topics=10).fit(table).assignments()) <= 10


def test_topic_modeller(spark):
    rows = [(i, "A" if i % 2 else "B", "parcel lost again" if i % 2 else "app login broken") for i in range(20)]
    table = spark.createDataFrame(rows, "contact_id int, intent string, cleaned_text string")
    model = topics.TopicModeller(min_topic_size=3, nr_topics=2)
    with pytest.raises(RuntimeError):
        model.topic_info()
    model.fit(table)
    assert model.assignments().count() == 20
    assert {r["topic"] for r in model.top_words_per_topic(1).collect()} <= {0, 1}
    assert model.cross_tab_against_intents().agg(F.sum("n")).first()[0] == 20
    assert model.topic_info().agg(F.sum("n")).first()[0] == 20


def test_merge_topics():
    centres = np.array([[1, 0], [0.9, 0.1], [0, 1], [-1, 0]], dtype=float)
    sizes = np.array([10, 5, 12, 2])
    assert topics.merge_topics(centres, sizes, 5, None) == [1, 2, 0, -1]
    assert topics.merge_topics(centres, sizes, 5, 2) == [0, 0, 1, -1]
    assert topics.merge_topics(centres, sizes, 5, 1) == [0, 0, 0, -1]
    assert topics.merge_topics(centres, sizes, 50, 2) == [-1] * 4


@pytest.mark.parametrize("n, fraction", [(1000, 0.2), (7, 0.5), (3, 0.2), (5, 0.0), (5, 1.0), (0, 0.2), (1, 0.5)])
def test_split(spark, n, fraction):
    import hashlib

    table = spark.range(n).withColumnRenamed("id", "contact_id")
    train, test = (
        [r[0] for r in side.collect()] for side in evaluate.split_train_test(table, fraction)
    )
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    cut = int(n * (1 - fraction))
    assert sorted(train) == sorted(order[:cut]) and sorted(test) == sorted(order[cut:])


def test_split_of_text_ids_depends_on_seed(spark):
    table = spark.range(50).select(F.concat(F.lit("c-"), "id").alias("contact_id"))
    sides = [{r[0] for r in evaluate.split_train_test(table, seed=s)[1].collect()} for s in (1, 1, 2)]
    assert sides[0] == sides[1] != sides[2] and len(sides[0]) == len(sides[2]) == 10


def test_split_keeps_rows_without_id(spark):
    table = spark.createDataFrame([(i if i % 4 else None,) for i in range(20)], "contact_id int")
    for fraction in (0.2, 0.0, 1.0):
        train, test = evaluate.split_train_test(table, fraction)
        assert train.count() + test.count() == 20
        assert train.where("contact_id IS NULL").count() == 5


def test_rule_evaluation(spark):
    rows = [("A", "A"), ("A", "B"), ("A", None), (None, "A")]
    table = spark.createDataFrame(rows, "intent string, predicted_intent string")
    assert tuple(evaluate.evaluate_rules(table).first()) == (4, 1, 1, 1 / 3, 0.75)
    nothing = table.where(F.col("predicted_intent").isNull())
    assert tuple(evaluate.evaluate_rules(nothing).first()) == (1, 0, 1, 0.0, 0.0)
    assert tuple(evaluate.evaluate_rules(table.limit(0)).first()) == (0, 0, 0, 0.0, None)


def test_knn_evaluation_and_disagreements(spark):
    test = spark.createDataFrame(
        [(1, "A", "t1", "A", 3), (2, "A", "t2", None, 0), (3, "B", "t3", None, 1), (4, "B", "t4", "A", 2)],
        "contact_id int, intent string, cleaned_text string, predicted_intent string, top_score int",
    )
    predictions = spark.createDataFrame(
        [(1, "A", 1.0), (2, "A", 0.5), (3, None, 0.0), (4, "B", 0.7)],
        "query_id int, predicted_intent string, confidence double",
    )
    assert tuple(evaluate.evaluate_knn(predictions, test).first()) == (4, 3, 0.75)
    assert tuple(evaluate.evaluate_knn(predictions, test.limit(0)).first()) == (0, 0, None)
    differing = evaluate.disagreements(test, predictions)
    assert sorted(r["query_id"] for r in differing.collect()) == [2, 4]
    unseen = evaluate.disagreements(test, predictions.where("query_id <> 4"))
    assert sorted(r["query_id"] for r in unseen.collect()) == [2, 4]
    shown = evaluate.show_disagreements(differing, test, 1).collect()
    assert [(r["query_id"], r["rule_intent"], r["knn_intent"], r["preview"]) for r in shown] == [(2, None, "A", "t2")]


def test_first_per_channel(spark):
    rows = [(3, "chat", "A", "pls\nhelp"), (1, "chat", "B", "x" * 200), (2, "phone", "A", "um hi"), (4, "phone", "A", "b")]
    table = spark.createDataFrame(rows, "contact_id int, channel string, intent string, text string")
    held, rest = evaluate.hold_out_one_per_key(table)
    assert sorted(r["contact_id"] for r in held.collect()) == [1, 2]
    assert sorted(r["contact_id"] for r in rest.collect()) == [3, 4]
    shown = {r["channel"]: r for r in evaluate.preview_per_channel(table).collect()}
    assert shown["chat"]["before"] == "x" * 140 + "…" and shown["phone"]["after"] == "hi"
    assert [tuple(r) for r in evaluate.distribution(table, "intent").collect()] == [("A", 3), ("B", 1)]


def test_topic_info_makes_its_rows_once(spark, monkeypatch):
    """Texts are cleaned and encoded in one job, not once for each part."""
    plans, real = [], topics.hold
    plan_of = lambda t: t._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(topics, "hold", lambda t: plans.append(plan_of(t)) or real(t))
    rows = [(k, k % 3, f"word{k % 5} other") for k in range(30)]
    contacts = embed_hashing(spark.createDataFrame(rows, "contact_id long, topic int, cleaned_text string"))
    info = topics.topic_info(contacts)
    assert [p.count("ArrowEvalPython") for p in plans] == [1] and "ArrowEvalPython" not in plan_of(info)
    assert info.agg(F.sum("n")).first()[0] == 30
