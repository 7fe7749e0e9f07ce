"""The number of clusters follows the data."""

import numpy as np
import pytest

from earshot.operators import splitting, topics


def planted(spark, groups, rows, dim, noise=0.02, seed=0, copies=0):
    """Unit vectors around ``groups`` random directions, group sizes uneven."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    share = rng.uniform(1, 3, groups)
    of = np.concatenate([np.arange(groups).repeat(8), rng.choice(groups, max(0, rows - 8 * groups), p=share / share.sum())])
    points = centres[of] + noise * rng.normal(size=(len(of), dim))
    of, points = np.concatenate([of, np.full(copies, 0)]), np.vstack([points, np.tile(centres[0], (copies, 1))])
    table = [(i, int(g), [float(x) for x in p]) for i, (g, p) in enumerate(zip(of, points))]
    return spark.createDataFrame(table, "contact_id int, planted int, embedding array<float>").repartition(4)


@pytest.mark.parametrize("groups, rows", [(5, 400), (5, 8000), (50, 1500), (50, 8000), (300, 6000)])
def test_number_of_topics(spark, groups, rows):
    table = planted(spark, groups, rows, 24)
    fitted = topics.fit_topics(table, min_topic_size=5)
    pairs = fitted.groupBy("planted", "topic").count().collect()
    assert sorted(r["topic"] for r in pairs) == list(range(groups))
    assert len({r["planted"] for r in pairs}) == groups


def test_copies_and_one_group(spark):
    fitted = topics.fit_topics(planted(spark, 6, 300, 16, copies=600), min_topic_size=5)
    pairs = {tuple(r) for r in fitted.where("planted > 0 OR contact_id >= 300").select("planted", "topic").distinct().collect()}
    # Copies are one topic; next to their point, what lies around it may seem far.
    assert len(pairs) == 6 and len({t for _, t in pairs}) == 6 and all(t >= 0 for _, t in pairs)
    alone = topics.fit_topics(planted(spark, 1, 500, 16, noise=0.3), min_topic_size=5, min_similarity=-1.0)
    assert [r[0] for r in alone.select("topic").distinct().collect()] == [0]
    same = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(20)], "contact_id int, embedding array<float>")
    assert splitting.find_centres(same).tolist() == [[0.0, 0.0]]


def test_criterion_keeps_a_round_group_whole():
    rng = np.random.default_rng(4)
    for n, dim in ((30, 2), (200, 8), (3000, 3)):
        assert len(splitting.propose(rng.normal(size=(n, dim)), 1e-9, rng)) == 1
    two = np.vstack([rng.normal(size=(100, 5)), rng.normal(size=(12, 5)) + 8])
    assert len(splitting.propose(two, 1e-9, rng)) == 2


def test_only_clusters_that_may_be_split_send_samples(spark, monkeypatch):
    sent, real = [], splitting._round

    def counting(*args):
        groups, samples = real(*args)
        sent.append((len(groups.n), len(samples)))
        return groups, samples

    monkeypatch.setattr(splitting, "_round", counting)
    splitting.find_centres(planted(spark, 20, 800, 24, noise=0.1))
    # Sums of proposed parts come without samples, and settled clusters send none.
    assert len(sent) >= 3 and all(n == 0 for _, n in sent[1::2]) and all(n <= k for k, n in sent)
