"""Inverted lists against the exact search."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from test_similar import brute_force, same, table_of, unit

from earshot.operators import lists, similar
from earshot.operators.similar import top_k_similar


@pytest.fixture(scope="module")
def corpus(spark):
    """Clusters; a third of the rows are copies of one vector; zero vectors."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16))
    loose = centres[rng.integers(0, 30, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    vectors = unit(np.vstack([loose, np.tile(centres[0], (750, 1)), np.zeros((5, 16))]))
    ids = rng.permutation(len(vectors))
    odd = spark.createDataFrame([(90_000, "L0", None)], "contact_id long, intent string, embedding array<float>")
    return (ids, vectors), table_of(spark, ids, vectors).unionByName(odd).repartition(5)


def test_all_lists_give_the_exact_result(spark, corpus, monkeypatch):
    monkeypatch.setattr(similar, "TILE_BYTES", 4000)
    (ids, vectors), table = corpus
    index = lists.build_lists(table, n_lists=12, carry=["intent"])
    sizes = index.sizes().collect()
    assert sum(r["n"] for r in sizes) == len(ids) and max(r["n"] for r in sizes) >= 750
    some = np.arange(0, len(ids), 40)
    found = lists.search_lists(index, table_of(spark, ids[some], vectors[some]), 6, probes=100)
    same(found, brute_force((ids[some], vectors[some]), (ids, vectors), 6))


def test_recall_is_reached_with_few_probes(spark, corpus):
    (ids, vectors), table = corpus
    index = lists.build_lists(table)
    probes = lists.probes_for(index, table, 5, recall=0.95)
    assert 1 <= probes < len(index.centres) / 3
    exact = top_k_similar(table, table, 5)
    measured = lists.measure_recall(lists.search_lists(index, table, 5, probes), exact).first()
    assert measured["queries"] == len(ids) and measured["wanted"] == 5 * len(ids) and measured["recall"] >= 0.9
    # More probes find no less.
    more = lists.measure_recall(lists.search_lists(index, table, 5, 2 * probes), exact).first()
    assert more["met"] >= measured["met"]


def test_adding_rows(spark, corpus):
    (ids, vectors), table = corpus
    half = lists.build_lists(table.where("contact_id % 2 = 0"), n_lists=9, carry=["intent"])
    whole = half.add(table.where("contact_id % 2 = 1 OR contact_id = 90000"))
    assert whole.rows.count() == len(ids)
    found = lists.search_lists(whole, table_of(spark, ids[:20], vectors[:20]), 3, probes=9)
    same(found, brute_force((ids[:20], vectors[:20]), (ids, vectors), 3))


def test_small_and_empty(spark, corpus):
    _, table = corpus
    one = lists.build_lists(table.where("contact_id = 3"))
    assert [r["neighbour_id"] for r in lists.search_lists(one, table.limit(2), 5).collect()] in ([3, 3], [3])
    none = lists.build_lists(table.limit(0))
    assert lists.search_lists(none, table.limit(2), 5).collect() == []
    assert lists.probes_for(none, table.limit(0)) == 1
    assert lists.search_lists(one, table.limit(0), 5).collect() == []
    assert lists.measure_recall(*[lists.search_lists(none, table.limit(2), 5)] * 2).first()["recall"] is None
    with pytest.raises(ValueError):
        lists.search_lists(one, table, 0)
    with pytest.raises(ValueError):
        lists.build_lists(table, n_lists=0)


def test_probing_needs_bounded_memory():
    """As many lists as there may be, and a full batch of queries."""
    rng = np.random.default_rng(2)
    vectors, centres = rng.normal(size=(2500, 8)).astype(np.float32), rng.normal(size=(4096, 8))
    batch = pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), 8).cast(pa.list_(pa.float32()))], ["_vector"])
    tracemalloc.start()
    found = [row for part in lists._with_lists(batch, centres, 9) for row in part.column("_lists").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    assert found == lists._by_nearness(vectors.astype(np.float64), centres, 9).tolist()
