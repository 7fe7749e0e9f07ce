"""Approximate top-k: inverted lists behind a coarse quantiser.

Vectors are dealt to the list of their nearest centre.  A query meets the
vectors of the ``probes`` lists whose centres are nearest to it, and only these;
there products are exact, ranks and ties as in ``similar``.  With as many probes
as lists the result is that of the exact search, which stays the default.

A list of any size is whole: it is cut into parts of bounded bytes, as are the
queries that probe it, and a part meets a block of queries in one task.  The
quantiser is fitted on at most ROWS_A_LIST rows for each list, chosen by a hash
of the id; all rows are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators import similar
from earshot.operators.hold import hold, small_side
from earshot.operators.splitting import nearest

MAX_LISTS = 4096
ROWS_A_LIST = 64
# Queries whose exact neighbours say how many lists to probe.
TUNING_QUERIES = 256
# Queries and centres whose products are ranked in one go.
PROBED_CELLS = 1 << 20


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


@dataclass
class InvertedLists:
    """``rows``: (neighbour_id, *carry, _vector, _list), held."""

    centres: np.ndarray
    rows: DataFrame
    carry: list[str]

    def sizes(self) -> DataFrame:
        """(list, n): a row for each list that has vectors."""
        return self.rows.groupBy(F.col("_list").alias("list")).agg(F.count("*").alias("n"))

    def add(self, corpus: DataFrame, id_col: str = "contact_id", vector_col: str = "embedding") -> InvertedLists:
        """The same lists with more rows in them."""
        more = similar._prepare(corpus, id_col, "neighbour_id", vector_col, self.carry)
        return InvertedLists(self.centres, self.rows.unionByName(hold(_dealt(more, self.centres))), self.carry)


def _dealt(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Rows that have a vector, each with its list."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("_vector")))
            step = max(1, PROBED_CELLS // len(centres))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                found = np.zeros(part.num_rows, dtype=np.int64)
                if len(centres) > 1:
                    found = nearest(_unit(similar._matrix(part.column("_vector"))), centres)
                yield part.append_column("_list", pa.array(found, pa.int32()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(deal, f"{fields}, _list int")


def build_lists(
    corpus: DataFrame, n_lists: int | None = None, id_col: str = "contact_id", vector_col: str = "embedding",
    carry: list[str] | None = None, seed: int = 42,
) -> InvertedLists:
    """Index ``corpus``: by default about the square root of its rows in lists.

    Null vectors take no part; all others must have one length.  Lists are made
    by direction, so the index suits vectors of about one length.
    """
    if n_lists is not None and n_lists < 1:
        raise ValueError("n_lists must be at least 1")
    rows = similar._held(similar._prepare(corpus, id_col, "neighbour_id", vector_col, carry or []))
    n = rows.count()
    if not n:
        return InvertedLists(np.zeros((1, 1)), rows.withColumn("_list", F.lit(0)), carry or [])
    n_lists = min(n_lists or max(1, round(n**0.5)), MAX_LISTS)
    share = min(1.0, ROWS_A_LIST * n_lists / n)
    place = F.pmod(F.xxhash64("neighbour_id", F.lit(seed)), F.lit(1 << 30))
    sample = rows.where(place < int(share * (1 << 30))) if share < 1 else rows
    length = F.sqrt(F.aggregate("_vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    unit = F.transform("_vector", lambda x: F.coalesce(F.try_divide(x.cast("double"), length), F.lit(0.0)))
    features = sample.select(array_to_vector(unit).alias("features"))
    if n_lists == 1 or features.isEmpty():
        one = np.zeros((1, similar._dimension(rows)))
        return InvertedLists(one, hold(_dealt(rows, one)), carry or [])
    centres = np.stack(KMeans(k=n_lists, seed=seed, maxIter=10, solver="row").fit(features).clusterCenters())
    return InvertedLists(centres, hold(_dealt(rows, centres)), carry or [])


def _by_nearness(vectors: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest centres of each vector, nearest first."""
    if len(centres) == 1:
        return np.zeros((len(vectors), 1), dtype=np.int64)
    near = _unit(vectors) @ centres.T - np.einsum("ij,ij->i", centres, centres) / 2
    return np.argsort(-near, axis=1, kind="stable")[:, :probes]


def _with_lists(batch: pa.RecordBatch, centres: np.ndarray, probes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of PROBED_CELLS, with ``_lists``."""
    step = max(1, PROBED_CELLS // len(centres))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        found = _by_nearness(similar._matrix(part.column("_vector")), centres, probes)
        offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel(), pa.int32()))
        yield part.append_column("_lists", lists)


def _probing(queries: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """A row for each query and list that it probes."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _with_lists(batch, centres, probes)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema.fields)
    return queries.mapInArrow(probe, f"{fields}, _lists array<int>")


def search_lists(
    index: InvertedLists, queries: DataFrame, k: int = 5, probes: int = 8,
    id_col: str = "contact_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, neighbour_id, *carry, similarity) of the k best vectors
    in the lists that a query probes; fewer, where these hold fewer."""
    if k < 1 or probes < 1:
        raise ValueError("k and probes must be at least 1")
    probes = min(probes, len(index.centres))
    asked = similar._held(similar._prepare(queries, id_col, "query_id", vector_col))
    placed = hold(_probing(asked, index.centres, probes)).withColumn("_list", F.explode("_lists")).drop("_lists")
    dim = max(similar._dimension(index.rows), 1)
    blocks = lambda n: F.ceil(n * 8 * dim / similar.TILE_BYTES).cast("int")
    # A row for each list.
    wanted = placed.groupBy("_list").agg(blocks(F.count("*")).alias("_n"))
    known = index.rows.groupBy("_list").agg(blocks(F.count("*")).alias("_m"))
    cut = small_side(wanted.join(known, "_list"))
    block = lambda id_col, n: F.pmod(F.xxhash64(id_col), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(cut, "_list").withColumn("_i", block("query_id", "_n")).withColumn("_j", every("_m"))
    right = index.rows.join(cut, "_list").withColumn("_j", block("neighbour_id", "_m")).withColumn("_i", every("_n"))
    keys = ["_list", "_i", "_j"]
    own = index.rows.drop("_list")
    left, right = left.select("query_id", "_vector", *keys), right.select(*own.columns, *keys)

    def meet(asked: pa.Table, known: pa.Table) -> pa.Table:
        known = known.drop_columns(keys)
        if not asked.num_rows or not known.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in similar._arrow_schema(asked, known)})
        query, best = similar._top_of_block(similar._matrix(asked.column("_vector")), known, k)
        return best.add_column(0, "query_id", asked.column("query_id").take(pa.array(query)))

    schema = similar._candidate_schema(asked, own)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
    ranked = similar.rank_neighbours(found, k)
    return ranked.select("query_id", "rank", "neighbour_id", *index.carry, "similarity")


def probes_for(
    index: InvertedLists, queries: DataFrame, k: int = 5, recall: float = 0.95,
    id_col: str = "contact_id", vector_col: str = "embedding", seed: int = 7,
) -> int:
    """The fewest lists to probe for ``recall`` of the k nearest, judged by the
    exact neighbours of TUNING_QUERIES queries chosen by a hash of their id."""
    asked = similar._prepare(queries, id_col, "query_id", vector_col)
    chosen = similar._held(asked.orderBy(F.xxhash64("query_id", F.lit(seed)), "query_id").limit(TUNING_QUERIES))
    exact = similar.top_k_similar(
        chosen.select("query_id", "_vector"), index.rows.select(F.col("neighbour_id").alias("query_id"), "_vector", "_list"),
        k, "query_id", "_vector", ["_list"],
    )
    sample = chosen.toArrow()
    if not sample.num_rows:
        return 1
    order = _by_nearness(similar._matrix(sample.column("_vector")), index.centres, len(index.centres))
    row = {i: at for at, i in enumerate(sample.column("query_id").to_pylist())}
    # At most k rows for each sampled query.
    needed = sorted(int(np.flatnonzero(order[row[r["query_id"]]] == r["_list"])[0]) + 1 for r in exact.collect())
    return needed[max(0, int(np.ceil(recall * len(needed))) - 1)] if needed else 1


def measure_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, wanted, met, recall): how many of the exact neighbours were
    found; null recall where there are none."""
    keys = ["query_id", "neighbour_id"]
    hits = exact.select(*keys).join(found.select(*keys).withColumn("hit", F.lit(True)), keys, "left")
    counted = hits.agg(F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"), F.count("hit").alias("met"))
    return counted.withColumn("recall", F.try_divide("met", "wanted"))
