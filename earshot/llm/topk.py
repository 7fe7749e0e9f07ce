"""Exact top-k by inner product, with vectors bucketed by their length.

Vectors are cut into blocks by length, longest first (a range partition, so a
mass of equal lengths is cut as well).  A query gets a first threshold from the
``SEEDS`` longest vectors and visits only blocks whose longest vector could
reach it.  Queries and blocks meet in tiles of bounded size.  In a tile the
block is cut into buckets of ``BUCKET`` vectors; a query's threshold divided by
its own and the bucket's length is the cosine that a vector must reach there, -1
where the threshold is below zero:

* above 1 the bucket is passed over, and with it all shorter ones;
* from ``COORDINATE_FROM`` on, on average, candidates come from the feasible
  range of the query's largest coordinate;
* else from the vectors that are long enough.

All candidates are verified by their products, which are exact integers: in
doubles where lengths allow, else in 64-bit or Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.tables import if_small, keep

SCALE = 256
# Vectors are kept in steps of 1 / SCALE, so a product is a score / UNIT.
UNIT = SCALE * SCALE
# Components beyond this would be cut: none is.
LARGEST = float("inf")
# Scores have so many decimal digits at most.
DIGITS = 38
_TOO_LONG = f"a score among the best has more than {DIGITS} digits"
SEEDS = 512
BLOCK_BYTES = 4 << 20
QUERY_BLOCK = 4096
BUCKET = 512
COORDINATE_FROM = 0.8
# Pairs whose products are formed in integers in one go.
PAIRS = 1 << 16
# Pruning bounds are widened by this share: floating point errs by less.
SLACK = 1e-9


def _padded(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists as rows of one matrix, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(int(lengths.max(initial=0)), 1)))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return out


def _widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _reach(query_lengths: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """No score is above the product of the lengths; infinite where it is too
    large for a double."""
    with np.errstate(over="ignore", invalid="ignore"):
        reach = query_lengths * lengths * UNIT
    return np.where(np.isnan(reach), np.inf, reach)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.linalg.norm(vectors, axis=1)


def _bounds(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of all scores.  Both are the score itself where the
    lengths' product is below 2**52: sums of whole steps are then exact."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = queries @ vectors.T * UNIT
        reach = _reach(_lengths(queries)[:, None], _lengths(vectors)[None, :])
        if reach.max(initial=0) < 2**52:
            return score, score
        margin = np.where(reach < 2**52, 0.0, reach * (vectors.shape[1] + 2) * 2.0**-51)
        lower, upper = score - margin, score + margin
    known = np.isfinite(score) & np.isfinite(margin)
    return np.where(known, lower, -np.inf), np.where(known, upper, np.inf)


def _whole(x: float) -> int:
    return int(x * SCALE) if abs(x) < 2**52 else int(x) * SCALE


def _scores(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs (q, v), whose upper bounds are given: 64-bit
    integers, or Python's where one of them needs it."""
    query_lengths, lengths = _lengths(queries), _lengths(vectors)
    if _reach(query_lengths.max(initial=0), lengths.max(initial=0)) < 2**52:
        return upper.astype(np.int64)
    reach = _reach(query_lengths[q], lengths[v])
    small, large = reach < 2**52, np.flatnonzero(reach >= 2**62)
    score = np.zeros(len(q), dtype=np.int64)
    score[small] = upper[small].astype(np.int64)
    middle = np.flatnonzero(~small & (reach < 2**62))
    for low in range(0, len(middle), PAIRS):
        some = middle[low : low + PAIRS]
        whole = [(m * SCALE).astype(np.int64) for m in (queries[q[some]], vectors[v[some]])]
        score[some] = (whole[0] * whole[1]).sum(axis=1)
    if not len(large):
        return score
    score = score.astype(object)
    integers = np.frompyfunc(_whole, 1, 1)
    used, q = np.unique(q[large], return_inverse=True)
    seen, v = np.unique(v[large], return_inverse=True)
    queries, vectors = integers(queries[used]), integers(vectors[seen])
    for low in range(0, len(large), PAIRS):
        some = slice(low, low + PAIRS)
        score[large[some]] = (queries[q[some]] * vectors[v[some]]).sum(axis=1)
    return score


def _doubles(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles that are not above and not below the scores."""
    if score.dtype == object:
        near = np.array([float(max(min(s, 2**1023), -(2**1023))) for s in score])
    else:
        near = score.astype(np.float64)
    exact, huge = np.abs(near) < 2**53, np.abs(near) == 2.0**1023
    down = np.where(huge & (near < 0), -np.inf, np.nextafter(near, -np.inf))
    up = np.where(huge & (near > 0), np.inf, np.nextafter(near, np.inf))
    return np.where(exact, near, down), np.where(exact, near, up)


def _best_first(query: np.ndarray, vector: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Order by query, then larger score, then smaller id."""
    if score.dtype == object:
        score = np.unique(score, return_inverse=True)[1]
    return np.lexsort((vector, -score, query))


class _Best:
    """The k best of each query so far: larger score first, then smaller id."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.floor, self.k = ids, floor.astype(np.float64), k
        self.query = np.zeros(0, dtype=np.int64)
        self.vector = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0, dtype=np.int64)

    def add(self, query: np.ndarray, vector: np.ndarray, score: np.ndarray) -> None:
        new = (_doubles(score)[1] >= self.floor[query]) & (self.ids[query] != vector)
        if not new.any():
            return
        query = np.concatenate([self.query, query[new]])
        vector, score = np.concatenate([self.vector, vector[new]]), np.concatenate([self.score, score[new]])
        order = _best_first(query, vector, score)
        query, vector, score = query[order], vector[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], _doubles(score[last])[0])
        stay = place < self.k
        self.query, self.vector, self.score = query[stay], vector[stay], score[stay]


def _by_coordinate(queries: np.ndarray, cosines: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(query, rows of the bucket) within the feasible range of the query's
    largest coordinate: angles to that axis differ by the local angle at most."""
    unit = bucket / np.maximum(np.linalg.norm(bucket, axis=1, keepdims=True), 1e-300)
    focus = np.abs(queries).argmax(axis=1)
    angle = np.arccos(np.clip(queries[np.arange(len(queries)), focus], -1, 1))
    reach = np.arccos(np.clip(cosines, -1, 1)) + 1e-6
    low, high = np.cos(np.minimum(angle + reach, np.pi)), np.cos(np.maximum(angle - reach, 0))
    for axis in np.unique(focus):
        order = np.argsort(unit[:, axis])
        values = unit[order, axis]
        for q in np.flatnonzero(focus == axis).tolist():
            begin = np.searchsorted(values, low[q] - SLACK, side="left")
            end = np.searchsorted(values, high[q] + SLACK, side="right")
            if begin < end:
                yield q, order[begin:end]


def _search_tile(best: _Best, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
    queries, vectors = _widened(queries, vectors)
    lengths = _lengths(vectors)
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    query_lengths = _lengths(queries)
    for low in range(0, len(ids), BUCKET):
        bucket, names = vectors[low : low + BUCKET], ids[low : low + BUCKET]
        reach = _reach(query_lengths, lengths[low])
        alive = np.flatnonzero(reach * (1 + SLACK) >= best.floor)
        if not len(alive):
            # A floor below zero keeps a query alive, so no shorter bucket counts.
            break
        # Shorter vectors may be further off to stay above a floor below zero.
        above = (reach[alive] > 0) & (best.floor[alive] >= 0)
        cosine = np.where(above, best.floor[alive] / np.maximum(reach[alive], 1e-300), -1.0)
        if np.isfinite(reach[alive]).all() and cosine.mean() >= COORDINATE_FROM:
            unit = queries[alive] / np.maximum(query_lengths[alive, None], 1e-300)
            for q, rows in _by_coordinate(unit, cosine * (1 - SLACK) - SLACK, bucket):
                _, upper = _bounds(queries[alive[q]][None], bucket[rows])
                rows = rows[high := upper[0] >= best.floor[alive[q]]]
                q = np.full(len(rows), alive[q])
                best.add(q, names[rows], _scores(queries, bucket, q, rows, upper[0][high]))
        else:
            long_enough = _reach(query_lengths[alive, None], lengths[low : low + BUCKET][None, :]) * (1 + SLACK) >= best.floor[alive, None]
            lower, upper = _bounds(queries[alive], bucket)
            other = best.ids[alive][:, None] != names[None, :]
            # Only what reaches the floor, or is among the bucket's k best, can count.
            k = min(best.k, lower.shape[1])
            floor = np.partition(np.where(other, lower, -np.inf), lower.shape[1] - k, axis=1)[:, lower.shape[1] - k]
            q, v = np.nonzero(other & long_enough & (upper >= np.maximum(floor[:, None], best.floor[alive, None])))
            score = _scores(queries[alive], bucket, q, v, upper[q, v])
            q, v, score = _least_of_ties(q, v, score, names, best.k)
            best.add(alive[q], names[v], score)


def _least_of_ties(q: np.ndarray, v: np.ndarray, score: np.ndarray, names: np.ndarray, k: int):
    """The k best of each query by score, then id: a mass of ties stays small."""
    order = _best_first(q, names[v], score)
    q, v, score = q[order], v[order], score[order]
    stay = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
    return q[stay], v[stay], score[stay]


def _quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, row, vector, length): usable vectors, in steps of 1 / SCALE.
    From 2**52 on every double is whole."""
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    odd = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = given.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~odd)
    whole = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x * SCALE).cast("double") / SCALE).otherwise(x)
    known = usable.select("vec_id", F.monotonically_increasing_id().alias("row"), F.transform("x", whole).alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x)
    return known.withColumn("length", F.sqrt(square))


def _first_floor(seeds: list, k: int):
    """A score that each query's k best reach, from the seed vectors."""
    ids = np.array([s["vec_id"] for s in seeds], dtype=np.int64)
    vectors = _padded(pa.array([s["vector"] for s in seeds], pa.list_(pa.float64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            score = _bounds(*_widened(_padded(batch.column(1)), vectors))[0]
            score[own[:, None] == ids[None, :]] = -np.inf
            enough = score.shape[1] >= k
            floor = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] if enough else np.full(len(own), -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], ["vec_id", "vector", "length", "row", "floor"])

    return run


def _tile(k: int):
    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        own = queries.column("query_id").to_numpy()
        best = _Best(own, queries.column("floor").to_numpy(), k)
        if len(own) and block.num_rows:
            _search_tile(best, _padded(queries.column("vector")), block.column("vec_id").to_numpy(), _padded(block.column("vector")))
        # Null is below all others: an error only if it is among a query's best.
        score = [Decimal(s) if s > -(10**DIGITS) else None for s in best.score.tolist()]
        if any(s is not None and s >= 10**DIGITS for s in score):
            raise ValueError(_TOO_LONG)
        score = pa.array(score, pa.decimal128(DIGITS, 0))
        return pa.table({"query_id": own[best.query], "vec_id": best.vector, "score": score})

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector that ``is_query`` (a
    condition on ``vec_id``) selects, its k highest inner products with the
    others, or as many as there are; ties to the smaller id.

    Components count as floor(256 * x), however large; ``score`` is an exact
    decimal of DIGITS digits, and a score among the best that has more is an
    error.  Vectors that are null or hold null or non-finite components, and
    rows without id, take no part.  Repeated rows of an id stay rows: each can
    be found, and those of a query are ranked together.  Vectors of other
    dimensions are filled up with zeros.  Other columns are ignored.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    known = keep(_quantised(vectors, id_col, vector_col), "vectors")
    n, n_queries, widest = known.agg(F.count("*"), F.count_if(is_query), F.max(F.size("vector"))).first()
    rows = max(BUCKET, BLOCK_BYTES // (8 * max(widest or 1, 1)))
    seeds = known.orderBy(F.desc("length"), "vec_id", "row").limit(max(SEEDS, k + 1)).collect()  # a bounded number
    n_blocks, n_query_blocks = max(1, -(-n // rows)), max(1, -(-(n_queries or 0) // QUERY_BLOCK))

    ranged = known.repartitionByRange(n_blocks, F.desc("length"), "vec_id", "row")
    blocks = keep(ranged.withColumn("block", F.spark_partition_id()), "blocks")
    longest = keep(blocks.groupBy("block").agg(F.max("length").alias("longest")), "longest")
    asked = known.where(is_query).select("vec_id", "vector", "length", "row").mapInArrow(
        _first_floor(seeds, k), "vec_id long, vector array<double>, length double, row long, floor double"
    )
    asked = keep(asked.withColumn("part", F.pmod(F.xxhash64("vec_id", "row"), F.lit(n_query_blocks)).cast("int")), "asked")
    reaches = F.col("length") * F.col("longest") * UNIT * (1 + SLACK) >= F.col("floor")
    visits = asked.join(if_small(longest), reaches).select(
        "block", "part", F.col("vec_id").alias("query_id"), "vector", "floor"
    )
    # A block is copied to the parts of the queries that have a query for it.
    visited = if_small(keep(visits.select("block", "part").distinct(), "visited"))
    meeting = blocks.join(visited, "block").select("block", "part", "vec_id", "vector")
    found = (
        visits.groupBy("block", "part")
        .cogroup(meeting.groupBy("block", "part"))
        .applyInArrow(_tile(k), f"query_id long, vec_id long, score decimal({DIGITS},0)")
    )
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.coalesce("score", F.raise_error(F.lit(_TOO_LONG))).alias("score")
    )
