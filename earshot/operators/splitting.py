"""Clusters whose number comes from the data.

Clusters are split as long as that pays.  The criterion is Schwarz's: the log
likelihood of spherical groups of one common variance, less half the logarithm
of the rows for each parameter.  A round reads all rows once: each goes to its
nearest centre, and a cluster's rows, their sum and sum of squares are added up;
a bounded sample of its rows comes along.  Splits are proposed on the sample,
recursively, so a round may find many groups at once.  Whether a proposal stays
is decided by the sums over all rows, as is whether two near clusters are one.

What the driver holds are centres, sums and the samples: SAMPLE_ROWS vectors in
all, or LEAST_SAMPLE for each cluster.  Only clusters that may still be split
send a sample, in single precision, as the vectors have it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.similar import _matrix

SAMPLE_ROWS = 4_096
LEAST_SAMPLE = 24
MAX_ROUNDS = 20
# Groups that one split may make.
MOST_AT_ONCE = 32
# Rows and centres whose distances are computed in one go.
_CELLS = 1 << 22
# How many rows the variance of all clusters counts for in that of two.
USUAL_ROWS = 40
# Variance below this share of the whole table's counts as this much.
FLAT = 1e-6


@dataclass
class Groups:
    """Sums over the rows of each cluster."""

    n: np.ndarray
    total: np.ndarray
    squares: np.ndarray

    @property
    def centres(self) -> np.ndarray:
        return self.total / np.maximum(self.n, 1)[:, None]

    @property
    def spread(self) -> np.ndarray:
        """Sum of squared distances from the centre."""
        centre = self.centres
        return np.maximum(self.squares - self.n * np.einsum("ij,ij->i", centre, centre), 0)

    def only(self, which: np.ndarray) -> Groups:
        return Groups(self.n[which], self.total[which], self.squares[which])


def criterion(n: np.ndarray, spread: float, dim: int, least: float, usual: float | None = None) -> float:
    """Of groups of sizes ``n`` with squared distances ``spread`` in all.  With
    ``usual``, a variance known from elsewhere, as if USUAL_ROWS more rows had it."""
    rows, groups = n.sum(), len(n)
    more = 0 if usual is None else USUAL_ROWS
    variance = max((spread / dim + more * (usual or 0.0)) / max(rows - groups + more, 1), least)
    fit = float((n * np.log(np.maximum(n, 1) / rows)).sum()) - rows * dim / 2 * np.log(variance) - spread / variance / 2
    return fit - (groups * dim + groups) / 2 * np.log(rows)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre, the first of equal ones."""
    half = np.einsum("ij,ij->i", centres, centres) / 2
    step = max(1, _CELLS // len(centres))
    parts = [(points[at : at + step] @ centres.T - half).argmax(axis=1) for at in range(0, len(points), step)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _means(points: np.ndarray, centres: np.ndarray) -> tuple[float, np.ndarray]:
    """(squared distances in all, group of each row) after a few rounds of k-means."""
    of = None
    for _ in range(8):
        now = nearest(points, centres)
        if of is not None and (now == of).all():
            break
        of = now
        sizes = np.bincount(of, minlength=len(centres))
        met = sizes > 0
        by = np.argsort(of, kind="stable")
        centres = centres.copy()
        centres[met] = np.add.reduceat(points[by], (np.cumsum(sizes) - sizes)[met], axis=0) / sizes[met][:, None]
    return float(((points - centres[of]) ** 2).sum()), of


def _spread_out(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows, each likelier the farther it is from those before (k-means++)."""
    chosen = [int(rng.integers(len(points)))]
    apart = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and apart.sum() > 0:
        chosen.append(int(rng.choice(len(points), p=apart / apart.sum())))
        apart = np.minimum(apart, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _starts(part: np.ndarray, rng: np.random.Generator) -> Iterator[list[np.ndarray]]:
    """Centres to start from: pairs first, then twice as many each time, as many
    groups in as many directions look like one round group when cut in two."""
    centre = part.mean(axis=0)
    away = part - centre
    lengths = np.einsum("ij,ij->i", away, away)
    far = part[lengths.argmax()]
    farther = part[((part - far) ** 2).sum(axis=1).argmax()]
    axis = away[lengths.argmax()]
    for _ in range(5):
        axis = away.T @ (away @ axis)
        axis /= np.linalg.norm(axis) or 1.0
    width = np.sqrt((away @ axis).var()) * axis
    yield [np.stack([far, farther]), np.stack([centre + width, centre - width]), _spread_out(part, 2, rng)]
    k = 4
    while k <= min(MOST_AT_ONCE, len(part) // 3):
        yield [_spread_out(part, k, rng)]
        k *= 2


def propose(points: np.ndarray, least: float, rng: np.random.Generator) -> list[np.ndarray]:
    """Centres of the groups that ``points`` fall into, one if they don't."""
    done, open_ = [], [points]
    while open_:
        part = open_.pop()
        centre = part.mean(axis=0)
        spread = float(((part - centre) ** 2).sum())
        split = None
        if len(part) >= 4 and spread > 0:
            whole = criterion(np.array([len(part)]), spread, part.shape[1], least)
            for starts in _starts(part, rng):
                found, of = min((_means(part, s) for s in starts), key=lambda f: f[0])
                sizes = np.bincount(of)
                sizes = sizes[sizes > 0]
                if len(sizes) > 1 and criterion(sizes, found, part.shape[1], least) > whole:
                    split = of
                    break
        if split is None:
            done.append(centre)
        else:
            open_ += [part[split == k] for k in np.unique(split)]
    return done


def _measure(centres: np.ndarray, sample: int, wanted: np.ndarray) -> callable:
    """Sums of each cluster and sampled rows of the wanted ones within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centres.shape
        n, total, squares = np.zeros(k, dtype=np.int64), np.zeros((k, dim)), np.zeros(k)
        kept, order, of = np.zeros((0, dim)), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            points = _matrix(batch.column(0))
            if not len(points):
                continue
            cluster = nearest(points, centres)
            n += np.bincount(cluster, minlength=k)
            squares += np.bincount(cluster, np.einsum("ij,ij->i", points, points), minlength=k)
            by = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[by], prepend=-1))
            total[cluster[by][first]] += np.add.reduceat(points[by], first, axis=0)
            asked = wanted[cluster]
            kept, of = np.concatenate([kept, points[asked]]), np.concatenate([of, cluster[asked]])
            order = np.concatenate([order, batch.column(1).to_numpy()[asked]])
            few = np.lexsort((order, of))
            few = few[np.arange(len(few)) - np.searchsorted(of[few], of[few], "left") < sample]
            kept, order, of = kept[few], order[few], of[few]
        met = np.flatnonzero(n)
        nothing, vectors = pa.nulls(len(of), pa.int64()), [total[met], kept]
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(met) + len(of) + 1, dtype=np.int32) * dim), pa.array(np.concatenate(vectors).ravel())
        )
        columns = [
            pa.array(np.concatenate([met, of])), pa.concat_arrays([pa.array(n[met]), nothing]),
            pa.array(np.concatenate([squares[met], np.zeros(len(of))])), pa.array(np.concatenate([np.zeros(len(met), dtype=np.int64), order])), lists,
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "squares", "place", "vector"])

    return run


def _round(rows: DataFrame, centres: np.ndarray, wanted: np.ndarray, single: bool) -> tuple[Groups, dict[int, np.ndarray]]:
    """Sums of each cluster over all rows, and a sample of each wanted one, which
    is ``single`` where the vectors are."""
    k, dim = centres.shape
    sample = max(LEAST_SAMPLE, SAMPLE_ROWS // k)
    schema = "cluster long, n long, squares double, place long, vector array<double>"
    parts = rows.mapInArrow(_measure(centres, sample, wanted), schema)
    # Sums are rows with n; a sampled row has none.
    is_sum = F.col("n").isNotNull()
    grouped = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("squares").alias("squares"),
        Summarizer.sum(array_to_vector("vector"), F.when(is_sum, 1.0).otherwise(0.0)).alias("total"),
        F.slice(F.array_sort(F.collect_list(F.when(~is_sum, F.struct("place", "vector")))), 1, sample)["vector"].alias("sample"),
    )
    grouped = grouped.withColumn("sample", F.col("sample").cast("array<array<float>>" if single else "array<array<double>>"))
    groups = Groups(np.zeros(k, dtype=np.int64), np.zeros((k, dim)), np.zeros(k))
    samples = {}
    # Arrow carries a number in its own width, rows would take nine bytes for each.
    found = grouped.withColumn("total", vector_to_array("total")).toArrow()
    clusters = found.column("cluster").to_pylist()
    for name in ("n", "squares"):
        getattr(groups, name)[clusters] = found.column(name).to_numpy()
    for c, total, sample in zip(clusters, found.column("total"), found.column("sample")):
        groups.total[c] = total.values.to_numpy()
        if wanted[c]:
            samples[c] = sample.values.flatten().to_numpy().astype(np.float64).reshape(-1, dim)
    return groups, samples


def _joined(groups: Groups, parent: np.ndarray, least: float) -> tuple[Groups, np.ndarray, np.ndarray]:
    """Clusters after joining, again and again, the near pair that gains most by
    it; their parents, and which were joined."""
    n, total, squares = groups.n.copy(), groups.total.copy(), groups.squares.copy()
    dim = total.shape[1]
    alive = n > 0
    joined = np.zeros(len(n), dtype=bool)
    usual = groups.spread.sum() / (dim * max(n.sum() - alive.sum(), 1))
    while alive.sum() > 1:
        at = np.flatnonzero(alive)
        now = Groups(n[at], total[at], squares[at])
        centres, spread = now.centres, now.spread
        norms = np.einsum("ij,ij->i", centres, centres)
        apart = norms[:, None] + norms - 2 * centres @ centres.T
        np.fill_diagonal(apart, np.inf)
        other = apart.argmin(axis=1)
        done = np.zeros(len(at), dtype=bool)
        # Nearest pairs first; a cluster joins once in a sweep.
        for i in np.argsort(apart.min(axis=1), kind="stable"):
            j = other[i]
            if done[i] or done[j]:
                continue
            both = now.n[i] + now.n[j]
            whole = spread[i] + spread[j] + now.n[i] * now.n[j] / both * max(apart[i, j], 0)
            apart_fit = criterion(np.array([now.n[i], now.n[j]]), spread[i] + spread[j], dim, least, usual)
            if criterion(np.array([both]), whole, dim, least, usual) >= apart_fit:
                a, b = at[i], at[j]
                n[a], total[a], squares[a] = n[a] + n[b], total[a] + total[b], squares[a] + squares[b]
                alive[b], joined[a], done[i], done[j] = False, True, True, True
        if not done.any():
            break
    return Groups(n[alive], total[alive], squares[alive]), parent[alive], joined[alive]


def find_centres(rows: DataFrame, vector_col: str = "embedding", seed: int = 42) -> np.ndarray:
    """Centres of the groups of ``rows``, however many there are.

    ``rows`` is read once a round and should be held; null vectors must have gone.
    A group that makes up less of a cluster than its sample shows is found, if at
    all, when the cluster around it has become small.
    """
    vectors = rows.select(F.col(vector_col).cast("array<double>").alias("vector"))
    vectors = vectors.withColumn("place", F.xxhash64("vector", F.lit(seed)))
    single = rows.select(vector_col).dtypes[0][1] == "array<float>"
    dim = vectors.select(F.size("vector")).first()[0]
    rng = np.random.default_rng(seed)
    groups, samples = _round(vectors, np.zeros((1, dim)), np.ones(1, dtype=bool), single)
    least = max(FLAT * groups.spread.sum() / (dim * max(groups.n.sum(), 1)), 1e-300)
    centres, settled = groups.centres, np.zeros(1, dtype=bool)
    for _ in range(MAX_ROUNDS):
        children, parents = [], []
        for c in range(len(centres)):
            found = [centres[c]] if settled[c] or c not in samples else propose(samples[c], least, rng)
            children += found
            parents += [c] * len(found)
        if len(children) == len(centres):
            break
        groups, _ = _round(vectors, np.stack(children), np.zeros(len(children), dtype=bool), single)
        # A cluster whose parts are joined again is not tried once more.
        after, parent, joined = _joined(groups, np.array(parents), least)
        alone = np.bincount(parent, minlength=len(centres))[parent] == 1
        settled = (joined & alone) | settled[parent]
        centres = after.centres
        groups, samples = _round(vectors, centres, ~settled, single)
        centres = groups.centres
    final, _, _ = _joined(groups, np.arange(len(centres)), least)
    return final.centres


def cluster_of(vector_col: str, centres: np.ndarray) -> Column:
    """The nearest centre's index."""

    @F.arrow_udf("int")
    def find(vectors: pa.Array) -> pa.Array:
        return pa.array(nearest(_matrix(vectors), centres), pa.int32())

    return find(F.col(vector_col))
