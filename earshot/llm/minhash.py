"""Near-duplicate documents by MinHash.

1. One pass over the texts: the set of word shingles (64-bit hashes), a digest
   of the set, ``MINIMA`` minima of universal hash functions, and the keys of
   ``BANDS`` bands of them.  Equal sets collapse to their smallest id.
2. Loose groups, by signatures alone: in each band bucket every set is compared
   with the bucket's smallest id, groups are the connected components of pairs
   that agree at ``LEAST_EQUAL`` minima, and buckets that hold several groups
   are searched for one agreeing pair between any two of them.  After that,
   every agreeing pair that shares a bucket lies within one group.
3. Links, on full sets: each set of a loose group is compared with the group's
   smallest id.  Where that leaves a group in several components, the sets
   outside its largest component are compared with all others, block by block;
   a task compares two blocks and returns at most a forest of links.
4. Components of the links, by alternating large-star and small-star.

No pairs are formed inside a component, which is nearly all of them in a group
of copies, and pairs that fail leave no rows.  Two sets of similarity 0.8 share
no bucket with probability 5e-8, and agree at fewer than ``LEAST_EQUAL`` minima
with probability 3e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm import tokens
from earshot.llm.components import connected_components
from earshot.llm.memory import giving_back
from earshot.llm.tables import if_small, keep, release

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
# Minima kept as one byte each must agree at so many places before sets are read.
LEAST_EQUAL = 80
# Sets that one task compares with as many others.
BLOCK = 1024

_RANDOM = np.random.default_rng(7919)
_FACTORS = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64)

# A name that given tables do not have.
_ID = "_near_duplicate_id"

PROFILE = "doc_id long, n_shingles long, digest binary, bands array<long>, minima binary"


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingles, where each text's begin)."""
    for at, data, bounds in tokens.slices(column):
        shingles, first = tokens.runs(tokens.words(data, bounds, tokens.NOT_SPACE), width)
        for begin, end in zip(first[:-1], first[1:]):
            shingles[begin:end].sort()
        new = np.ones(len(shingles), dtype=bool)
        new[1:] = shingles[1:] != shingles[:-1]
        new[first[:-1][first[:-1] < len(shingles)]] = True
        seen = np.concatenate([[0], np.cumsum(new)])
        yield at, shingles[new], seen[first]


def _signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts with shingles, MINIMA): minima of a * x + b mod 2**64, upper half."""
    begins = first[:-1][np.diff(first) > 0]
    minima = np.empty((len(begins), MINIMA), dtype=np.uint32)
    if len(begins):
        for k in range(MINIMA):
            values = shingles * _FACTORS[k] + _SHIFTS[k]
            minima[:, k] = np.minimum.reduceat(values, begins) >> np.uint64(32)
    return minima


def _band_keys(minima: np.ndarray) -> np.ndarray:
    total = np.arange(BANDS, dtype=np.uint64)[None, :]
    for r in range(ROWS):
        total = tokens.mix(total * np.uint64(0x9FB21C651E98DF25) + minima[:, r::ROWS])
    return total.view(np.int64)


def _binaries(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _profiles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, shingles, first in _sets(batch.column(1), width):
                counts = np.diff(first)
                minima = _signatures(shingles, first)
                keys, small = _band_keys(minima), minima.astype(np.uint8)
                place = np.cumsum(counts > 0) - 1
                full = counts > 0
                raw = shingles.tobytes()
                digests = [
                    hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
                    for a, b in zip(first[:-1].tolist(), first[1:].tolist())
                ]
                bands = [keys[p] if f else None for p, f in zip(place, full)]
                signs = [small[p].tobytes() if f else None for p, f in zip(place, full)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(counts)), pa.array(counts, pa.int64()),
                        _binaries(digests), pa.array(bands, pa.list_(pa.int64())), _binaries(signs),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "minima"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, shingles, first in _sets(batch.column(1), width):
                raw = shingles.tobytes()
                sets = [raw[8 * a : 8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), _binaries(sets)], ["doc_id", "shingles"]
                )

    return run


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, width)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree at LEAST_EQUAL places."""
    for batch in batches:
        if not batch.num_rows:
            continue
        u, v = (_fixed(batch.column(k), MINIMA) for k in (2, 3))
        near = (u == v).sum(axis=1) >= LEAST_EQUAL
        yield batch.select([0, 1]).filter(pa.array(near))


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, dtype=bool)
            for k, (u, v) in enumerate(zip(batch.column(2), batch.column(3))):
                a, b = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (u, v))
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                linked[k] = 100 * shared >= percent * (len(both) - shared)
            yield batch.select([0, 1]).filter(pa.array(linked))

    return run


class _Forest:
    """Union-find over the components that a task sees."""

    def __init__(self, components: np.ndarray):
        names, self.of = np.unique(components, return_inverse=True)
        self.root = np.arange(len(names))

    def components(self) -> np.ndarray:
        """Component number of each row."""
        while True:
            above = self.root[self.root]
            if (above == self.root).all():
                return self.root[self.of]
            self.root = above

    def join(self, row: int, others: np.ndarray) -> np.ndarray:
        """Join ``row`` with ``others``; of each component met, its first row."""
        now = self.components()
        met, first = np.unique(now[others], return_index=True)
        met, first = met[met != now[row]], others[first[met != now[row]]]
        self.root[met] = now[row]
        return first


def _forest_table(ids: np.ndarray, found: list[tuple[int, np.ndarray]]) -> pa.Table:
    u = np.concatenate([np.full(len(rows), ids[row]) for row, rows in found]) if found else np.zeros(0, dtype=np.int64)
    v = np.concatenate([ids[rows] for _, rows in found]) if found else np.zeros(0, dtype=np.int64)
    return pa.table({"u": u, "v": v}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def _agreeing_across(table: pa.Table) -> pa.Table:
    """One agreeing pair for components of a bucket that have any; between two
    blocks of a bucket (``part`` 0 and 1), or within one."""
    ids, part = (table.column(c).to_numpy() for c in ("doc_id", "part"))
    signs = _fixed(table.column("minima").combine_chunks(), MINIMA)
    forest, found = _Forest(table.column("component").to_numpy()), []
    for row in range(len(ids)):
        now = forest.components()
        others = np.flatnonzero((now != now[row]) & ((part != part[row]) | (not part.any())))
        others = others[(signs[others] == signs[row]).sum(axis=1) >= LEAST_EQUAL]
        if len(others):
            found.append((row, forest.join(row, others)))
    return _forest_table(ids, found)


def _linked_across(percent: int):
    """Links of sets outside (``part`` 0) with all sets (1), other components."""

    def run(table: pa.Table) -> pa.Table:
        ids, part = (table.column(c).to_numpy() for c in ("doc_id", "part"))
        sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in table.column("shingles")]
        every, outside = np.flatnonzero(part == 1), np.flatnonzero(part == 0)
        if not len(every) or not len(outside):
            return _forest_table(ids, [])
        size = np.array([len(s) for s in sets])
        known, codes = np.unique(np.concatenate([sets[r] for r in every]), return_inverse=True)
        begins = np.cumsum(size[every]) - size[every]
        forest, found = _Forest(table.column("component").to_numpy()), []
        marked = np.zeros(len(known) + 1, dtype=np.int32)
        for row in outside.tolist():
            now = forest.components()
            if (now[every] == now[row]).all():
                continue
            index = np.searchsorted(known, sets[row])
            index[index == len(known)] = 0
            index = index[known[index] == sets[row]]
            marked[index] = 1
            shared = np.add.reduceat(marked[codes], begins)
            marked[index] = 0
            linked = 100 * shared >= percent * (size[row] + size[every] - shared)
            others = every[linked & (now[every] != now[row])]
            if len(others):
                found.append((row, forest.join(row, others)))
        return _forest_table(ids, found)

    return run


def _blocks(count: Column) -> Column:
    return F.ceil(count / BLOCK).cast("int")


def _in_blocks(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id"), blocks).cast("int")


def _agreeing_groups(sets: DataFrame) -> DataFrame:
    """(node, component): loose groups of two and more sets."""
    exploded = sets.select("doc_id", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.min("doc_id").alias("v"), F.count("*").alias("n")).where("n > 1")
    buckets = keep(exploded.join(shared.drop("n"), "key").select("key", "doc_id", "v"), "buckets")
    pairs = buckets.where("doc_id <> v").select(F.col("doc_id").alias("u"), "v").distinct()
    for side in ("u", "v"):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(side), F.col("minima").alias(f"minima_{side}")), side)
    near = pairs.select("u", "v", "minima_u", "minima_v").mapInArrow(_agreeing, "u long, v long")
    groups = connected_components(near)

    known = groups.withColumnsRenamed({"node": "doc_id"})
    members = buckets.join(known, "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    mixed = (
        members.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .where(F.col("low") < F.col("high"))
        .select("key", _blocks(F.col("n")).alias("blocks"))
    )
    met = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(
            F.least("block", j).alias("i"), F.greatest("block", j).alias("j"), (j < F.col("block")).cast("int").alias("part")
        ),
    )
    rows = (
        members.join(mixed, "key")
        .withColumn("block", _in_blocks(F.col("blocks")))
        .join(sets.select("doc_id", "minima"), "doc_id")
        .select("key", "doc_id", "component", "minima", F.inline(met))
    )
    across = keep(rows.groupBy("key", "i", "j").applyInArrow(_agreeing_across, "u long, v long").distinct(), "across")
    if not across.take(1):
        return groups
    stars = groups.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return connected_components(stars.unionByName(across))


def _links(groups: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(u, v): links on full sets that connect what is linked in each group."""
    stars = groups.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    for side in ("u", "v"):
        stars = stars.join(full.withColumnsRenamed({"doc_id": side, "shingles": f"set_{side}"}), side)
    stars = stars.select("u", "v", "set_u", "set_v").mapInArrow(giving_back(_similar(percent)), "u long, v long")
    stars = keep(stars, "star-links")

    # A star is its own component; all sets that it did not reach are singles.
    reached = stars.select(F.col("u").alias("doc_id")).distinct().withColumn("reached", F.lit(True))
    members = groups.withColumnsRenamed({"node": "doc_id", "component": "group"}).join(reached, "doc_id", "left")
    inside = F.coalesce("reached", F.col("doc_id") == F.col("group"))
    members = members.select("group", "doc_id", inside.alias("inside"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n"), F.count_if(~F.col("inside")).alias("n_out"))
    open_ = sizes.where("n_out > 0").select(
        "group", _blocks(F.col("n")).alias("blocks"), _blocks(F.col("n_out")).alias("blocks_out")
    )
    rows = members.join(open_, "group").withColumns(
        {"i": _in_blocks(F.col("blocks_out")), "j": _in_blocks(F.col("blocks"))}
    )
    part = lambda rows, number: rows.withColumns(
        {"part": F.lit(number), "component": F.when(F.col("inside"), F.col("group")).otherwise(F.col("doc_id"))}
    ).select("group", "i", "j", "doc_id", "component", "part")
    last = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    outside = part(rows.where(~F.col("inside")).withColumn("j", last("blocks")), 0)
    every = part(rows.withColumn("i", last("blocks_out")), 1)
    met = outside.unionByName(every).join(full, "doc_id")
    across = met.groupBy("group", "i", "j").applyInArrow(_linked_across(percent), "u long, v long")
    return stars.unionByName(across)


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity_percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row for each row given.

    A text's set is its distinct shingles of ``words`` words, the whole text
    where it has fewer, nothing where it has none (null texts too): such rows
    are linked with nothing.  Two sets are linked when 100 * shared is at least
    ``similarity_percent`` (80 or more) * together.  ``component_id`` is the
    smallest id that links reach; ``kept`` marks the row of that id.

    Rows of one id are one document: they share a component, each with its own
    ``n_shingles``.  A row without id is linked with nothing, has a null
    component and is kept.  Other columns are ignored.
    """
    if not 80 <= similarity_percent <= 100:
        raise ValueError("similarity_percent must be from 80 to 100")
    given = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = keep(given.mapInArrow(giving_back(_profiles(words)), PROFILE), "profiles")
    usable = profile.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = keep(usable.groupBy("digest").agg(F.min("doc_id").alias("v"), F.count("*").alias("n")), "digests")
    copies = (
        usable.select("doc_id", "digest").join(first.where("n > 1"), "digest").select(F.col("doc_id").alias("u"), "v")
    )
    repeated = bool(usable.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").take(1))
    sets = usable.join(first.select(F.col("v").alias("doc_id")), "doc_id", "left_semi")
    sets = sets.select("doc_id", "bands", "minima")
    sets = keep(sets.distinct() if repeated else sets, "distinct-sets")

    groups = keep(_agreeing_groups(sets), "groups")
    asked = given.join(if_small(groups.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    full = asked.mapInArrow(giving_back(_full_sets(words)), "doc_id long, shingles binary")
    full = keep(full.distinct() if repeated else full, "full-sets")
    links = _links(groups, full, similarity_percent).unionByName(copies.where("u <> v").distinct())
    components = connected_components(links)
    release(first, sets, groups, full)

    known = components.withColumnsRenamed({"node": "doc_id", "component": "reached"})
    component = F.coalesce("reached", "doc_id")
    return profile.select("doc_id", "n_shingles").join(known, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one document of each group, all columns kept.

    Repeated rows of an id are one document, of which one row stays.
    """
    found = near_duplicates(documents, id_col, text_col)
    once = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    odd = keep(once.where("doc_id IS NOT NULL AND (NOT kept OR n > 1)").select(F.col("doc_id").alias(_ID), "kept"), "odd")
    same = F.col(id_col).cast("long") == F.col(_ID)
    stay = documents.join(if_small(odd.select(_ID)), same, "left_anti")
    repeated = odd.where("kept").select(_ID)
    if not repeated.count():
        return stay
    return stay.unionByName(documents.join(if_small(repeated), same, "left_semi").dropDuplicates([id_col]))
