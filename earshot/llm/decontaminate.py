"""Benchmark passages in training text, by a positional inverted index.

The index is sharded by documents: a shard holds, for some hundred texts, the
positions of every word that the tests use, word by word.  Words are counted
over the whole corpus first.  A window of ``WINDOW`` test words is then looked
up rarest word first: its places, moved back by the word's offset, are the
candidate starts, and each further word's places, moved likewise, are
intersected with them.  A shard answers for its own texts, so no word, however
common, is gathered in one place.

A proximity match is a window of which at least ``NEAR_WORDS`` of its words
stand within ``SLOP`` words of their places in one text.  One of its
``WINDOW - NEAR_WORDS + 1`` rarest words is among them, so starts are tried
around the places of each of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm import tokens
from earshot.llm.memory import giving_back
from earshot.llm.tables import if_small, keep, text_of

WINDOW = 10
# Test words and windows that one round of lookups sends to every task.  A
# larger benchmark is answered in several rounds over the same index.
ROUND_WORDS = 2_000_000
# Candidate starts of a shard that are intersected in one go.
CANDIDATES = 1 << 20
# Texts of a shard at most; it is closed sooner after SLICE_BYTES of text.
SHARD_TEXTS = 512
NEAR_WORDS, SLOP = 8, 2
# Names that given tables do not have.
_GONE = ("_contaminated_1", "_contaminated_2")

_POSTINGS = "n_words array<long>, terms binary, counts binary, positions binary"
_FOUND = "n_words long, items array<string>, n_near long, starts array<long>, ends array<long>"


@dataclass
class Tests:
    """Windows of benchmark items over the words of one round."""

    terms: np.ndarray  # sorted distinct word hashes
    window_terms: np.ndarray  # (windows, WINDOW) index into terms; -1 beyond a short item's end
    item: np.ndarray  # number of the item that a window belongs to
    names: list[str]  # item ids


def _windows(batch_ids: list, texts: list[str | None]) -> Tests:
    found = tokens.text_words(texts, tokens.ALPHANUMERIC)
    terms, index = np.unique(found.hashes, return_inverse=True)
    counts = found.counts
    n_windows = np.where(counts >= WINDOW, counts - WINDOW + 1, np.minimum(counts, 1))
    item = np.repeat(np.arange(len(counts)), n_windows)
    start = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + found.first[item]
    length = np.minimum(counts[item], WINDOW)
    places = start[:, None] + np.arange(WINDOW)[None, :]
    inside = np.arange(WINDOW)[None, :] < length[:, None]
    of = np.where(inside, np.concatenate([index, np.zeros(WINDOW, dtype=index.dtype)])[places], -1)
    rows, first = np.unique(np.column_stack([item, of]), axis=0, return_index=True) if len(of) else (of, [])
    first = np.sort(first).astype(np.int64)
    return Tests(terms, of[first].astype(np.int32), item[first].astype(np.int32), ["" if i is None else str(i) for i in batch_ids])


def _rounds(items: DataFrame) -> Iterator[Tests]:
    """Tests of at most ROUND_WORDS words, item by item."""
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        words = (row["text"] or "").count(" ") + 1
        if ids and size + words > ROUND_WORDS:
            yield _windows(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += words
    yield _windows(ids, texts)


def _shards(terms: np.ndarray):
    """Postings of ``terms``, shard by shard.  Positions count on through the
    shard's texts, one left free between two, so no window spans both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in tokens.slices(batch.column(1)):
                found = tokens.words(data, bounds, tokens.ALPHANUMERIC)
                for low in range(0, len(bounds) - 1, SHARD_TEXTS):
                    high = min(low + SHARD_TEXTS, len(bounds) - 1)
                    counts = found.counts[low:high]
                    hashes = found.hashes[found.first[low] : found.first[high]]
                    place = np.arange(len(hashes)) + np.repeat(np.arange(high - low), counts)
                    index = np.searchsorted(terms, hashes)
                    index[index == len(terms)] = 0
                    wanted = terms[index] == hashes if len(terms) else np.zeros(len(hashes), dtype=bool)
                    index, place = index[wanted], place[wanted]
                    order = np.argsort(index, kind="stable")
                    used, n = np.unique(index, return_counts=True)
                    ids = batch.column(0).slice(at + low, high - low)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([counts], pa.list_(pa.int64())),
                            *(pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (used, n, place[order])),
                        ],
                        ["ids", "n_words", "terms", "counts", "positions"],
                    )

    return run


def _frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    """How often each term occurs in the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            for used, n in zip(batch.column(0), batch.column(1)):
                total[_ints(used)] += _ints(n)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    counted = index.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = np.zeros(n_terms, dtype=np.int64)
    found = counted.toArrow()  # a row for each test word of the round at most
    total[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return total


def _ints(scalar: pa.Scalar) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer(), dtype=np.int32)


class _Postings:
    """One shard's lists of positions."""

    def __init__(self, n_terms: int, used: np.ndarray, n: np.ndarray, positions: np.ndarray, span: int):
        self.positions = positions
        self.n = np.zeros(n_terms + 1, dtype=np.int64)
        self.n[used] = n
        self.first = np.zeros(n_terms + 1, dtype=np.int64)
        self.first[used] = np.cumsum(n) - n
        # Which term stands at a position; -2 where no test word does.
        self.term_at = np.full(span + 2 * WINDOW + 2 * SLOP, -2, dtype=np.int32)
        self.term_at[positions + WINDOW] = np.repeat(used, n)

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether ``places`` are in the lists of ``terms``."""
        return self.term_at[places + WINDOW] == terms


def _occurrences(
    tests: Tests, order: np.ndarray, postings: _Postings, windows: np.ndarray, nth: int, size: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, place of its nth rarest word) for all places, about ``size`` in one go."""
    terms = tests.window_terms[windows, order[windows, nth]]
    n = postings.n[terms]
    ends = np.cumsum(n)
    low = 0
    while low < len(n):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + size, side="right")))
        at = np.repeat(np.arange(low, high), n[low:high])
        if len(at):
            within = np.arange(len(at)) - np.repeat(np.cumsum(n[low:high]) - n[low:high], n[low:high])
            yield windows[at], postings.positions[postings.first[terms[at]] + within]
        low = high


def _exact(tests: Tests, order: np.ndarray, postings: _Postings, window: np.ndarray, place: np.ndarray):
    """Intersect the lists of the further words, rarest first."""
    start = place - order[window, 0]
    for k in range(1, WINDOW):
        offset = order[window, k]
        term = tests.window_terms[window, offset]
        stay = (term < 0) | postings.has(term, start + offset)
        window, start = window[stay], start[stay]
    return window, start


def _near(tests: Tests, order: np.ndarray, postings: _Postings, first: np.ndarray, counts: np.ndarray):
    """(text, item) of windows with NEAR_WORDS of their words within SLOP of
    their places.  A start is tried by the first of the rarest words that is met."""
    steps, may_miss = np.arange(-SLOP, SLOP + 1), WINDOW - NEAR_WORDS
    full = tests.window_terms[:, -1] >= 0
    for nth in range(may_miss + 1):
        there = postings.n[np.take_along_axis(tests.window_terms, order[:, nth : nth + 1], axis=1)[:, 0]] > 0
        windows = np.flatnonzero(full & there)
        windows = windows[(postings.n[tests.window_terms[windows]] == 0).sum(axis=1) <= may_miss]
        for window, place in _occurrences(tests, order, postings, windows, nth, CANDIDATES // len(steps)):
            start = ((place - order[window, nth])[:, None] + steps[None, :]).ravel()
            text = np.repeat(np.searchsorted(first, place, side="right") - 1, len(steps))
            window = np.repeat(window, len(steps))
            missed = np.zeros(len(window), dtype=np.int64)
            for k in range(WINDOW):
                if k == nth:
                    continue
                offset = order[window, k]
                term = tests.window_terms[window, offset]
                low, high = first[text], first[text] + counts[text]
                close = np.zeros(len(window), dtype=bool)
                for step in steps:
                    at = start + offset + step
                    close |= postings.has(term, np.clip(at, low, high - 1)) & (at >= low) & (at < high)
                missed += ~close
                stay = (missed <= may_miss) & (~close if k < nth else True)
                window, start, text, missed = window[stay], start[stay], text[stay], missed[stay]
            yield text, tests.item[window]


def _ranges(edge: np.ndarray, first: np.ndarray, counts: np.ndarray):
    """Maximal runs of covered words as (text, start, end), by text."""
    inside = np.cumsum(edge[:-1]) > 0
    steps = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    text = np.searchsorted(first, starts, side="right") - 1
    return text, starts - first[text], ends - first[text]


def _lists(text: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Values of each text as a list; ``text`` is sorted."""
    offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _lookup(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, order = shared.value
        n_items, names = len(tests.names), pa.array(tests.names, pa.string())
        for batch in batches:
            for ids, words, used, n, positions in zip(*(batch.column(k) for k in range(5))):
                counts = np.asarray(words.as_py(), dtype=np.int64)
                first = np.cumsum(counts + 1) - (counts + 1)
                span = int((counts + 1).sum())
                postings = _Postings(len(tests.terms), _ints(used), _ints(n), _ints(positions), span)
                text_of = lambda places: np.searchsorted(first, places, side="right") - 1  # noqa: B023, E731
                edge = np.zeros(span + 1, dtype=np.int64)
                exact, near = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
                for window, place in _occurrences(tests, order, postings, np.arange(len(order)), 0, CANDIDATES):
                    hit, start = _exact(tests, order, postings, window, place)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + (tests.window_terms[hit] >= 0).sum(axis=1), -1)
                    exact.append(np.unique(text_of(start) * n_items + tests.item[hit]))
                for text, item in _near(tests, order, postings, first, counts):
                    near.append(np.unique(text * n_items + item))
                pairs, closes = np.unique(np.concatenate(exact)), np.unique(np.concatenate(near))
                text, starts, ends = _ranges(edge, first, counts)
                items = _lists(pairs // n_items, pairs % n_items, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values, pa.array(counts),
                        pa.ListArray.from_arrays(items.offsets, names.take(items.values)),
                        pa.array(np.bincount(closes // n_items, minlength=len(counts)).astype(np.int64)),
                        _lists(text, starts, len(counts)), _lists(text, ends, len(counts)),
                    ],
                    ["id", "n_words", "items", "n_near", "starts", "ends"],
                )

    return run


def _join_rounds(found: list[DataFrame]) -> DataFrame:
    """One row for each text of what several rounds have found."""
    if len(found) == 1:
        return found[0]
    together = reduce(DataFrame.unionByName, found)
    flat = lambda name: F.flatten(F.collect_list(name)).alias(name)
    ranges = F.collect_list(F.arrays_zip("starts", "ends"))
    joined = together.groupBy("id").agg(
        F.max("n_words").alias("n_words"), flat("items"), F.sum("n_near").alias("n_near"),
        F.array_sort(F.flatten(ranges)).alias("ranges"),
    )
    state = "array<struct<starts:bigint,ends:bigint>>"

    def merge(done, r):
        last = F.element_at(done, -1)
        widened = F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], r["ends"]).alias("ends"))
        return (
            F.when((F.size(done) > 0) & (r["starts"] <= last["ends"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(widened)))
            .otherwise(F.concat(done, F.array(r)))
            .cast(state)
        )

    merged = joined.withColumn("ranges", F.aggregate("ranges", F.array().cast(state), merge))
    return merged.withColumns({"starts": F.col("ranges.starts"), "ends": F.col("ranges.ends")}).drop("ranges")


def find_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, n_near, starts, ends) for each row.

    ``items`` are the ids, as text, sorted, of the items with a window of
    ``WINDOW`` words in the text; an item of fewer words, but not none, is one
    window.  ``starts`` and ``ends`` are the runs of hit words, counted from 0,
    and ``n_hit`` their number.  ``n_near`` counts items with proximity
    matches, exact ones among them.

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; a null item id is written as empty text.  Repeated rows and null
    ids stay as they are; other columns are ignored.
    """
    given = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    context = documents.sparkSession.sparkContext
    id_type = given.schema["doc_id"].dataType.simpleString()
    rounds = _rounds(items)
    first, second = next(rounds), next(rounds, None)
    if second is None:
        asked, key = given.withColumnRenamed("doc_id", "id"), id_type
        rounds = iter([first])
    else:
        numbered = keep(given.withColumn("id", F.monotonically_increasing_id()), "numbered")
        asked, key = numbered.select("id", "text"), "long"
        rounds = chain([first, second], rounds)
    found = []
    for tests in rounds:
        index = keep(asked.mapInArrow(giving_back(_shards(tests.terms)), f"ids array<{key}>, {_POSTINGS}"), "postings")
        counts = _frequencies(index, len(tests.terms))
        # Rarest word first; what a short item lacks comes last.
        of = np.where(tests.window_terms >= 0, np.append(counts, 0)[tests.window_terms], np.iinfo(np.int64).max)
        order = np.argsort(of, axis=1, kind="stable")
        shared = context.broadcast((tests, order))
        found.append(index.mapInArrow(giving_back(_lookup(shared)), f"id {key}, {_FOUND}"))
    if second is None:
        joined = found[0].withColumnRenamed("id", "doc_id")
    else:
        joined = _join_rounds(found).join(numbered.select("id", "doc_id"), "id")
    return joined.select(
        "doc_id", "n_words",
        F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, r: n + r["ends"] - r["starts"]).alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"), "n_near", "starts", "ends",
    )


def benchmark_digests(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near)."""
    found = find_benchmark(documents, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near",
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns kept, whose text holds no window of the benchmark.

    Rows without id are judged by their text as well.
    """
    # The text's hash stands for the id: rows of one text are judged alike.
    hashed = [F.xxhash64(text_of(text_col)).alias("h1"), F.xxhash64(F.lit(23), text_of(text_col)).alias("h2")]
    keyed = documents.select(F.struct(*hashed).alias("doc_id"), F.col(text_col).alias("text"))
    found = find_benchmark(keyed, benchmark).where("n_hit > 0").select("doc_id.h1", "doc_id.h2").distinct()
    gone = keep(found.withColumnsRenamed({"h1": _GONE[0], "h2": _GONE[1]}), "contaminated")
    same = [F.xxhash64(text_of(text_col)) == F.col(_GONE[0]), F.xxhash64(F.lit(23), text_of(text_col)) == F.col(_GONE[1])]
    return documents.join(if_small(gone), same, "left_anti")
