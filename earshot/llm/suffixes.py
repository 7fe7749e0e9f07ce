"""Removal of long strings that stand earlier in the corpus.

A string of ``length`` bytes that also starts earlier goes wherever it stands
again; the first place stays.  Suffixes in order, with the places of their
previous and next smaller position, give the longest previous factor at a start
(the longest string from there that starts earlier as well); a start where that
is ``length`` bytes or more is covered.

Not all starts are sorted.  The smallest hash of the ``GRAM``-byte strings in
the window of a start is the start's key; equal windows have equal keys at equal
distance, and neighbouring starts mostly share the place of theirs.  Such a run
of starts is a row.  Runs whose key stands nowhere else hold no repeated string.  Of equal runs
all but the first are covered whole, without their bytes being moved.  What is
left, different runs of one key, comes together as bytes, in blocks of bounded
size, and is sorted there.  A key with more runs than a block holds is dealt to
several blocks; their uncovered windows meet once more by digest, summed up
before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm import tokens
from earshot.llm.tables import if_small, keep, release, text_of

LENGTH = 100
GRAM = 32
# Runs of a key in one block.
BLOCK_RUNS = 512
# Bytes of runs sorted together.
SORTED_BYTES = 1 << 19

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PLACE = ["doc_id", "text_key"]


def _keep(table: DataFrame, name: str) -> DataFrame:
    """Kept, and the shuffle files of that job deleted: nothing else reads them."""
    conf = table.sparkSession.conf
    before = conf.get(_CLEAN, None)
    try:
        conf.set(_CLEAN, "true")
        return keep(table, name)
    finally:
        conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)


# --- runs -------------------------------------------------------------------


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, starts) of runs of neighbouring starts of one text
    whose windows of ``length`` bytes have the first of their smallest hashes at
    the same place."""
    n, width = len(data), length - gram + 1
    if n < length:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    power, inverse = tokens._powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(tokens._BYTE_VALUES[data] * power[:n], out=sums[1:])
    hashes = tokens.mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    # The place in the low bits: of equal hashes (in the bits above) the first wins.
    low = np.uint64((1 << int(n).bit_length()) - 1)
    smallest = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        smallest = np.minimum(smallest[:-step], smallest[step:])
        reach += step
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(smallest)]
    starts = np.flatnonzero(np.arange(len(smallest)) + length <= ends)
    smallest = smallest[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (smallest[1:] != smallest[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    at = (smallest[first] & low).astype(np.int64)
    return hashes[at], starts[first], np.diff(np.append(first, len(starts)))


def _scan(length: int, gram: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in tokens.slices(batch.column(2)):
                keys, starts, sizes = runs_of(data, bounds, length, gram)
                if not len(keys):
                    continue
                text = np.searchsorted(bounds, starts, side="right") - 1
                whole = memoryview(data.tobytes())
                ends = (starts + sizes + (length - 1)).tolist()
                content = [xxhash.xxh3_64_intdigest(whole[s:e]) for s, e in zip(starts.tolist(), ends)]
                rows = pa.array(at + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)), pa.array(np.array(content, dtype=np.uint64).view(np.int64)),
                        batch.column(0).take(rows), batch.column(1).take(rows),
                        pa.array((starts - bounds[text]).astype(np.int64)), pa.array(sizes.astype(np.int32)),
                    ],
                    ["key", "content", *_PLACE, "start", "n"],
                )

    return run


# --- longest previous factors -----------------------------------------------


def smaller_neighbours(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest smaller value before and behind each value; -1 and n
    where there is none.  What lies between is no smaller, so a candidate that is
    no smaller hands on to its own candidate."""

    def nearest(values: np.ndarray) -> np.ndarray:
        found = np.arange(len(values)) - 1
        open_ = np.flatnonzero(found >= 0)
        while len(open_):
            candidates = found[open_]
            open_ = open_[(candidates >= 0) & (values[candidates] >= values[open_])]
            found[open_] = found[found[open_]]
        return found

    n = len(order)
    return nearest(order), n - 1 - nearest(order[::-1])[::-1]


def previous_factors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, source) for the suffixes ``data[starts:ends]``: the longest
    string, up to ``limit`` bytes, that a suffix shares with one of a smaller
    place, and that suffix's index (-1: none).  Suffixes are sorted by their
    first ``limit`` bytes, then by place."""
    padded = np.concatenate([data, np.zeros(limit, dtype=np.uint8)])
    suffixes = np.lib.stride_tricks.sliding_window_view(padded, limit)
    in_place = np.argsort(places, kind="stable")
    rows = np.ascontiguousarray(suffixes[starts[in_place]])
    strings = pa.FixedSizeBinaryArray.from_buffers(pa.binary(limit), len(rows), [None, pa.py_buffer(rows)])
    # Stable: of equal suffixes the one of the smallest place is first.
    sorted_ = pc.array_sort_indices(strings).to_numpy().astype(np.int64)
    order, rows = in_place[sorted_], rows[sorted_]
    before, behind = smaller_neighbours(places[order])

    def common(other: np.ndarray) -> np.ndarray:
        """Shared length of each suffix and the one at ``other`` in the order."""
        met = np.flatnonzero((other >= 0) & (other < len(order)))
        differ = np.ones((len(met), limit + 1), dtype=bool)
        np.not_equal(rows[met], rows[other[met]], out=differ[:, :limit])
        a, b = order[met], order[other[met]]
        out = np.zeros(len(order), dtype=np.int64)
        out[met] = np.minimum(differ.argmax(axis=1), np.minimum(ends[a] - starts[a], ends[b] - starts[b]))
        return out

    left, right = common(before), common(behind)
    length, source = np.zeros(len(order), dtype=np.int64), np.full(len(order), -1, dtype=np.int64)
    length[order] = np.maximum(left, right)
    from_left = np.append(order, -1)[before]
    from_right = np.append(order, -1)[np.minimum(behind, len(order))]
    source[order] = np.where(left >= right, from_left, from_right)
    source[length == 0] = -1
    return length, source


def _rank(column: pa.Array) -> np.ndarray:
    ranks = pc.rank(column, sort_keys="ascending", null_placement="at_start", tiebreaker="dense")
    return ranks.to_numpy(zero_copy_only=False).astype(np.int64)


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and where each value begins."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _covered(length: int) -> callable:
    """Runs, sorted by key and block, to covered spans; of keys with several
    blocks also the digests of windows that are not covered."""

    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        data, bounds = _raw(table.column("bytes").combine_chunks())
        n = table.column("n").to_numpy().astype(np.int64)
        first = table.column("start").to_numpy()
        # Places in order: of documents by id and text, then by start.
        document = (_rank(table.column("doc_id").combine_chunks()) << 32) | _rank(table.column("text_key").combine_chunks())
        run = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        starts = bounds[run] + inside
        places = np.lexsort((first[run] + inside, document[run]))
        ranked = np.empty(len(run), dtype=np.int64)
        same = np.zeros(len(run), dtype=bool)
        where = np.stack([document[run][places], (first[run] + inside)[places]])
        same[1:] = (where[:, 1:] == where[:, :-1]).all(axis=0)
        ranked[places] = np.cumsum(~same)
        found, _ = previous_factors(data, starts, bounds[run + 1], ranked, length)
        covered = found >= length
        hit = np.flatnonzero(covered)
        new = np.ones(len(hit), dtype=bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (run[hit[1:]] != run[hit[:-1]])
        begin = hit[new]
        end = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else hit
        yield batch(table, run[begin], first[run[begin]] + inside[begin], first[run[end]] + inside[end] + length, None)
        several = table.column("blocks").to_numpy()[run] > 1
        open_ = np.flatnonzero(several & ~covered)
        if len(open_):
            whole = memoryview(data.tobytes())
            digests = [xxhash.xxh3_128_digest(whole[s : s + length]) for s in starts[open_].tolist()]
            at = first[run[open_]] + inside[open_]
            yield batch(table, run[open_], at, at + length, digests)

    def batch(table: pa.Table, run: np.ndarray, start: np.ndarray, end: np.ndarray, digests: list[bytes] | None) -> pa.RecordBatch:
        taken = table.select(_PLACE).take(pa.array(run)).combine_chunks()
        window = pa.array(digests, pa.binary()) if digests is not None else pa.nulls(len(run), pa.binary())
        columns = [taken.column(c).combine_chunks() for c in _PLACE]
        return pa.RecordBatch.from_arrays([*columns, pa.array(start), pa.array(end), window], [*_PLACE, "start", "end", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch_ in batches:
            held.append(batch_)
            size += batch_.column("bytes").nbytes
            if size < SORTED_BYTES:
                continue
            table = pa.Table.from_batches(held)
            key, block = (table.column(c).to_numpy() for c in ("key", "block"))
            changes = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            if len(changes):
                # Whole groups; the last one may go on.
                at = int(changes[-1])
                yield from rows(table.slice(0, at))
                held = table.slice(at).combine_chunks().to_batches()
                size = sum(b.column("bytes").nbytes for b in held)
        if held:
            yield from rows(pa.Table.from_batches(held))

    return run


# --- documents --------------------------------------------------------------


def _with_key(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _lists(table: DataFrame, *fields: str) -> DataFrame:
    """One list of structs for each document."""
    return table.groupBy(*_PLACE).agg(F.collect_list(F.struct(*fields)).alias("listed"))


def _joined(given: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    side = lists.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "listed")
    return given.join(side, given["doc_id"].eqNullSafe(side["_id"]) & (given["text_key"] == side["_key"]), how).drop("_id", "_key")


def _cut_out(length: int) -> callable:
    """The bytes of the listed runs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column("text")[row].as_py().encode()
                listed = batch.column("listed")[row].values
                start, n = (listed.field(c).to_numpy() for c in ("start", "n"))
                content = [raw[s : s + k + length - 1] for s, k in zip(start.tolist(), n.tolist())]
                ids = [batch.column(c).take(pa.array(np.full(len(n), row))) for c in _PLACE]
                fields = [listed.field(c) for c in ("key", "block", "blocks")]
                yield pa.RecordBatch.from_arrays(
                    [*fields, *ids, listed.field("start"), listed.field("n"), pa.array(content, pa.binary())],
                    ["key", "block", "blocks", *_PLACE, "start", "n", "bytes"],
                )

    return run


def repeated_spans(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, start, end): places in UTF-8 bytes, end exclusive, whose
    every byte is covered by a string of ``length`` bytes that also starts
    earlier.  They overlap and may touch; ``text_key`` is ``xxhash64`` of the text.
    """
    given = _with_key(documents, id_col, text_col)
    id_type = given.schema["doc_id"].dataType.simpleString()
    place = f"doc_id {id_type}, text_key long, start long"
    scanned = given.mapInArrow(_scan(length, gram), f"key long, content long, {place}, n int")
    again = _keep(scanned.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "keys")
    runs = _keep(scanned.join(again, "key", "left_semi"), "runs")
    release(again)
    first = F.min(F.struct("doc_id", "text_key", "start", "n")).alias("first")
    distinct = _keep(runs.groupBy("key", "content").agg(first), "distinct-runs")
    own = F.struct("doc_id", "text_key", "start")
    earlier = F.struct("first.doc_id", "first.text_key", "first.start")
    later = runs.join(distinct, ["key", "content"]).where(own > earlier)
    copies = _keep(later.select(*_PLACE, "start", (F.col("start") + F.col("n") + (length - 1)).alias("end")), "copies")
    release(runs)

    several = _keep(distinct.groupBy("key").agg(F.count("*").alias("runs")).where("runs > 1"), "several")
    blocks = F.ceil(F.col("runs") / BLOCK_RUNS).cast("int")
    block = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    different = distinct.join(if_small(several), "key").withColumn("blocks", blocks).withColumn("block", block)
    wanted = _lists(different.select("key", "block", "blocks", "first.*"), "key", "block", "blocks", "start", "n")
    cut = _joined(given, wanted, "inner").mapInArrow(
        _cut_out(length), f"key long, block int, blocks int, {place}, n int, bytes binary"
    )
    met = cut.repartition("key", "block").sortWithinPartitions("key", "block")
    found = _keep(met.mapInArrow(_covered(length), f"{place}, end long, window binary"), "covered")
    release(distinct, several)

    open_ = found.where("window is not null")
    firsts = _keep(open_.groupBy("window").agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1"), "windows")
    across = open_.join(firsts, "window").where(own > F.col("first"))
    span = [*_PLACE, "start", "end"]
    return copies.unionByName(found.where("window is null").select(span)).unionByName(across.select(span))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            raw = batch.column("text")[row].as_py().encode()
            listed = batch.column("listed")[row]
            kept, removed, spans = raw, 0, 0
            if listed.is_valid:
                start, end = (listed.values.field(c).to_numpy() for c in ("start", "end"))
                order = np.argsort(start, kind="stable")
                start, reach = start[order], np.maximum.accumulate(end[order])
                new = np.ones(len(start), dtype=bool)
                new[1:] = start[1:] > reach[:-1]
                begins = start[new].tolist()
                ends = reach[np.append(np.flatnonzero(new)[1:], len(start)) - 1].tolist()
                kept = b"".join(raw[e:s] for e, s in zip([0, *ends], [*begins, len(raw)]))
                removed, spans = len(raw) - len(kept), len(begins)
            out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of each row.

    Each byte goes that a string of ``length`` bytes covers which also starts
    earlier: in a document of smaller id, or earlier in the same one; overlaps
    count, and all are judged on the input.  Matches never cross documents.
    ``n_spans`` counts maximal removed runs, ``kept`` is the rest as text, where
    bytes that no longer make up a letter are replaced (the digest is of bytes).

    Null texts are empty, and nothing of an empty or short text goes.  A null id
    comes before all others.  Rows of one id are documents in the order of a hash
    of their texts; equal rows are one document and get the same result each.
    Other columns are ignored.
    """
    given = _with_key(documents, id_col, text_col)
    lists = _lists(repeated_spans(documents, length, gram, id_col, text_col), "start", "end")
    id_type = given.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    return _joined(given, lists, "left").mapInArrow(_removed, schema)
