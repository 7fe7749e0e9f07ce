"""Byte-level BPE encoding and decoding.

Two tiers.  A pre-token that is a vocabulary entry is resolved by one look into
a minimal perfect hash of the vocabulary (hash and displace: a displacement per
bucket sends every key to a slot of its own), with the entry's bytes compared.
The others are merged pair by pair: a heap of candidate pairs over a linked
list of byte pieces.

Texts are handled in chunks.  A chunk's distinct pieces between spaces are split
into pre-tokens once, its distinct pre-tokens are looked up once, and the ids of
texts are gathered from theirs.  A memo of bounded size keeps the ids of
pre-tokens from chunk to chunk of a worker.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.memory import give_back, giving_back
from earshot.llm.tokens import chunks, gathered, offsets

MEMO_ENTRIES = 260_000
# Bytes of text whose distinct pieces are encoded together.
CHUNK_BYTES = 3 << 20
# Texts whose ids are handed on together.
TEXTS_TOGETHER = 256
_MASK = (1 << 64) - 1
# A space that lies in a longer run of white space, so that a pre-token may
# cross it.  Before every other space a pre-token begins.
_CROSSED = re.compile(r"\s (?!\S)")

_PACKS = [struct.Struct(f"<{n}I").pack for n in range(32)]
_ID = np.dtype("<u4")


class MinimalPerfectHash:
    """Keys (distinct byte strings) to 0 .. n - 1, each its own slot.

    Keys of a bucket, largest buckets first, are displaced together until all
    of them fall on free slots.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.n_buckets = max(1, self.n // 3)
        self.shift = [0] * self.n_buckets
        buckets: list[list[int]] = [[] for _ in range(self.n_buckets)]
        hashes = [self.hashes(k) for k in keys]
        for index, (low, _) in enumerate(hashes):
            buckets[low % self.n_buckets].append(index)
        taken = bytearray(self.n)
        free = 0
        for members in sorted((b for b in buckets if b), key=len, reverse=True):
            bucket = hashes[members[0]][0] % self.n_buckets
            if len(members) == 1:
                while taken[free]:
                    free += 1
                # A negative displacement names the slot itself.
                self.shift[bucket], slots = -free - 1, [free]
            else:
                shift = 0
                while True:
                    slots = [self._displaced(hashes[m][1], shift) for m in members]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    shift += 1
                self.shift[bucket] = shift
            for slot in slots:
                taken[slot] = 1

    @staticmethod
    def hashes(key: bytes) -> tuple[int, int]:
        whole = xxhash.xxh3_128_intdigest(key)
        return whole & _MASK, whole >> 64

    def _displaced(self, high: int, shift: int) -> int:
        value = (high ^ (shift * 0x9E3779B97F4A7C15)) & _MASK
        value = ((value ^ (value >> 32)) * 0xD6E8FEB86659FD93) & _MASK
        return (value ^ (value >> 32)) % self.n

    def slot(self, key: bytes) -> int:
        low, high = self.hashes(key)
        shift = self.shift[low % self.n_buckets]
        return -shift - 1 if shift < 0 else self._displaced(high, shift)


class _Memo:
    """At most MEMO_ENTRIES results.  When the young half is full it becomes the
    old one, from which what is still asked for comes back."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, key: str) -> bytes:
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(self.young) >= MEMO_ENTRIES // 2:
                self.young, self.old = {}, self.young
            self.young[key] = value
        return value


def _by_rank(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length and start of each rank's bytes, and the bytes in a row."""
    lengths = np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64)
    for key, rank in ranks.items():
        lengths[rank] = len(key)
    flat = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), dtype=np.uint8)
    return lengths, np.cumsum(lengths) - lengths, flat


class Codec:
    """Ranks of byte strings, and the pattern that splits text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: MinimalPerfectHash | None = None):
        self.table = table or MinimalPerfectHash(list(ranks))
        self.keys: list[bytes] = [b""] * len(ranks)
        self.ids = [0] * len(ranks)
        for key, rank in ranks.items():
            slot = self.table.slot(key)
            self.keys[slot], self.ids[slot] = key, rank
        self.ranks = ranks
        self.lengths, self.starts, self.flat = _by_rank(ranks)
        self.split = regex.compile(pattern).findall
        self.by_space = pattern_begins_at_spaces(pattern)
        self.token_ids = _Memo(self._encoded)

    def whole(self, token: bytes) -> int | None:
        slot = self.table.slot(token)
        return self.ids[slot] if self.keys[slot] == token else None

    def merged(self, token: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        n, rank_of, push, pop = len(token), self.ranks.get, heapq.heappush, heapq.heappop
        end = list(range(1, n + 1))  # where the piece that begins here ends
        before = list(range(-1, n - 1))  # where the piece before it begins
        pairs = [(rank_of(token[k : k + 2]), k, k + 2) for k in range(n - 1)]
        heap = [pair for pair in pairs if pair[0] is not None]
        heapq.heapify(heap)
        while heap:
            _, at, to = pop(heap)
            middle = end[at]
            # Stale: one of the two pieces has been merged meanwhile.
            if not middle or middle >= n or end[middle] != to:
                continue
            end[at], end[middle] = to, 0
            if to < n:
                before[to] = at
                rank = rank_of(token[at : end[to]])
                if rank is not None:
                    push(heap, (rank, at, end[to]))
            left = before[at]
            if left >= 0:
                rank = rank_of(token[left:to])
                if rank is not None:
                    push(heap, (rank, left, to))
        out, at = [], 0
        while at < n:
            out.append(rank_of(token[at : end[at]]))
            at = end[at]
        return out

    def _encoded(self, token: str) -> bytes:
        """Ids of one pre-token, as little-endian 32-bit integers."""
        raw = token.encode()
        one = self.whole(raw)
        ids = (one,) if one is not None else self.merged(raw)
        return _PACKS[len(ids)](*ids) if len(ids) < len(_PACKS) else struct.pack(f"<{len(ids)}I", *ids)

    def _places(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct parts, part at each place, where each text's places begin):
        parts that no pre-token crosses, in a row they are the texts."""
        given = texts.to_pylist()
        plain = np.array([self.by_space and not _CROSSED.search(t) for t in given], dtype=bool)
        pieces = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        counts = np.ones(len(given), dtype=np.int64)
        counts[plain] = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        starts = offsets(counts)
        coded = pieces.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        # Of a text, all pieces but the first begin with a space.
        first = np.zeros(len(codes), dtype=bool)
        first[offsets(counts[plain])[:-1]] = True
        later_words, later = np.unique(codes[~first], return_inverse=True)
        first_words, firsts = np.unique(codes[first], return_inverse=True)
        parts = [" " + words[k] for k in later_words.tolist()]
        of_plain = np.empty(len(codes), dtype=np.int64)
        of_plain[~first], of_plain[first] = later, firsts + len(parts)
        parts += [words[k] for k in first_words.tolist()]
        of = np.empty(starts[-1], dtype=np.int64)
        of[np.repeat(plain, counts)] = of_plain
        of[starts[:-1][~plain]] = np.arange(len(given) - int(plain.sum())) + len(parts)
        parts += [t for t, ok in zip(given, plain) if not ok]
        return parts, of, starts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin."""
        return next(self.encoded(texts, max(len(texts), 1)))

    def encoded(self, texts: pa.Array, together: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for ``together`` texts at a time: ids are many times the
        distinct parts, from which they are gathered."""
        parts, of, starts = self._places(texts)
        number: dict[str, int] = {}
        n_tokens, tokens = [], []
        for part in parts:
            found = self.split(part)
            n_tokens.append(len(found))
            tokens += [number.setdefault(token, len(number)) for token in found]
        packed = [self.token_ids(token) for token in number]
        ids = np.frombuffer(b"".join(packed), dtype=_ID)
        sizes = np.array([len(p) for p in packed], dtype=np.int64) // _ID.itemsize
        # From pre-tokens to parts, from parts to texts.
        of_part = np.array(tokens, dtype=np.int64)
        ids = ids[gathered(offsets(sizes)[of_part], sizes[of_part])]
        sizes = np.diff(offsets(sizes[of_part])[offsets(np.array(n_tokens, dtype=np.int64))])
        begins = offsets(sizes)
        del parts, number, packed, tokens, of_part
        for at in range(0, max(len(texts), 1), together):
            bounds = starts[at : at + together + 1]
            own = of[bounds[0] : bounds[-1]]
            yield ids[gathered(begins[own], sizes[own])], offsets(sizes[own])[bounds - bounds[0]]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[gathered(self.starts[ids], self.lengths[ids])].tobytes()


def pattern_begins_at_spaces(pattern: str) -> bool:
    """Whether a pre-token begins at each space that does not lie within a run
    of white space, which holds for patterns of this form: an optional space
    only in front, and white space runs that leave their last space."""
    return all(part.startswith(("'", " ?[", r" ?\p", r"\s+")) for part in pattern.split("|")) and r"\s+(?!\S)" in pattern


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file, ``base64 rank`` on each line; a local path is read as such.
    A vocabulary is bounded by what its file holds, some tens of thousands."""
    if "://" in path:
        lines = [r[0].encode() for r in spark.read.text(path).toLocalIterator()]
    else:
        with open(path, "rb") as file:
            lines = file.read().splitlines()
    return {base64.b64decode(key): int(rank) for key, rank in (line.split() for line in lines if line)}


_codecs: dict[str, Codec] = {}


def _codec(name: str, ranks: dict[bytes, int], pattern: str, table: MinimalPerfectHash) -> Codec:
    """One codec for the life of a worker."""
    if name not in _codecs:
        _codecs[name] = Codec(ranks, pattern, table)
    return _codecs[name]


def encode_documents(
    documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for).

    Each match of ``pattern`` is encoded by the ranks in ``path``, no special
    tokens; ``ids_sha256`` is of the ids as little-endian unsigned 32-bit
    integers; ``decoded_sha256`` is of the bytes that the ids decode to.  Null
    and empty texts have no tokens.  Repeated rows and null ids are kept as
    they are; other columns are ignored.
    """
    spark = documents.sparkSession
    ranks = read_ranks(spark, path)
    shared = spark.sparkContext.broadcast((path, ranks, pattern, MinimalPerfectHash(list(ranks))))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def rows(batch: pa.RecordBatch, codec: Codec) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).fill_null("")
        for k, (ids, bounds) in enumerate(codec.encoded(texts, TEXTS_TOGETHER)):
            own = [ids[s:e] for s, e in zip(bounds[:-1], bounds[1:])]
            digests = [hashlib.sha256(x.tobytes()).hexdigest() for x in own]
            decoded = [hashlib.sha256(codec.decode(x)).hexdigest() for x in own]
            columns = [pa.array(np.diff(bounds)), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                listed = pa.array(ids.astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), listed))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(k * TEXTS_TOGETHER, TEXTS_TOGETHER), *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value)
        for batch in batches:
            for first, end in chunks(batch.column(1), CHUNK_BYTES):
                yield from rows(batch.slice(first, end - first), codec)
                give_back()

    given = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return given.mapInArrow(giving_back(run), schema + (", ids array<int>" if with_ids else ""))


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from lists of ids; bytes that are not UTF-8 are replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(_by_rank(read_ranks(encoded.sparkSession, path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, starts, flat = shared.value
        for batch in batches:
            listed = batch.column(1)
            ids = listed.flatten().to_numpy(zero_copy_only=False)
            data = flat[gathered(starts[ids], lengths[ids])].tobytes()
            sizes = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
            bounds = offsets(lengths[ids])[offsets(sizes)].tolist()
            texts = [data[s:e].decode(errors="replace") for s, e in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    given = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, text string")
