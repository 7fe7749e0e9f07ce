"""Alignment of two tokenizers on the bytes of a text.

Token-byte incidence matrices are held in CSR (a row for each token, a column
for each byte).  A row of A·Bᵀ is what Gustavson's method gathers: the rows of Bᵀ
(the tokens of a byte) at the columns of a row of A, equal columns added up.  Its
entries are the overlap links, their values the shared bytes.  Byte offsets where
tokens of both sides end cut the tokens into groups; the product of the two
token-group matrices links tokens that share a group.  That one may grow with
the square of a group, so only its row sizes (the symbolic half of the method)
are computed for whole corpora.

Neither tokenizer merges across a space that follows something other than white
space, so texts are cut there and each distinct piece of a chunk is encoded and
aligned once.

Counts of id pairs over the corpus come from a first pass, summed before they
are shuffled.  In the second pass the most frequent pairs, a number fixed by
parameter, are looked up in a broadcast table; links of all other pairs go
through a join.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.tables import keep, release
from earshot.llm.tokens import chunks, gathered, offsets

# Bytes of text whose distinct pieces are aligned together, and of the slices in
# which that, and the links of documents, are handled.
CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 19
# Pieces that go through a tokenizer in a row.
IN_A_ROW = 64
# Pairs summed up in a task before they are handed on.
BUFFERED = 2_000_000
# Pairs in the broadcast table at most: 17 bytes each.
FREQUENT_PAIRS = 500_000

_LATER_SPACE = re.compile(r"(?<=\S) (?!\Z)")
_BEHIND_WHITE = re.compile(r"[^\S ] ")


@dataclass
class Csr:
    """Row r's entries are ``columns[starts[r]:starts[r + 1]]``, all of value 1."""

    starts: np.ndarray
    columns: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def transposed(self, n_columns: int) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), self.sizes)
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=n_columns))])
        return Csr(starts, rows[order])


def intervals(ends: np.ndarray) -> Csr:
    """Rows that follow one another without gaps: row r has the columns from
    ``ends[r - 1]`` to ``ends[r]``."""
    return Csr(np.concatenate([[0], ends]), np.arange(ends[-1] if len(ends) else 0))


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Entries that each row of the product gathers, before equal ones are added."""
    gathered = np.concatenate([[0], np.cumsum(right.sizes[left.columns])])
    return gathered[left.starts[1:]] - gathered[left.starts[:-1]]


def product(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the entries of ``left`` x ``right``, row by row."""
    sizes = right.sizes[left.columns]
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    place = np.arange(n) + np.repeat(right.starts[left.columns] - (ends - sizes), sizes)
    columns = right.columns[place]
    rows = np.repeat(np.arange(len(left.starts) - 1), product_sizes(left, right))
    if np.any((columns[1:] < columns[:-1]) & (rows[1:] == rows[:-1])):
        order = np.lexsort((columns, rows))
        rows, columns = rows[order], columns[order]
    new = np.ones(n, dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    first = np.flatnonzero(new)
    return rows[first], columns[first], np.diff(np.append(first, n))


class Vocabulary:
    """Bytes of ids, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(n)]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself
    where it can be seen, else the next one from U+0100."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def byte_level_ranks(vocabulary: str) -> dict[bytes, int]:
    """Ids by bytes of a byte-level BPE file (JSON) whose ids follow its merges;
    tokens that are no merge and no byte are special and left out."""
    model = json.loads(vocabulary)["model"]
    letters = byte_letters()
    merged = [left + right for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    ids = [model["vocab"][m] for m in merged]
    if any(b <= a for a, b in zip(ids, ids[1:])):
        raise ValueError("ids of merged tokens must be in the order of the merges")
    singles = [t for t in model["vocab"] if len(t) == 1 and t in letters]
    return {bytes(letters[c] for c in t): model["vocab"][t] for t in [*singles, *merged]}


def piece_bytes(piece: str) -> bytes:
    if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


@dataclass
class Aligned:
    """Of consecutive texts: tokens, groups, and links with the pair's number."""

    valid: np.ndarray  # of each text: whether both sides' bytes are the text's
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_counts: np.ndarray
    b_counts: np.ndarray
    a_group: np.ndarray  # groups are numbered across all texts
    b_group: np.ndarray
    n_groups: np.ndarray
    links: tuple[np.ndarray, np.ndarray, np.ndarray]  # token of a, token of b, shared bytes
    n_links: np.ndarray
    n_shared: np.ndarray
    pairs: np.ndarray


class Aligner:
    """Both tokenizers.  A space is put in front of each text."""

    def __init__(self, vocabulary: str, pattern: str, model: bytes):
        ranks = byte_level_ranks(vocabulary)
        self.first = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.a, self.b = Vocabulary(tokens), Vocabulary([piece_bytes(p) for p in pieces])
        self.n_b = len(pieces)
        # No entry holds a space behind something else, in either vocabulary.
        self.cuts = pattern_cuts(pattern) and not any(re.search("[^▁]▁", p) for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """Pieces of the text with a space in front, each without its first space."""
        if not text:
            return []
        return _LATER_SPACE.split(text) if self.cuts else [text]

    def plain(self, text: str) -> bool:
        """Whether the pieces are what lies between spaces."""
        odd = not text or text[0] == " " or text[-1] == " " or "  " in text or _BEHIND_WHITE.search(text)
        return self.cuts and not odd

    def _together(self, texts: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and their numbers in each text, of texts that no token crosses
        when they stand in a row; None where bytes differ or texts may be crossed."""
        if not self.cuts or any(t[-1:].isspace() or not t for t in texts):
            return None
        rows = [" ".join(texts[at : at + IN_A_ROW]) for at in range(0, len(texts), IN_A_ROW)]
        encoded = [self.first.encode_ordinary(" " + r) for r in rows], self.second.encode(rows, num_threads=1)
        whole = np.frombuffer(b"".join(raw), dtype=np.uint8)
        bounds = offsets(np.array([len(r) for r in raw], dtype=np.int64))
        found = []
        for vocabulary, lists in zip((self.a, self.b), encoded):
            ids = np.array(list(chain.from_iterable(lists)), dtype=np.int64)
            if not _equal(whole, vocabulary, ids):
                return None
            ends = offsets(vocabulary.lengths[ids])
            place = np.searchsorted(ends, bounds)
            if not np.array_equal(ends[place], bounds):
                return None
            found += [ids, np.diff(place)]
        return tuple(found)

    def _each(self, texts: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same, text by text, and whether each has tokens."""
        lists = zip(raw, [self.first.encode_ordinary(" " + t) for t in texts], self.second.encode(texts, num_threads=1))
        a_lists, b_lists, valid = [], [], []
        for data, a, b in lists:
            data = np.frombuffer(data, dtype=np.uint8)
            a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            valid.append(_equal(data, self.a, a) and _equal(data, self.b, b))
            a_lists.append(a if valid[-1] else a[:0])
            b_lists.append(b if valid[-1] else b[:0])
        return *_joined(a_lists), *_joined(b_lists), np.array(valid, dtype=bool)

    def align(self, texts: list[str]) -> Aligned:
        raw = [(" " + t).encode() for t in texts]
        valid = np.ones(len(texts), dtype=bool)
        found = self._together(texts, raw)
        if found is None:
            *found, valid = self._each(texts, raw)
            raw = [r if ok else b"" for r, ok in zip(raw, valid)]
        a_ids, a_counts, b_ids, b_counts = found
        n = sum(map(len, raw))
        a_ends, b_ends = np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b.lengths[b_ids])
        a_starts = np.concatenate([[0], np.cumsum(a_counts)])
        b_starts = np.concatenate([[0], np.cumsum(b_counts)])
        at, to, shared = product(intervals(a_ends), intervals(b_ends).transposed(n))
        ends = np.zeros(n + 1, dtype=np.int8)
        ends[a_ends] += 1
        ends[b_ends] += 1
        before = np.cumsum(ends == 2)
        a_group, b_group = before[a_ends - 1], before[b_ends - 1]
        cut_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        # A text's first byte lies behind the last cut of the text before.
        groups_before = np.concatenate([[0], before[cut_at[1:]]])
        token_links = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(a_ids)))])
        by_group = Csr(np.arange(len(b_ids) + 1), b_group).transposed(int(before[-1]))
        row_sizes = product_sizes(Csr(np.arange(len(a_ids) + 1), a_group), by_group)
        in_groups = np.concatenate([[0], np.cumsum(row_sizes)])
        of_text = lambda running: np.diff(running[a_starts])
        return Aligned(
            valid, a_ids, b_ids, a_counts, b_counts, a_group, b_group, np.diff(groups_before),
            (at, to, shared), of_text(token_links), of_text(in_groups), a_ids[at] * self.n_b + b_ids[to],
        )


def pattern_cuts(pattern: str) -> bool:
    """Whether every match of ``pattern`` that holds a space behind something
    that is no white space is impossible: an optional space only in front."""
    return all(part.startswith(("'", " ?[", r" ?\p", r"\s+")) for part in pattern.split("|"))


def _joined(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    return np.concatenate([np.zeros(0, dtype=np.int64), *lists]), counts


def _equal(data: np.ndarray, vocabulary: Vocabulary, ids: np.ndarray) -> bool:
    return int(vocabulary.lengths[ids].sum()) == len(data) and np.array_equal(vocabulary.joined(ids), data)


def group_texts(found: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: groups and their ids."""
    n_a, n_b = len(found.a_ids), len(found.b_ids)
    # The place of a token: its own side's before it, the other side's of groups before.
    a_place = np.arange(n_a) + np.searchsorted(found.b_group, found.a_group, "left")
    b_place = np.arange(n_b) + np.searchsorted(found.a_group, found.b_group, "right")
    ids = np.empty(n_a + n_b, dtype=np.int64)
    ids[a_place], ids[b_place] = found.a_ids, found.b_ids
    behind = np.full(n_a + n_b, ord(","), dtype=np.uint8)
    behind[a_place[np.diff(found.a_group, append=-1) != 0]] = ord("|")
    behind[b_place[np.diff(found.b_group, append=-1) != 0]] = ord(";")
    digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, 10))
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    out[ends - 1] = behind
    rest, at = ids.copy(), ends - 2
    for k in range(int(digits.max()) if len(digits) else 0):
        more = np.flatnonzero(digits > k)
        out[at[more] - k] = ord("0") + rest[more] % 10
        rest //= 10
    last = np.cumsum(found.a_counts + found.b_counts)
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], last])]
    data = out.tobytes()
    return [data[s : max(s, e - 1)] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


@dataclass
class Chunk:
    """Documents as runs of distinct pieces, and the alignment of the pieces."""

    pieces: list[Aligned]
    of: np.ndarray  # distinct piece at each place
    starts: np.ndarray  # where each document's places begin, and the end
    valid: np.ndarray  # of each document: it has tokens

    def sizes(self, name: str) -> np.ndarray:
        return np.concatenate([getattr(p, name) for p in self.pieces] or [np.zeros(0, dtype=np.int64)])

    def total(self, of_piece: np.ndarray) -> np.ndarray:
        """Sums over each document, 0 for one without tokens."""
        running = offsets(of_piece[self.of])
        return np.where(self.valid, running[self.starts[1:]] - running[self.starts[:-1]], 0)


def _chunk(texts: pa.Array, aligner: Aligner) -> Chunk:
    given = texts.fill_null("").to_pylist()
    plain = np.array([aligner.plain(t) for t in given], dtype=bool)
    between = pc.split_pattern(texts.filter(pa.array(plain)), " ")
    other = [aligner.pieces(t) for t, ok in zip(given, plain) if not ok]
    counts = np.zeros(len(given), dtype=np.int64)
    counts[plain] = pc.list_value_length(between).to_numpy(zero_copy_only=False)
    counts[~plain] = [len(x) for x in other]
    others = pa.array([p for x in other for p in x], between.type.value_type)
    coded = pa.concat_arrays([between.flatten(), others]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    of = np.empty(len(codes), dtype=np.int64)
    is_plain = np.repeat(plain, counts)
    n_plain = int(is_plain.sum())
    of[is_plain], of[~is_plain] = codes[:n_plain], codes[n_plain:]
    # Pieces that end in white space are encoded one by one, the rest in a row.
    words = coded.dictionary.to_pylist()
    alone = [k for k, w in enumerate(words) if not w or w[-1].isspace()]
    order = np.ones(len(words), dtype=bool)
    order[alone] = False
    order = np.concatenate([np.flatnonzero(order), alone]).astype(np.int64)
    place = np.empty(len(words), dtype=np.int64)
    place[order] = np.arange(len(words))
    pieces, batch, size = [], [], 0
    for k, number in enumerate(order.tolist()):
        batch.append(words[number])
        size += len(words[number]) + 1
        if size >= SLICE_BYTES or k in (len(words) - len(alone) - 1, len(words) - 1):
            pieces.append(aligner.align(batch))
            batch, size = [], 0
    chunk = Chunk(pieces, place[of], offsets(counts), np.zeros(0, dtype=bool))
    broken = offsets(~chunk.sizes("valid").astype(bool)[chunk.of])
    empty = chunk.starts[1:] == chunk.starts[:-1]
    chunk.valid = (broken[chunk.starts[1:]] == broken[chunk.starts[:-1]]) & ~empty
    return chunk


def _document_pairs(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, pair, links) with each pair once for a document, in slices."""
    sizes = chunk.sizes("n_links")
    starts = offsets(sizes)[:-1]
    pairs = chunk.sizes("pairs")
    running = offsets(sizes[chunk.of])[chunk.starts]
    first, n = 0, len(chunk.starts) - 1
    while first < n:
        end = int(np.searchsorted(running, running[first] + SLICE_BYTES, "right")) - 1
        end = min(max(end, first + 1), n)
        of = chunk.of[chunk.starts[first] : chunk.starts[end]]
        found = pairs[gathered(starts[of], sizes[of])]
        document = np.repeat(np.arange(first, end), np.diff(running[first : end + 1]))
        kept = chunk.valid[document]
        order = (document[kept] << 44) | found[kept]
        order.sort()
        new = np.flatnonzero(np.diff(order, prepend=-1))
        yield order[new] >> 44, order[new] & ((1 << 44) - 1), np.diff(np.append(new, len(order)))
        first = end


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, weights = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    first = np.flatnonzero(np.diff(flat, prepend=-1))
    return flat[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


def _pair_counts(shared) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        pairs, counts, size = [], [], 0
        for batch in batches:
            for first, end in chunks(batch.column(0), CHUNK_BYTES):
                chunk = _chunk(batch.column(0).slice(first, end - first), aligner)
                for _, found, _ in _document_pairs(chunk):
                    pairs.append(found)
                    counts.append(np.ones(len(found), dtype=np.int64))
                    size += len(found)
                    if size >= 2 * BUFFERED:
                        flat, weights = _summed(pairs, counts)
                        pairs, counts, size = [flat], [weights], len(flat)
                        if size >= BUFFERED:
                            yield _pair_rows(flat, weights)
                            pairs, counts, size = [], [], 0
        if pairs:
            yield _pair_rows(*_summed(pairs, counts))

    return run


def _pair_rows(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])


def _digests(shared, frequent) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        known, count, best = frequent.value
        for batch in batches:
            for first, end in chunks(batch.column(1), CHUNK_BYTES):
                part = batch.slice(first, end - first)
                yield _digest_rows(part.column(0), _chunk(part.column(1), aligner), known, count, best)

    return run


def _digest_rows(ids: pa.Array, chunk: Chunk, known: np.ndarray, count: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    pairs = chunk.sizes("pairs")
    place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
    met = known[place] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
    sizes = chunk.sizes("n_links")
    starts = offsets(sizes)
    of_piece = lambda values: np.diff(offsets(values)[starts])
    sums = of_piece(np.where(met, count[place], 0)) if len(known) else np.zeros(len(sizes), dtype=np.int64)
    bests = of_piece(np.where(met, best[place], 0)) if len(known) else np.zeros(len(sizes), dtype=np.int64)
    # Links whose pair is not among the frequent ones.
    rare, n_rare = pairs[~met], of_piece(~met)
    places = np.diff(chunk.starts)
    of = chunk.of[np.repeat(chunk.valid, places)]
    in_place = offsets(n_rare[of])[offsets(np.where(chunk.valid, places, 0))]
    rare = rare[gathered(offsets(n_rare)[of], n_rare[of])]
    listed = pa.ListArray.from_arrays(pa.array(in_place, pa.int32()), pa.array(rare, pa.int64()))
    texts = [t for p in chunk.pieces for t in group_texts(p)]
    digests = []
    for k, ok in enumerate(chunk.valid.tolist()):
        of = chunk.of[chunk.starts[k] : chunk.starts[k + 1]].tolist()
        digests.append(hashlib.sha256(b";".join([texts[i] for i in of])).hexdigest() if ok else "")
    totals = [chunk.total(chunk.sizes(c)) for c in ("a_counts", "b_counts", "n_groups", "n_links", "n_shared")]
    columns = [ids, *(pa.array(t) for t in [*totals, chunk.total(bests), chunk.total(sums)]), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays([*columns, listed], _NAMES)


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups_sha256", "rare"]

_aligners: dict[str, Aligner] = {}


def _aligner(name: str, vocabulary: str, pattern: str, model: bytes) -> Aligner:
    """One aligner for the life of a worker."""
    if name not in _aligners:
        _aligners[name] = Aligner(vocabulary, pattern, model)
    return _aligners[name]


def _shared(spark: SparkSession, bpe_path: str, pattern: str, piece_path: str):
    """The two vocabulary files, of some MB, for all workers."""
    files = []
    for path in (bpe_path, piece_path):
        if "://" in path:
            files.append(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))
        else:
            with open(path, "rb") as file:
                files.append(file.read())
    return spark.sparkContext.broadcast((f"{bpe_path} {piece_path}", files[0].decode(), pattern, files[1]))


def align_documents(
    documents: DataFrame, bpe_path: str, pattern: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_groups, b_groups, links) of each row: token ids,
    the number of each token's group, and (a, b, bytes) of the tokens whose bytes
    overlap, with how many they share.  Texts without tokens have empty lists.
    """
    shared = _shared(documents.sparkSession, bpe_path, pattern, piece_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                found = aligner.align([text] if text else [])
                at, to, size = found.links
                links = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (at, to, size)], ["a", "b", "bytes"])
                lists = [pa.array(x, pa.int32()) for x in (found.a_ids, found.b_ids, found.a_group, found.b_group)]
                listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in [*lists, links]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), *listed], ["doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "links"]
                )

    given = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lists = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_groups", "b_groups"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {id_type}, {lists}, links array<struct<a:int,b:int,bytes:int>>")


def pair_counts(documents: DataFrame, bpe_path: str, pattern: str, piece_path: str, text_col: str = "text") -> DataFrame:
    """(pair, n): how many rows hold a pair of ids linked; the pair's number is
    the id of a times the size of b's vocabulary plus the id of b."""
    shared = _shared(documents.sparkSession, bpe_path, pattern, piece_path)
    given = documents.select(F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(_pair_counts(shared), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame]:
    """(pairs, counts, is best) of at most FREQUENT_PAIRS pairs, and the rest:
    all pairs that are held by as many documents as one left out."""
    size = F.floor(F.log2("n") * 8).cast("int")
    classes = sorted((-r[0], r[1]) for r in counts.groupBy(size.alias("size")).count().collect())
    least, room = 1 << 30, FREQUENT_PAIRS
    for negated, n in classes:
        if n > room:
            break
        least, room = -negated, room - n
    rows = counts.where(size >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    return (*(rows.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best")), counts.where(size < least))


def alignment_digests(
    documents: DataFrame, bpe_path: str, pattern: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    n_shared) of each row.

    ``n_links`` counts pairs of token occurrences whose bytes overlap,
    ``n_shared`` those in one group.  A pair of ids counts the rows that hold it
    linked; ``count_sum`` adds these counts up over the row's links, ``n_best``
    is how many links have the highest count of their first id.

    Null and empty texts, and texts whose tokens' bytes are not a space and the
    text, have no tokens: zeros and an empty digest; they count nowhere.
    Repeated rows and null ids are rows of their own.  Special tokens' strings
    are ordinary text.  Other columns are ignored.
    """
    spark = documents.sparkSession
    shared = _shared(spark, bpe_path, pattern, piece_path)
    n_b = sentencepiece.SentencePieceProcessor(model_proto=shared.value[3]).get_piece_size()
    found = keep(pair_counts(documents, bpe_path, pattern, piece_path, text_col), "pair-counts")
    first = F.floor(F.col("pair") / n_b).alias("a")
    # A row for each id of the first vocabulary.
    highest = found.groupBy(first).agg(F.max("n").alias("highest"))
    counts = keep(
        found.withColumn("a", first).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).cast("int").alias("best")),
        "pairs",
    )
    release(found)
    *known, rest = _frequent(counts)
    frequent = spark.sparkContext.broadcast(tuple(known))
    given = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in _NAMES[1:8])
    rows = given.mapInArrow(_digests(shared, frequent), f"doc_id {id_type}, {longs}, groups_sha256 string, rare array<long>")
    rows = keep(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = rows.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("links"))
    more = links.join(rest, "pair").groupBy("row").agg(
        F.sum(F.col("links") * F.col("n")).alias("more_sum"), F.sum(F.col("links") * F.col("best")).alias("more_best")
    )
    whole = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return rows.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", whole("n_best", "more_best"), whole("count_sum", "more_sum"), "groups_sha256", "n_shared"
    )
