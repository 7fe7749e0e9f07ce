"""Alignment against plain loops over the tokens of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd import ODD, empty_table, odd_table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from earshot.llm import alignment

FILES = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
FIRST = Tokenizer.from_file(FILES[0])
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
LETTERS = alignment.byte_letters()


def digests(table):
    return alignment.alignment_digests(table, FILES[0], public_tokenizers.PATTERN, FILES[1])


def spans(tokens):
    at, out = 0, []
    for token, data in tokens:
        out.append((token, at, at + len(data)))
        at += len(data)
    return out


def tokens_of(text):
    """Both sides as (id, start, end); None for a text without tokens."""
    if not text:
        return None
    raw = (" " + text).encode()
    found = FIRST.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(LETTERS[c] for c in FIRST.id_to_token(i))) for i in found.ids]
    b = [(i, alignment.piece_bytes(SECOND.id_to_piece(i))) for i in SECOND.encode(text)]
    if any(b"".join(data for _, data in side) != raw for side in (a, b)):
        return None
    return spans(a), spans(b)


def aligned(text):
    """(links by token, group text, groups, links in a group)."""
    a, b = tokens_of(text)
    links, k = [], 0
    for i, (_, start, end) in enumerate(a):
        while b[k][2] <= start:
            k += 1
        j = k
        while j < len(b) and b[j][1] < end:
            links.append((i, j, min(end, b[j][2]) - max(start, b[j][1])))
            j += 1
    cuts = sorted({x[2] for x in a} & {x[2] for x in b})
    groups, i, j = [], 0, 0
    for cut in cuts:
        ends = [next(n for n in range(at, len(side)) if side[n][2] == cut) + 1 for side, at in ((a, i), (b, j))]
        groups.append((a[i : ends[0]], b[j : ends[1]]))
        i, j = ends
    shown = ";".join("|".join(",".join(str(t[0]) for t in side) for side in g) for g in groups)
    return a, b, links, shown, len(groups), sum(len(x) * len(y) for x, y in groups)


def brute(rows):
    found = [aligned(text) if tokens_of(text) else None for _, text in rows]
    held = Counter(p for f in found if f for p in {(f[0][i][0], f[1][j][0]) for i, j, _ in f[2]})
    best = Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), f in zip(rows, found):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        a, b, links, shown, n_groups, n_shared = f
        counts = [(a[i][0], held[a[i][0], b[j][0]]) for i, j, _ in links]
        out.append((
            doc_id, len(a), len(b), n_groups, len(links), sum(n == best[i] for i, n in counts), sum(n for _, n in counts),
            hashlib.sha256(shown.encode()).hexdigest(), n_shared,
        ))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def some_texts():
    rng = random.Random(5)
    parts = ["the ", "café ", " ", "  ", "\n", "\t", "\r\n", "漢字", "\U0001f600", "x1y2", "'ll", "<s>", "<|endoftext|>", "▁", "\x00", "\xa0", "ﬁ", "é", "1234567", "!!", "\x1c ", " ", "Straße", "naïve "]
    return [(100 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 60)))) for k in range(400)]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT_PAIRS, 40])
def test_against_whole_texts(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT_PAIRS", frequent)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 50_000 if frequent == 40 else alignment.CHUNK_BYTES)
    rows = [*ODD, *some_texts()]
    found = digests(odd_table(spark, some_texts()).repartition(3))
    assert order(tuple(r) for r in found.collect()) == order(brute(rows))


def test_no_rows(spark):
    assert digests(empty_table(spark)).collect() == []
    assert digests(odd_table(spark).where("text is null")).agg(F.sum("n_a")).first()[0] == 0


def test_links_of_documents(spark):
    rows = some_texts()[:60] + [(1, None), (2, "")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align_documents(given, FILES[0], public_tokenizers.PATTERN, FILES[1]).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        row = found[doc_id]
        if tokens_of(text) is None:
            assert row.a_ids == row.b_ids == row.links == []
            continue
        a, b, links, *_ = aligned(text)
        assert row.a_ids == [t[0] for t in a] and row.b_ids == [t[0] for t in b]
        assert [tuple(x) for x in row.links] == links


def test_products():
    rng = np.random.default_rng(3)
    for _ in range(50):
        left, right = (rng.random((rng.integers(1, 9), rng.integers(1, 9))) < 0.4 for _ in range(2))
        right = rng.random((left.shape[1], right.shape[1])) < 0.4
        csr = [alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1]) for m in (left, right)]
        rows, columns, values = alignment.product(*csr)
        dense = np.zeros((left.shape[0], right.shape[1]), dtype=int)
        dense[rows, columns] = values
        assert (dense == left.astype(int) @ right.astype(int)).all() and (values > 0).all()
        assert (alignment.product_sizes(*csr) == (left.astype(int) @ right.astype(int)).sum(1)).all()
        back = csr[0].transposed(left.shape[1])
        assert (back.sizes == left.sum(0)).all()


def test_long_runs_end():
    aligner = alignment.Aligner(open(FILES[0]).read(), public_tokenizers.PATTERN, open(FILES[1], "rb").read())
    for text in ("x" * 200_000, " " * 200_000, "\n" * 200_000, "ab" * 100_000, "漢" * 60_000):
        found = aligner.align([text])
        assert found.a_ids.tolist() == FIRST.encode(" " + text, add_special_tokens=False).ids
        assert found.b_ids.tolist() == SECOND.encode(text)
