"""Repeated strings against plain look-ups of every window."""

import hashlib
import random

import numpy as np
import pytest
from odd import ODD, empty_table, odd_table

from earshot.llm import suffixes

LETTERS = "abcdefgh é漢\n"


def brute(rows, length):
    """Rows of one id in the order of the operator's own text hash (given)."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def results(table, **how):
    return order(tuple(r) for r in suffixes.remove_repeats(table, **how).collect())


def random_text(rng, n, letters=LETTERS):
    return "".join(rng.choice(letters) for _ in range(n))


def with_copies(rng, n):
    """Texts with passages, whole copies, changed copies and periodic runs."""
    passages = [random_text(rng, rng.randrange(20, 250)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [random_text(rng, rng.randrange(0, 90)) for _ in range(rng.randrange(1, 5))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        if rng.random() < 0.2:
            parts.append(rng.choice(["ab", "x", "abcabd"]) * rng.randrange(1, 200))
        if texts and rng.random() < 0.3:
            copy = list(rng.choice(texts))
            if copy and rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = "Q"
            parts = ["".join(copy)]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("length, gram, block", [(40, 12, 512), (100, 32, 3), (17, 9, 2)])
def test_against_all_windows(spark, monkeypatch, length, gram, block):
    monkeypatch.setattr(suffixes, "BLOCK_RUNS", block)
    monkeypatch.setattr(suffixes, "SORTED_BYTES", 1 << (20 if block > 2 else 12))
    rng = random.Random(length)
    rows = list(enumerate(with_copies(rng, 150), start=-20))
    rows = [(None, rows[3][1]), *rows, (1000, "long " + "y" * 40_000), (1001, rows[5][1] * 30), (1002, None), (1003, "")]
    given = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    assert results(given, length=length, gram=gram) == order(brute(rows, length))


def test_odd_rows(spark):
    more = [(8, "some words that come again " * 9), (9, "x" + "some words that come again " * 9), (9, "x" + "some words that come again " * 9)]
    rows = sorted([*ODD, *more], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    # Equal rows are one document, with one result each.
    single = {key: row for key, row in zip(dict.fromkeys(rows), brute(list(dict.fromkeys(rows)), suffixes.LENGTH))}
    assert results(odd_table(spark, more)) == order(single[r] for r in rows)
    assert results(empty_table(spark)) == []


def test_text_keys_and_string_ids(spark):
    rng = random.Random(2)
    rows = [(f"id{k:03}", t) for k, t in enumerate(with_copies(rng, 40))]
    given = spark.createDataFrame([(i, t, 1, b"") for i, t in rows], "name string, body string, start int, window binary")
    assert results(given, length=30, gram=10, id_col="name", text_col="body") == order(brute(rows, 30))
    # Rows of one id, other texts: one of them keeps the passage.
    shared = random_text(rng, 300)
    rows = [(1, "one " + shared), (1, "two " + shared)]
    found = results(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r[2] for r in found)[0] == 0 and sum(r[2] for r in found) >= 300


def naive_factors(data, starts, ends, places, limit):
    out = []
    for i, (s, e, p) in enumerate(zip(starts, ends, places)):
        best = 0
        for j, (t, f, q) in enumerate(zip(starts, ends, places)):
            if q < p:
                n = 0
                while n < limit and s + n < e and t + n < f and data[s + n] == data[t + n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


def test_previous_factors():
    rng = np.random.default_rng(1)
    for k in range(30):
        size = int(rng.integers(1, 120))
        data = rng.integers(97, 99 + k % 3, size).astype(np.uint8)
        if k % 4 == 0:
            data = np.resize(data[:5], size)
        starts, ends = np.arange(size), np.full(size, size)
        places, limit = rng.permutation(size), int(rng.integers(8, 60))
        # Strings that end before the limit compare as if followed by zeros.
        length, source = suffixes.previous_factors(data, starts, ends, places, limit)
        assert length.tolist() == naive_factors(data, starts, ends, places, limit)
        for i in np.flatnonzero(length):
            j, n = source[i], length[i]
            assert places[j] < places[i] and (data[i : i + n] == data[j : j + n]).all()
