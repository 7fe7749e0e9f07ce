"""MinHash near-duplicates against all pairs of shingle sets."""

import random
import re

import pytest
from odd import alike_under_overflow

from earshot.llm import minhash
from earshot.llm.components import connected_components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width):
    """Component and set size of each (id, text)."""
    sets = [shingles(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            shared, together = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if rows[i][0] == rows[j][0] or (together and 100 * shared >= 80 * together):
                root[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return sorted((doc_id, len(sets[k]), least[find(k)]) for k, (doc_id, _) in enumerate(rows))


def result(table):
    assert table.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = table.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id is not None)


def families(seed):
    """Groups of edited copies, most of them near the similarity that counts."""
    choose = random.Random(seed)
    word = lambda: "".join(choose.choice("abcdeé") for _ in range(choose.randint(1, 5)))
    rows, doc_id = [], 0
    for size in (60, 40, 20, 12, 6, 3, 1, 1, 1):
        base = [word() for _ in range(choose.randint(30, 120))]
        for _ in range(size):
            copy = [word() if choose.random() < choose.choice((0.0, 0.01, 0.02, 0.03)) else w for w in base]
            rows.append((doc_id, choose.choice((" ", "\n", "  ")).join(copy)))
            doc_id += 1
    choose.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 7)])
def test_equals_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = families(seed)
    want = brute(rows, 4)
    assert len({c for _, _, c in want}) > 9
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(minhash.near_duplicates(table, words=4)) == want


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(40_000))
    rows = [
        (5, None), (6, ""), (7, " \n\t "), (8, "One Two"), (9, "one  two"), (10, "one"), (11, long), (12, long + " end"),
        (13, "same row here now"), (13, "same row here now"), (14, "SAME row here now"),
        (15, "two texts of one id"), (15, "another text altogether of that id"), (16, "another text altogether of that id"),
    ]
    table = spark.createDataFrame(
        [(d, t, "x", 1) for d, t in [*rows, (None, "one two")]], "doc_id long, text string, key string, component_id int"
    )
    found = minhash.near_duplicates(table, words=4)
    assert result(found) == brute(rows, 4)
    assert [tuple(r) for r in found.where("doc_id IS NULL").collect()] == [(None, 1, None, True)]
    stay = minhash.drop_near_duplicates(table)
    assert stay.columns == table.columns
    kept = [r.doc_id for r in stay.collect()]
    assert sorted(k for k in kept if k is not None) == [5, 6, 7, 8, 10, 11, 13, 15] and None in kept


@pytest.mark.parametrize("levels", [6, 10, 11])
def test_words_built_to_collide_are_not_copies(spark, levels):
    one, other = alike_under_overflow(levels)
    rows = [(1, f"some words {one} and more"), (2, f"some words {other} and more"), (3, one), (4, other)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4)
    assert [r[2] for r in result(found)] == [1, 2, 3, 4]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []
    assert minhash.drop_near_duplicates(empty).collect() == []


def test_components_of_paths_and_stars(spark):
    choose = random.Random(4)
    names = choose.sample(range(10_000), 400)
    links = [(names[k], names[k + 1]) for k in range(150)]  # one long path
    links += [(names[200], n) for n in names[201:300]]  # one star
    links += [(names[310], names[310]), (None, 3), (names[320], names[321]), (names[321], names[320])]
    table = connected_components(spark.createDataFrame(links, "u long, v long"))
    got = dict(tuple(r) for r in table.collect())
    want = dict.fromkeys(names[:151], min(names[:151])) | dict.fromkeys(names[200:300], min(names[200:300]))
    want |= dict.fromkeys(names[320:322], min(names[320:322]))
    assert got == want
