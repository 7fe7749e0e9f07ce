"""URL rules, top-k, benchmark passages and byte BPE against brute force."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from odd import ODD, alike_under_overflow, empty_table, odd_table
from pyspark.sql import functions as F

from earshot.llm import bpe, decontaminate, topk, urls

ALPHANUMERIC = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return ALPHANUMERIC.findall((text or "").encode().translate(LOWER))


# --- URL rules --------------------------------------------------------------


def winner(rules, host, path):
    for rule in sorted(rules, key=lambda r: (-len(r.text), -len(r.host))):
        glob = lambda text, wild: "".join(wild if c == "*" else re.escape(c) for c in text)
        if re.match(rf"(?s:(?:.*\.)?{glob(rule.host, '[^/]*')}\Z)", host) and re.match(rf"(?s:{glob(rule.path, '.*')})", path):
            return rule
    return None


def test_random_globs(spark):
    choose = random.Random(3)
    text = lambda letters, n: "".join(choose.choice(letters) for _ in range(choose.randrange(n)))
    for seed in range(6):
        rules = {(text("ab.*", 6), text("/xy*", 6)) for _ in range(choose.choice((1, 5, 40)))}
        rules = [urls.Rule(choose.choice(("allow", "block")), *r) for r in sorted(rules)]
        given = [f"http://{text('ab.', 8)}{choose.choice(('/', '', '?', '#/'))}{text('/xy?#', 9)}" for _ in range(200)]
        table = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
        rows = urls.judge_urls(table, rules, default="block").collect()
        assert len(rows) == len(given)
        for row in rows:
            rest = given[row.page_id].split("://", 1)[1]
            host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
            rule = winner(rules, host, path)
            assert (row.host, row.path) == (host, path)
            assert (row.rule, row.verdict) == ((rule.text, rule.verdict) if rule else (None, "block"))


def test_odd_urls(spark):
    given = [
        (1, None), (2, ""), (3, "example.com/en/"), (4, "HTTPS://Ex.COM/EN/"), (5, "a://b://c.com/"), (6, "http://" + "x." * 50_000 + "com/"),
        (7, "http://é.com/é?q"), (7, "http://é.com/é?q"), (None, "http://a.net/es/"), (8, "http://notcom/"), (9, "http://com"),
    ]
    table = spark.createDataFrame([(p, u, "x") for p, u in given], "page_id long, url string, host string")
    got = sorted(tuple(r[k] if k else r[k] or 0 for k in (0, 1, 2, 3, 4)) for r in urls.judge_urls(table).where("page_id is null or page_id <> 6").collect())
    assert got == sorted([
        (0, "a.net", "/es/", "net/es/", "block"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "ex.com", "/EN/", "com/", "allow"), (5, "b:", "//c.com/", None, "allow"), (7, "é.com", "/é", "com/", "allow"),
        (7, "é.com", "/é", "com/", "allow"), (8, "notcom", "/", None, "allow"), (9, "com", "", None, "allow"),
    ], key=lambda r: tuple(str(x) for x in r)) or sorted(map(str, got))
    assert urls.judge_urls(table).where("page_id = 6").first().rule == "com/"
    assert urls.judge_urls(table.limit(0)).collect() == []
    assert urls.allowed_pages(table).count() == 10


# --- top-k ------------------------------------------------------------------


def brute_top_k(vectors, is_query, k):
    whole = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in vectors.items()}
    rows = []
    for query in filter(is_query, whole):
        scores = [(-sum(a * b for a, b in zip(whole[query], v)), i) for i, v in whole.items() if i != query]
        rows += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows)


@pytest.mark.parametrize("kind", ["random", "tight", "lengths", "copies"])
def test_top_k(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 1)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    choose = np.random.default_rng(8)
    rows = choose.normal(size=(1500, 6))
    if kind == "tight":
        rows = np.eye(6)[choose.integers(0, 6, 1500)] * 8 + rows / 50
    if kind == "lengths":
        rows *= choose.pareto(1.0, size=(1500, 1))
    if kind == "copies":
        rows[: 700] = rows[0]
    vectors = dict(enumerate(rows.astype(np.float32).tolist()))
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").repartition(4)
    got = topk.top_k(table, F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute_top_k(vectors, lambda i: i % 50 == 0, 5)


def test_odd_vectors(spark):
    usable = {0: [1.0, -2.0], 50: [0.5], 7: [], 8: [3.0, 3.0, 9.0], 9: [-1.0, 0.25], 100: [1e30, -1e30]}
    odd = [(10, None), (11, [1.0, None]), (12, [float("nan")]), (13, [float("inf")]), (None, [1.0]), (9, [-1.0, 0.25])]
    rows = [(i, v, 1) for i, v in [*usable.items(), *odd]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 50 == 0, 3).collect()))
    cut = {i: [max(min(x, topk.LARGEST / 256), -topk.LARGEST / 256) for x in v] + [0.0] * (3 - len(v)) for i, v in usable.items()}
    assert got == brute_top_k(cut, lambda i: i % 50 == 0, 3)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(table.where("vec_id = 0"), F.col("vec_id") % 50 == 0).collect() == []


def rows_top_k(rows, is_query, k):
    whole = [(i, [int(256 * Fraction(x) // 1) for x in v]) for i, v in rows]
    found = {}
    for query, q in whole:
        if is_query(query):
            found.setdefault(query, []).extend((-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != query)
    return sorted((q, rank, i, -s) for q, all_ in found.items() for rank, (s, i) in enumerate(sorted(all_)[:k], 1))


@pytest.mark.parametrize("largest", [3e5, 1e7, 1e12])
def test_large_components_and_repeated_rows(spark, monkeypatch, largest):
    """Close scores of components far beyond 2**26 / 256, and ids with several rows."""
    monkeypatch.setattr(topk, "BLOCK_BYTES", 1)
    choose = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(choose.normal(size=(700, 4)).tolist())]
    rows += [(1000 + i, (largest * (1 + choose.integers(0, 3, 4) / 2**30)).tolist()) for i in range(40)]
    rows += [(50, [largest, 1.0, 2.0, 3.0])] * 7 + [(50, [-1.0, 2.0, 0.5, 0.0])] + rows[-3:] * 2 + [(3, [0.0] * 4)] * 2
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(table, F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.collect())) == rows_top_k(rows, lambda i: i % 50 == 0, 5)


def test_largest_doubles(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1e308, 1e308]), (2, [0.0, 1.5e308]), (3, [1e20, -1e300]), (4, [2.0, 0.0]), (5, [2.0, 9.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = rows_top_k(rows, lambda i: i == 0, 4)
    assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") == 0, 4).collect())) == want
    with pytest.raises(Exception, match="more than 38 digits"):
        topk.top_k(table, F.col("vec_id") == 2, 5).collect()


def test_negative_floor_beside_high_ones():
    """A query opposite to the hot direction, in a bucket of mixed lengths that
    the other queries search by coordinate."""
    vectors = np.array([[0.0, 100.0], [-4.0, 0.5], [-90.0, 1.0], [0.5, 99.0]])
    queries = np.array([[250.0, 51.0]] + [[0.0, 256.0]] * 9) / 256
    floor = np.array([-10.0] + [95.0] * 9) * topk.UNIT
    best = topk._Best(np.arange(100, 110), floor, 4)
    topk._search_tile(best, queries, np.arange(4), vectors)
    assert sorted(best.vector[best.query == 0].tolist()) == [0, 1, 3]
    assert best.score[(best.query == 0) & (best.vector == 1)].tolist() == [(-4 * 250 + 51 // 2) * 256 + 128]


# --- benchmark passages -----------------------------------------------------


def brute_hits(documents, items):
    windows = {}
    for item, text in items:
        listed = words(text)
        for k in range(max(1, len(listed) - 9) if listed else 0):
            windows.setdefault(tuple(listed[k : k + 10]), set()).add("" if item is None else str(item))
    rows = []
    for doc_id, text in documents:
        listed, found = words(text), set()
        hit = [False] * len(listed)
        for size in {len(w) for w in windows}:
            for k in range(len(listed) - size + 1):
                if tuple(listed[k : k + size]) in windows:
                    found |= windows[tuple(listed[k : k + size])]
                    hit[k : k + size] = [True] * size
        rows.append((doc_id, len(listed), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(rows, key=str)


def test_words_built_to_collide_are_no_passage(spark):
    one, other = alike_under_overflow()
    documents = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {other} y")], "doc_id long, text string")
    items = spark.createDataFrame([(7, one)], "item_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate.benchmark_digests(documents, items).collect()} == {1: True, 2: False}


@pytest.mark.parametrize("round_words", [2_000_000, 60])
def test_benchmark_passages(spark, monkeypatch, round_words):
    monkeypatch.setattr(decontaminate, "ROUND_WORDS", round_words)
    choose = random.Random(9)
    text = lambda n: choose.choice((" ", ", ")).join(choose.choice(("a", "B", "cé", "d1", "ee")) for _ in range(n))
    items = [(k, text(choose.randrange(25))) for k in range(12)] + [(3, "a b"), (None, "zq zq"), (50, None), (51, "")]
    documents = [(k, text(choose.randrange(80))) for k in range(150)]
    documents += [(200 + k, f"{text(5)} {items[k][1]} {text(5)}") for k in range(12)] + [(None, "x zq zq"), (7, None), (8, "")]
    documents += [(300, "a b " * 20_000)]
    given = spark.createDataFrame([(d, t, 1) for d, t in documents], "doc_id long, text string, n_hit int").repartition(4)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, starts string")
    got = decontaminate.benchmark_digests(given, benchmark).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_hits(documents, items)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    clean = {r.doc_id for r in got if not r.contaminated}
    kept = decontaminate.drop_contaminated(given, benchmark)
    assert kept.columns == given.columns and {r.doc_id for r in kept.collect()} == clean


def test_proximity_and_empties(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    documents = [(1, "one two three four and five six seven eight nine ten"), (2, "ten nine eight seven six five four three two one"), (3, None)]
    given = spark.createDataFrame(documents, "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontaminate.benchmark_digests(given, benchmark).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (0, 0)}
    assert decontaminate.benchmark_digests(empty_table(spark), benchmark).collect() == []
    assert decontaminate.benchmark_digests(given, benchmark.limit(0)).where("n_hit > 0").count() == 0


def brute_near(text, items):
    listed, n = words(text), 0
    for _, item in items:
        test = words(item)
        windows = [test[k : k + 10] for k in range(len(test) - 9)]
        n += any(
            sum(w in listed[max(s + o - 2, 0) : max(s + o + 3, 0)] for o, w in enumerate(window)) >= 8
            for window in windows for s in range(-12, len(listed) + 3)
        )
    return n


def test_proximity_by_any_word(spark):
    """The rarest word replaced, shifted, and unseen in the corpus; and random edits."""
    choose = random.Random(4)
    common = [f"w{k}" for k in range(30)]
    items = [(k, " ".join([*choose.sample(common, 6), f"name{k}", *choose.sample(common, choose.randrange(3, 11))])) for k in range(25)]
    documents = []
    for k, text in items:
        listed = text.split()
        at = listed.index(f"name{k}")
        without = [*listed[:at], "other", *listed[at + 1 :]], [*listed[:at], *listed[at + 1 :]]
        documents += [edit if k % 2 else [*choose.sample(common, 4), *edit] for edit in without]
        if k >= 20:
            continue  # these names occur nowhere
        documents += [[*listed[: at - 1], listed[at], listed[at - 1], *listed[at + 1 :]], [f"name{k}", "x"]]
        cut = choose.randrange(3, 8)  # a window over two texts is none
        documents += [["x", *listed[:cut]], [*listed[cut:], "x"]]
    for _ in range(150):
        listed = choose.choice(items[:20])[1].split()
        for _ in range(choose.randrange(5)):
            at = choose.randrange(len(listed))
            listed[at : at + choose.randrange(2)] = choose.sample(common, choose.randrange(2))
        documents.append(listed)
    texts = [(k, " ".join(listed)) for k, listed in enumerate(documents)]
    given = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.n_near for r in decontaminate.benchmark_digests(given, benchmark).collect()}
    want = {k: brute_near(text, items) for k, text in texts}
    assert got == want and 50 < sum(map(bool, want.values())) < len(want)


# --- byte BPE ---------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    ranks = bpe.read_ranks(None, PATH)
    return tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk", [bpe.CHUNK_BYTES, 2000])
def test_encoding(spark, known, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", chunk)
    choose = random.Random(1)
    pieces = ["a", "ab", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\xa0", "²", "½", "é", "ÿ", "漢", "🙂", "9", "12", "!", "?_", "<|endoftext|>", "ſ", "\u3000"]
    rows = [(20 + k, "".join(choose.choice(pieces) for _ in range(choose.randrange(20)))) for k in range(3000)]
    rows += [(9000 + k, t) for k, t in enumerate(("a" * 9000, " " * 9000, "ab" * 9000, "é\n " * 3000, "<|endoftext|>"))]
    given = odd_table(spark, rows).repartition(4)
    got = bpe.encode_documents(given, PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(got) == len(rows) + len(ODD)
    texts = dict([*ODD, *rows])
    for row in got:
        if row.doc_id is not None:
            text = texts[row.doc_id] or ""
            assert row.ids == known.encode_ordinary(text), text[:80]
            assert row.n_tokens == len(row.ids)
            assert row.ids_sha256 == hashlib.sha256(np.array(row.ids, dtype="<u4").tobytes()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_small_memo(known, monkeypatch):
    """Ids do not depend on what the memo still holds."""
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 4)
    codec = bpe.Codec(bpe.read_ranks(None, PATH), public_tokenizers.PATTERN)
    texts = ["one two  three\n", "", "two\xa0 one", " three three two", "one"] * 3
    ids, starts = codec.encode(pa.array(texts))
    assert [ids[s:e].tolist() for s, e in zip(starts[:-1], starts[1:])] == [known.encode_ordinary(t) for t in texts]
    ids, starts = codec.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and starts.tolist() == [0]


def test_decoding(spark):
    texts = ["plain text", "", "é 漢字 🙂", "a\n\n  b"]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = bpe.encode_documents(given, PATH, public_tokenizers.PATTERN, with_ids=True)
    assert [r.text for r in bpe.decode_documents(encoded, PATH).orderBy("doc_id").collect()] == texts
    assert bpe.encode_documents(empty_table(spark), PATH, public_tokenizers.PATTERN).collect() == []
    some = spark.createDataFrame([(1, [64, 65]), (2, None), (3, []), (None, [66])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode_documents(some, PATH).orderBy("doc_id").collect()] == ["c", "ab", "", ""]


def test_perfect_hash():
    keys = [str(k).encode() for k in range(5000)]
    table = bpe.MinimalPerfectHash(keys)
    assert sorted(map(table.slot, keys)) == list(range(5000))
