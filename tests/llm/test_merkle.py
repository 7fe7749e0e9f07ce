"""The manifest against a plain tree built in Python."""

import hashlib
import zlib

from earshot.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, idx int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return digest("".join(enc(v) for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root, and for each leaf the siblings as (digest, it is left)."""
    at = list(range(len(nodes)))
    proofs = [[] for _ in nodes]
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            other = place ^ 1
            proofs[leaf].append((nodes[other], other < place) if other < len(nodes) else None)
        at = [p // 2 for p in at]
        nodes = [digest("".join(nodes[k : k + 2])) for k in range(0, len(nodes), 2)]
    return (nodes[0] if nodes else None), proofs


def brute(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    ordered, subroots, below = {}, [], {}
    for lang in langs:
        ordered[lang] = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r[:5])))
        subroot, below[lang] = tree([leaf_of(*r[:5]) for r in ordered[lang]])
        subroots.append(subroot)
    root, above = tree(list(subroots))
    out = []
    for k, lang in enumerate(langs):
        for row, proof in zip(ordered[lang], below[lang]):
            path = proof + above[k]
            doc_id, text, lang_, source, n_chars = row[:5]
            known = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            now = leaf_of(doc_id, text, lang_, source, n_chars + 1 if known and n_chars is not None else n_chars)
            for step in path:
                now = digest(now if step is None else step[0] + now if step[1] else now + step[0])
            joined = digest("".join(s[0] for s in path if s))
            out.append((doc_id, leaf_of(*row[:5]), subroots[k], root, joined, now, now == root))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def results(spark, rows):
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    return [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in found.collect()]


ODD = [
    (5, None, None, None, None), (6, "", "", "", 0), (7, "x" * 300_000, "en", "s", 300_000), (7, "other", "en", "s", 5),
    (8, "twice", "en", "s", 5), (8, "twice", "en", "s", 5), (None, "no id", "de", None, 5), (None, "none", "é", "s", 4),
    (-3, "漢\x00", "ZZ", "s", 2), (2**62, "big", "de", "s", None),
]


def test_small_trees(spark):
    rows = [(100 * n + k, f"text {k}", f"lang{n}", "s", k, "clash", 1) for n in (1, 2, 3, 4, 5, 17) for k in range(n)]
    assert order(results(spark, rows)) == order(brute(rows))
    assert order(results(spark, rows[:1])) == order(brute(rows[:1]))


def test_odd_rows_and_large_trees(spark):
    rows = [(*r, "clash", 1) for r in ODD]
    rows += [(1000 + k, f"text {k}", ("en", "fr", None)[min(k % 7, 2)], f"src{k % 3}", k if k % 5 else None, None, None) for k in range(1500)]
    found = results(spark, rows)
    assert order(found) == order(brute(rows))
    verified = {r[0]: r[-1] for r in found}
    assert not all(verified.values()) and sum(verified.values()) > len(verified) / 2


def test_no_rows(spark):
    assert results(spark, []) == []
