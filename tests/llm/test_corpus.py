"""Quality, chat formatting, the pipeline, and the queries against their SQL."""

import hashlib
import random
from pathlib import Path

import pytest
from odd import ODD, empty_table, odd_table
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, database
from earshot.llm import bpe, chat, oracle, quality, queries
from test_minhash import brute
from test_search import PATH, brute_hits
from test_text_scans import base_secrets

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")


# --- quality ----------------------------------------------------------------


@needs_data
def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_quality(documents, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    assert scored.count() == documents.count()
    judged = scored.where("held_out").join(labels, "doc_id")
    right = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.95
    # Held-out labels are not read.
    hidden = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert scored.exceptAll(quality.score_quality(documents, hidden)).count() == 0


def test_odd_quality(spark):
    labels = spark.createDataFrame([(1, 1), (4, 1), (4, 1), (3, 0), (5, 0), (6, None), (None, 1), (9, 1)], "doc_id long, quality int")
    given = odd_table(spark)
    rows = quality.score_quality(given, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {r.score for r in quality.score_quality(given, labels.limit(0)).collect()} == {1.0}
    assert quality.score_quality(empty_table(spark), labels).collect() == []
    kept = quality.drop_poor(given, labels)
    assert kept.columns == given.columns and kept.count() == sum(r.predicted for r in rows)


# --- chat -------------------------------------------------------------------


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_only_chosen_paths_are_written(spark, monkeypatch):
    """A thread 300 deep with a leaf at each message: one path, 301 rows."""
    rows = [(1, k, k - 1 if k else None, "user", f"m{k}", 0.0) for k in range(300)]
    rows += [(1, 1000 + k, k, "assistant", f"leaf{k}", float(k == 299) + (k == 7) * 0.5 + (float("nan") if k == 9 else 0)) for k in range(300)]
    tree = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    written, real = [], chat.keep

    def counting(table, name):
        kept = real(table, name)
        if name == "paths":
            written.append(kept.count())
        return kept

    monkeypatch.setattr(chat, "keep", counting)
    one = chat.format_trees(tree).first()
    assert max(written) == 301 and one.formatted.endswith("leaf299</s>") and one.formatted.count("[/INST]") == 301
    two = {r.branch: r.formatted for r in chat.format_trees(tree, branches=2).collect()}
    assert two[2].endswith("leaf7</s>") and two[2].count("[/INST]") == 9


def test_trees(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "poor", 1.0), (1, 3, 1, "assistant", "good", 2.0),
        (1, 4, 3, "user", "thanks", 0.5), (1, 5, 3, "user", "more", 0.5), (2, 1, 99, "user", "no parent", None),
        (3, 1, 2, "user", "circle", 9.0), (3, 2, 1, "assistant", "circle", 9.0), (3, 3, 2, "user", "hangs on it", 9.0),
        (3, 4, None, None, None, 0.0), (None, 1, None, "user", "null id", 0.0), (None, 2, 1, "assistant", "yes", 0.0),
    ]
    tree = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    turns = chat.format_trees(tree, branches=2).withColumn("turns", chat.read_back(F.col("formatted")))
    got = {(r.conv_id, r.branch): [tuple(t) for t in r.turns] for r in turns.collect()}
    assert got == {
        (1, 1): [("user", "root"), ("assistant", "good"), ("user", "thanks")],
        (1, 2): [("user", "root"), ("assistant", "good"), ("user", "more")],
        (2, 1): [("user", "no parent")], (3, 1): [("", "")], (None, 1): [("user", "null id"), ("assistant", "yes")],
    }


def test_chains_and_control_strings(spark):
    choose = random.Random(2)
    pieces = ["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "[/INST]", "<s>", "é", "\n", " ok "]
    text = lambda: "".join(choose.choice(pieces) for _ in range(choose.randrange(9)))
    rows = [(c, t, choose.choice(("user", "assistant", "[INST]", "system")), text()) for c in range(60) for t in range(choose.randrange(1, 9))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(700)]
    rows += [(101, 0, "user", None), (101, None, None, "first"), (101, 0, "user", None), (None, 3, "assistant", "x")]
    choose.shuffle(rows)
    given = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, score int")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_trees(chat.chain(given))).collect()}
    first = lambda value: (value is not None, value)
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda t: (first(t[0]), t[1] or "", t[2] or ""))
        listed = "".join(f"{role or ''}\n{said or ''}\n" for _, role, said in turns)
        loss = "".join(said or "" for _, role, said in turns if role == "assistant")
        found = got[conv]
        assert (found.n_turns, found.turns_sha256) == (len(turns), digest(listed))
        assert (found.loss_chars, found.loss_sha256) == (len(loss), digest(loss))
    assert len(got) == len({r[0] for r in rows})
    assert chat.format_trees(chat.chain(given.limit(0))).collect() == []


# --- the pipeline -----------------------------------------------------------


@needs_data
def test_pipeline_stage_by_stage(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near-duplicates", "benchmark", "secrets", "tokens"]

    good = stages["quality"](spark, documents, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    accepted = quality.score_quality(documents, labels).where("predicted = 1")
    assert ids(good) == ids(accepted) and good.columns == documents.columns

    single = stages["near-duplicates"](spark, good, SF)
    components = brute([(r.doc_id, r.text) for r in good.collect()], 5)
    assert ids(single) == sorted({component for _, _, component in components})

    clean = stages["benchmark"](spark, single, SF)
    hits = brute_hits([(r.doc_id, r.text) for r in single.collect()], benchmark)
    assert ids(clean) == sorted(h[0] for h in hits if not h[2])

    redacted = stages["secrets"](spark, clean, SF)
    assert redacted.columns == documents.columns and ids(redacted) == ids(clean)
    before = {r.doc_id: r.text for r in clean.collect()}
    for row in redacted.collect():
        found = base_secrets(before[row.doc_id])
        assert (row.text == before[row.doc_id]) == (not found) or "[SECRET]" in row.text
        assert not base_secrets(row.text) and row.n_chars == len(row.text)

    tokens = stages["tokens"](spark, redacted, SF).collect()
    texts = {r.doc_id: r.text for r in redacted.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in tokens} == {d: digest(t) for d, t in texts.items()}

    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.drop("ids").collect())) == sorted(tuple(r)[:4] for r in tokens)


def ids(table):
    return sorted(r.doc_id for r in table.select("doc_id").collect())


def test_stages_take_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage in here at all my dear friend ok")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    given = odd_table(spark).withColumn("n_chars", F.lit(0).cast("long"))
    for docs in (given, given.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == given.columns
            stage(spark, docs, str(tmp_path)).collect()
        assert corpus_pipeline.encode_tokens(spark, docs, str(tmp_path)).count() == docs.count()


# --- the queries ------------------------------------------------------------


@needs_data
@pytest.mark.parametrize("name", list(oracle.statements()))
def test_query_equals_sql(spark, name):
    assert compare(spark, database(SF), name, SF) == ""


@needs_data
def test_every_operator_has_a_query(spark):
    named = queries.queries()
    assert [n.split("_")[0] for n in named] == [*(f"op{n}" for n in range(1, 11)), "pipeline"]
    want = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_license_scan", "op9_byte_bpe"):
        assert named[name](spark, SF).count() == want
    assert bpe.read_ranks(spark, f"file://{PATH}") == bpe.read_ranks(spark, PATH)
