"""Files, streams and whole jobs."""

import json

import pytest
from pyspark.sql import functions as F

from earshot.plans.run import run
from earshot.sources.contacts import CLEANED_CONTACT, read_contacts, write_contacts
from earshot.streaming.contacts import run_stream

TEXTS = {
    "phone": ["yeah hi um where is my order it has not arrived", "so I was charged twice, refund"],
    "email": ["Dear Team,\n\nMy parcel arrived damaged, awful.\n\nRegards,\nA", "Hello\nno reply from you\n"],
    "chat": ["i cant log in pls", "is it safe to take thx"],
    "social": ["@shop great help #happy", "@shop my gp says you have it https://x.y"],
}
RECORDS = [
    {"contact_id": f"{c}-{i}", "channel": c, "intent": "REFUND_BILLING", "vulnerability_flag": i == 0,
     "urgency_flag": None, "customer_placeholder": "é", "text": t, "_disclaimer": "made up"}
    for c, texts in TEXTS.items()
    for i, t in enumerate(texts)
]


@pytest.fixture
def raw(tmp_path):
    path = tmp_path / "raw" / "contacts.jsonl"
    path.parent.mkdir()
    lines = [{"_HEADER": "notice"}, *RECORDS]
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in lines), encoding="utf-8")
    return path


def test_read_skips_header(spark, raw):
    rows = read_contacts(spark, str(raw))
    assert rows.count() == len(RECORDS)
    assert "_HEADER" not in rows.columns and "_disclaimer" not in rows.columns
    assert rows.where("contact_id = 'email-0'").first()["text"] == TEXTS["email"][0]


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"contact_id": "1"}\n{broken\n')
    with pytest.raises(Exception, match="FAILFAST"):
        read_contacts(spark, str(tmp_path / "bad.jsonl")).collect()


def test_round_trip(spark, raw, tmp_path):
    table = read_contacts(spark, str(raw)).withColumn("cleaned_text", F.lit(None).cast("string"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second write replaces the first
        write_contacts(table, out, notice="illustrative")
    parts = [p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*")]
    lines = [json.loads(line) for part in parts for line in part.splitlines()]
    assert sum("_HEADER" in line for line in lines) == 1 and len(lines) == len(RECORDS) + 1
    assert any('"é"' in part for part in parts)
    assert all("cleaned_text" in line for line in lines if "_HEADER" not in line)
    back = read_contacts(spark, out, CLEANED_CONTACT)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_unknown_keys_pass_through(spark, raw, tmp_path):
    more = {**RECORDS[0], "contact_id": "more", "score": 1, "tags": ["a", {"b": None}]}
    (raw.parent / "more.jsonl").write_text(json.dumps(more) + "\n\n")
    table = read_contacts(spark, str(raw.parent), keep_extra=True)
    assert table.count() == len(RECORDS) + 1
    out = str(tmp_path / "kept")
    write_contacts(table, out)
    lines = [json.loads(line) for p in (tmp_path / "kept").glob("part-*") for line in p.read_text(encoding="utf-8").splitlines()]
    want = [*RECORDS, more]
    by_id = lambda rows: sorted(rows, key=lambda r: r["contact_id"])
    assert by_id(lines) == by_id(want)


def test_jobs_end_to_end(spark, raw, tmp_path):
    out = str(tmp_path / "jobs")
    made = run(spark, "preprocess", str(raw), out)
    assert made["cleaned"].count() == len(RECORDS) and made["preview"].count() == 4
    assert run(spark, "search", str(raw), out)["neighbours"].count() == 12
    made = run(spark, "classify", f"{out}/cleaned", out)
    rules = made["rules"].first()
    assert rules["total"] == 8 and rules["none_count"] == 2  # the greeting takes its line along
    assert made["predictions"].count() == 2 and made["knn"].first()["total"] == 2
    made = run(spark, "sentiment", f"{out}/cleaned", out)
    assert made["overall"].agg(F.sum("n")).first()[0] == 8
    made = run(spark, "topics", f"{out}/cleaned", out)
    assert made["assigned"].count() == 8 and made["alignment"].count() == 1


def test_stream_equals_batch(spark, raw, tmp_path):
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    go = lambda: run_stream(spark, str(raw.parent), target, checkpoint).awaitTermination()
    go()
    go()  # nothing new: nothing is added
    assert spark.read.parquet(target).count() == len(RECORDS)
    extra = {**RECORDS[0], "contact_id": "new", "channel": "fax"}
    (raw.parent / "more.jsonl").write_text(json.dumps(extra))
    go()
    rows = {r["contact_id"]: r for r in spark.read.parquet(target).collect()}
    assert len(rows) == len(RECORDS) + 1 and rows["new"]["cleaned_text"] is None
    assert rows["chat-0"]["predicted_intent"] == "APP_WEBSITE_ISSUE"
