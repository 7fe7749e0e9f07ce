"""Weekly spikes: batch against plain Python, a stream against the batch."""

import json
import random
import statistics
from datetime import datetime, timedelta

from earshot.operators import spikes
from earshot.streaming import spikes as streamed

SCHEMA = "event_time timestamp, intent string, sentiment_label string"
START = datetime(2024, 1, 1)  # a Monday


def some_contacts(seed=1, weeks=14):
    rng = random.Random(seed)
    rows = []
    for week in range(weeks):
        for intent, usual in (("A", 0.2), ("B", 0.5), (None, 0.1)):
            share = 0.9 if (intent, week) in (("A", 9), (None, 12)) else usual
            for _ in range(rng.randrange(20, 40) if (intent, week) != ("B", 6) else 0):
                at = START + timedelta(days=7 * week, seconds=rng.randrange(7 * 86_400))
                rows.append((at, intent, "negative" if rng.random() < share else rng.choice(["neutral", "positive", None])))
    return rows


def brute(rows, history=8, least=3):
    counts = {}
    for at, intent, label in rows:
        if at is not None:
            week = START + timedelta(days=7 * ((at - START).days // 7))
            n, negative = counts.get((intent or "UNKNOWN", week), (0, 0))
            counts[intent or "UNKNOWN", week] = n + 1, negative + (label == "negative")
    out = {}
    for (intent, week), (n, negative) in counts.items():
        before = [c[1] / c[0] for (i, w), c in sorted(counts.items()) if i == intent and w < week][-history:]
        usual = z = None
        if len(before) >= least:
            usual = statistics.median(before)
            apart = statistics.median(abs(s - usual) for s in before)
            z = (negative / n - usual) / max(1.4826 * apart, (usual * (1 - usual) / n) ** 0.5, 0.01)
        out[intent, week] = (n, negative, usual and round(usual, 9), z and round(z, 6), bool(z is not None and z >= 3 and n >= 5))
    return out


def shown(table):
    return {
        (r["intent"], r["week"]): (r["n"], r["negative"], r["usual"] and round(r["usual"], 9), r["z"] and round(r["z"], 6), r["spike"])
        for r in table.collect()
    }


def test_batch(spark):
    rows = [*some_contacts(), (None, "A", "negative")]
    found = shown(spikes.find_spikes(spikes.weekly_counts(spark.createDataFrame(rows, SCHEMA))))
    assert found == brute(rows)
    assert {k for k, v in found.items() if v[4]} >= {("A", START + timedelta(days=63)), ("UNKNOWN", START + timedelta(days=84))}
    assert spikes.find_spikes(spikes.weekly_counts(spark.createDataFrame([], SCHEMA))).collect() == []


def write(folder, name, rows):
    lines = [json.dumps({"event_time": at.isoformat(), "intent": i, "sentiment_label": s}) for at, i, s in rows]
    (folder / f"{name}.json").write_text("\n".join(lines))


def test_stream_with_late_files_equals_batch(spark, tmp_path):
    """Files in order of time, each with contacts up to six days late; a last one
    far ahead closes all weeks; a contact months late is left out."""
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()
    rng = random.Random(4)
    rows = some_contacts(seed=2)
    arrival = sorted(rows, key=lambda r: r[0] + timedelta(days=rng.choice([0, 0, 0, 6])))
    parts = [arrival[k : k + 200] for k in range(0, len(arrival), 200)]

    def run():
        scored = spark.readStream.schema(SCHEMA).json(str(source))
        query = streamed.stream_counts(scored, target, checkpoint)
        assert query.awaitTermination(120)

    for k, part in enumerate(parts):
        write(source, f"part{k:03}", part)
        run()
    some = spark.read.parquet(target).count()
    write(source, "later", [(START + timedelta(days=400), "A", "neutral")])
    run()
    write(source, "much-later", [(START + timedelta(days=3), "A", "negative"), (START + timedelta(days=800), "A", "neutral")])
    run()
    run()  # nothing new, nothing twice
    assert 0 < some < spark.read.parquet(target).count()
    found = shown(streamed.finished_spikes(spark, target))
    ahead = {k: v for k, v in found.items() if k[1] > START + timedelta(days=300)}
    assert {k: v for k, v in found.items() if k not in ahead} == brute(rows) and len(ahead) == 1
