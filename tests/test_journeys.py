"""Sessions and next events against plain loops, and how work is dealt out."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from earshot.operators import journeys

START = datetime(2024, 3, 1)
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"


def some_events(n, seed):
    """One customer has a third of the rows; times repeat; some rows lack parts."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        user = 1 if rng.random() < 0.34 else rng.randrange(2, 12)
        at = START + timedelta(seconds=rng.choice([rng.randrange(0, 86_400 * 9), 3600 * rng.randrange(0, 200)]))
        rows.append((k, at, user, rng.choice(["view", "call", "mail"])))
    return rows + [(n, None, 1, "call"), (n + 1, START, None, "call"), (n + 2, START + timedelta(hours=3), 2, None)]


def usable(rows):
    return sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[2], r[1], r[0]))


def brute_sessions(rows, gap):
    found, last = {}, None
    for event, at, user, _ in usable(rows):
        if last is None or last[0] != user:
            number = 1
        elif (at - last[1]).total_seconds() > gap:
            number += 1
        found[event], last = (user, number), (user, at)
    return found


def brute_next(rows, wanted, within):
    ordered, found = usable(rows), {}
    for k, (event, at, user, _) in enumerate(ordered):
        later = next((r for r in ordered[k + 1 :] if r[2] == user and r[3] in wanted), None)
        near = later and (within is None or (later[1] - at).total_seconds() <= within)
        found[event] = later[0] if near else None
    return found


@pytest.mark.parametrize("block", [60, 5000, 86_400, 10**9])
@pytest.mark.parametrize("gap", [0, 1800, 100_000])
def test_sessions(spark, block, gap):
    rows = some_events(500, gap)
    events = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = journeys.sessionise(events, gap, block_seconds=block)
    want = brute_sessions(rows, gap)
    assert {r["event_id"]: (r["user_id"], r["session"]) for r in found.collect()} == want
    whole = journeys.sessions(events, gap, block_seconds=block).collect()
    assert {(r["user_id"], r["session"]): r["n"] for r in whole} == {s: list(want.values()).count(s) for s in set(want.values())}


@pytest.mark.parametrize("block", [60, 86_400, 10**9])
@pytest.mark.parametrize("within", [None, 0, 7200])
def test_next_event(spark, block, within):
    rows = some_events(500, block)
    events = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = journeys.next_event(events, F.col("event_type").isin("call", "mail"), within, block_seconds=block)
    assert {r["event_id"]: r["next_id"] for r in found.collect()} == brute_next(rows, ("call", "mail"), within)
    times = {r[0]: r[1] for r in rows}
    assert all(r["next_time"] == (times[r["next_id"]] if r["next_id"] is not None else None) for r in found.collect())


def test_reports(spark):
    rows = some_events(400, 3)
    events = spark.createDataFrame(rows, SCHEMA)
    following = brute_next(rows, ("call",), 7200)
    repeated = journeys.repeat_contacts(events, F.col("event_type") == "call", 7200).first()
    calls = [r[0] for r in usable(rows) if r[3] == "call"]
    met = sum(following[c] is not None for c in calls)
    assert (repeated["contacts"], repeated["repeated"], repeated["rate"]) == (len(calls), met, met / len(calls))
    deflected = journeys.deflection(events, F.col("event_type") == "view", F.col("event_type") == "call", 7200).first()
    views = [r[0] for r in usable(rows) if r[3] == "view"]
    assert deflected["deflected"] == sum(following[v] is None for v in views) and deflected["visits"] == len(views)


def test_empty_and_arguments(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert journeys.sessions(none, 10).collect() == []
    assert journeys.next_event(none, F.lit(True)).collect() == []
    with pytest.raises(ValueError):
        journeys.sessionise(none, 10, block_seconds=0)


def test_a_hot_customer_is_many_tasks(spark):
    """Windows over events are dealt by customer and block, those over a customer
    see blocks only."""
    events = spark.createDataFrame(some_events(300, 1), SCHEMA)
    for table in (journeys.sessionise(events, 60), journeys.next_event(events, F.lit(True))):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("_block" in w for w in windows)
        over_customers = [w for w in windows if ", [user_id#" in w and "_block" not in w.split(", [user_id#")[1].split("]")[0]]
        assert over_customers and not any("_t#" in w for w in over_customers)
