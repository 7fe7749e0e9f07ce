"""Places of pattern matches in texts, in JVM expressions only.

A span is struct<kind, rank, start, end, value, before>: code points, end
exclusive; ``rank`` orders kinds, ``before`` is the end of the text between the
match and the previous match of the same kind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<kind:string,rank:int,start:int,end:int,value:string,before:string>"
# Code points of left context that a span carries.
CONTEXT = 64
# Spans handled in one go.
BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """What matches ``pattern`` (leftmost, not overlapping) and ``holds``;
    matches that don't hold are dropped after matching."""

    name: str
    pattern: str
    holds: Callable[[Column], Column] = lambda value: F.lit(True)


def in_blocks(items: Column, size: Column, each: Callable[[Column, Column], Column]) -> Column:
    """``each(block, number)`` of every BLOCK items, joined in order.  A step over
    a whole list that builds a list copies it each time; here only a block's."""
    numbers = F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int"))
    # A block is cut out once: as the one item of a list.
    one = lambda b: F.transform(F.array(F.slice(items, b * BLOCK + 1, F.lit(BLOCK))), lambda block: each(block, b))
    return F.flatten(F.flatten(F.transform(numbers, one)))


def _running(totals: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What ``add`` makes of 0 and the totals before each."""
    state = "struct<at:int,out:array<int>>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")).cast(state)
    step = lambda s, t: F.struct(add(s["at"], t).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")).cast(state)
    return F.aggregate(totals, first, step)["out"]


def _length(pair: Column) -> Column:
    return F.length(pair["gap"]) + F.coalesce(F.length(pair["value"]), F.lit(0))


def _starts(pairs: Column) -> Column:
    """Where the text of each block of pairs begins."""
    total = lambda block, _: F.array(F.aggregate(block, F.lit(0), lambda t, p: t + _length(p)))
    starts = _running(in_blocks(pairs, F.size(pairs), total), lambda at, t: at + t)
    return F.when(F.size(pairs) > BLOCK, starts).otherwise(F.array(F.lit(0)))


def _spans(kind: Kind, rank: int, pairs: Column, starts: Column) -> Column:
    """The text between matches is what ``split`` leaves, so the running sum of
    both kinds of lengths is every match's place."""
    state = f"struct<at:int,found:array<{SPAN}>>"

    def step(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["value"]), F.lit(0))
        span = F.struct(
            F.lit(kind.name).alias("kind"), F.lit(rank).alias("rank"), start.alias("start"), end.alias("end"),
            pair["value"].alias("value"), F.right(pair["gap"], F.lit(CONTEXT)).alias("before"),
        ).cast(SPAN)
        holds = F.coalesce(pair["value"].isNotNull() & kind.holds(pair["value"]), F.lit(False))
        found = F.when(holds, F.concat(so_far["found"], F.array(span))).otherwise(so_far["found"])
        return F.struct(end.alias("at"), found.alias("found")).cast(state)

    none = F.array().cast(f"array<{SPAN}>")
    first = lambda b: F.struct(F.get(starts, b).alias("at"), none.alias("found")).cast(state)
    found = in_blocks(pairs, F.size(pairs), lambda block, b: F.aggregate(block, first(b), step)["found"])
    # Named twice, so that Spark computes the starts once and not for each block.
    return F.when((F.size(pairs) > 0) & (F.size(starts) > 0), found).otherwise(none)


def with_spans(table: DataFrame, text_col: str, kinds: list[Kind], prefix: str = "_spans_") -> DataFrame:
    """``table`` with one array of spans for each kind, column ``prefix + name``."""
    names = [k.name for k in kinds]
    matches = {f"_matches_{k.name}": F.regexp_extract_all(F.col(text_col), F.lit(k.pattern), F.lit(0)) for k in kinds}

    def pairs(kind: Kind) -> Column:
        met = F.col(f"_matches_{kind.name}")
        between = F.split(F.col(text_col), kind.pattern, -1)
        return F.when(F.size(met) > 0, F.arrays_zip(between.alias("gap"), met.alias("value")))

    paired = table.withColumns(matches).withColumns({f"_pairs_{k.name}": pairs(k) for k in kinds})
    placed = paired.withColumns({f"_starts_{n}": _starts(F.col(f"_pairs_{n}")) for n in names})
    spans = {f"{prefix}{k.name}": _spans(k, r, F.col(f"_pairs_{k.name}"), F.col(f"_starts_{k.name}")) for r, k in enumerate(kinds)}
    return placed.withColumns(spans).drop(*(f"_{c}_{n}" for c in ("matches", "pairs", "starts") for n in names))


def without_overlaps(table: DataFrame, column: str, others: Column) -> DataFrame:
    """``table`` with the spans of ``column`` that none of ``others`` overlaps.
    A block of spans, which are in order, looks at what overlaps its reach."""
    items = F.col(column)

    def kept(block: Column, _: Column) -> Column:
        low, high = F.get(block, F.lit(0))["start"], F.element_at(block, -1)["end"]
        near = F.filter("_others", lambda o: (o["start"] < high) & (o["end"] > low))
        hit = lambda near: F.filter(
            block, lambda s: ~F.exists(near, lambda o: (o["start"] < s["end"]) & (o["end"] > s["start"]))
        )
        # The list of near ones is made once: as the one item of a list.
        return F.flatten(F.transform(F.array(near), hit))

    places = F.transform(others, lambda o: F.struct(o["start"].alias("start"), o["end"].alias("end")))
    free = F.when((F.size(items) == 0) | (F.size("_others") == 0), items).otherwise(in_blocks(items, F.size(items), kept))
    return table.withColumn("_others", places).withColumn(column, free).drop("_others")


def listed(spans: Column, *order: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined, in the order of the named
    fields."""
    keyed = F.transform(
        spans,
        lambda s: F.struct(*(s[o] for o in order), F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("text")),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["text"]), ",")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two hashes that tell rows apart; equal rows have equal spans anyhow."""
    return [
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key1"),
        F.xxhash64(F.lit(17), F.col(text_col), F.col(id_col)).alias("_key2"),
    ]


def with_replaced(table: DataFrame, text_col: str, spans: Column, mark: str) -> DataFrame:
    """``table`` with every span of the text, overlapping ones as one, replaced
    by ``mark``.  A block's text is cut out first, its parts from that."""
    text, ordered = F.col(text_col), F.col("_ordered")
    state = "struct<at:int,out:array<string>>"
    last = lambda block: F.array_max(F.transform(block, lambda s: s["end"]))

    def cut(block: Column, b: Column) -> Column:
        begun = F.get("_reached", b)
        own = F.substring(text, begun + 1, F.greatest(last(block) - begun, F.lit(0)))

        def step(so_far: Column, s: Column, own: Column) -> Column:
            plain = F.substring(own, so_far["at"] - begun + 1, s["start"] - so_far["at"])
            more = F.concat(so_far["out"], F.array(plain, F.lit(mark)))
            out = F.when(s["start"] >= so_far["at"], more).otherwise(so_far["out"])
            return F.struct(F.greatest(s["end"], so_far["at"]).alias("at"), out.alias("out")).cast(state)

        first = F.struct(begun.alias("at"), F.array().cast("array<string>").alias("out")).cast(state)
        parts = lambda own: F.aggregate(block, first, lambda a, s: step(a, s, own))["out"]
        return F.flatten(F.transform(F.array(own), parts))

    sorted_ = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    ends = in_blocks(ordered, F.size(ordered), lambda block, _: F.array(last(block)))
    reached = F.when(F.size(ordered) > BLOCK, _running(ends, lambda at, e: F.greatest(at, e))).otherwise(F.array(F.lit(0)))
    rest = F.substring(text, last(ordered) + 1, F.length(text))
    whole = F.concat(F.array_join(in_blocks(ordered, F.size(ordered), cut), ""), rest)
    placed = table.withColumn("_ordered", sorted_).withColumn("_reached", reached)
    return placed.withColumn(text_col, F.when((F.size(ordered) > 0) & (F.size("_reached") > 0), whole).otherwise(text)).drop("_ordered", "_reached")
