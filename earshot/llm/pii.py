"""Personal data: patterns, and identifiers found by their contexts.

JVM expressions only.  Emails, IP addresses, cards and phone numbers are
matches of patterns.  These seed a bootstrap over the whole corpus:

* a *pattern* is the last word before a span, an *instance* a token that holds
  digits;
* the pattern-instance graph is scored in ``ROUNDS`` rounds.  A pattern's score
  is the share of all its occurrences in the corpus that are followed by an
  instance, each weighted by the instance's score; an instance's score is that
  of its best pattern, 1 for seeds;
* instances of at least ``LEAST_DIGITS`` digits, never seen as seeds, are
  reported where a pattern of at least ``LEAST_SCORE`` stands before them.

The graph is aggregated by Spark; hot words are partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.spans import SPAN, Kind, listed, row_key, with_spans, without_overlaps
from earshot.llm.tables import if_small, keep, release, text_of

ROUNDS = 3
LEAST_SCORE = 0.5
LEAST_SUPPORT = 3
LEAST_DIGITS = 4

_BYTE_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """From the right, every second digit doubled, its own digits summed."""
    backwards = F.reverse(digits)
    worth = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(worth, F.lit(0), lambda t, w: t + F.when(w > 9, w - 9).otherwise(w))
    return total % 10 == 0


# Lookbehind and \G let each run be tried once, from where it begins: a later
# start in the same run would fail in the same place.  Possessive loops don't
# recurse, so long texts cannot overflow the stack.
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind(
        "ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda value: value.rlike(rf"^{_BYTE_PART}(?:\.{_BYTE_PART}){{3}}$"),
    ),
    # Fewer than 16 digits never hold, so they need not match.
    Kind("card", "[0-9](?:[ -]?[0-9]){15,}+", lambda value: (F.length(_digits(value)) <= 19) & _luhn(_digits(value))),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda value: F.length(_digits(value)).between(8, 15)),
]
_CANDIDATE = Kind("candidate", r"(?<!\S)[^\s0-9]*+[0-9]\S*+", lambda value: F.length(_digits(value)) >= LEAST_DIGITS)
CONTEXT_KIND = "context"
_NAMES = [k.name for k in KINDS]


def _spans_of(names: list[str]) -> Column:
    return F.concat(*(F.coalesce(f"_spans_{n}", F.array().cast(f"array<{SPAN}>")) for n in names))


def _last_word(before: Column) -> Column:
    return F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1))


def _scanned(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given = documents.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    table = with_spans(given.select("doc_id", "text", *row_key("doc_id", "text")), "text", [*KINDS, _CANDIDATE])
    return without_overlaps(table.drop("text"), "_spans_candidate", _spans_of(_NAMES))


def _occurrences(table: DataFrame) -> DataFrame:
    """(key, start, end, pattern, instance, seed): spans with a word before."""
    of = lambda spans, seed: table.select("_key1", "_key2", F.explode(spans).alias("s"), F.lit(seed).alias("seed"))
    rows = of(_spans_of(_NAMES), 1).unionByName(of(F.col("_spans_candidate"), 0))
    return rows.select(
        "_key1", "_key2", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
        _last_word(F.col("s.before")).alias("pattern"), F.lower("s.value").alias("instance"), "seed",
    ).where("pattern <> ''")


def _frequencies(documents: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """(pattern, total): occurrences of the patterns' words in all texts."""
    words = documents.select(F.explode(F.split(F.lower(text_of(text_col)), r"[^\p{L}]++")).alias("pattern"))
    return words.join(if_small(patterns), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("total"))


def score_patterns(occurrences: DataFrame, documents: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pattern, p) and (instance, s) after ``ROUNDS`` rounds.  Patterns that
    stand before fewer than LEAST_SUPPORT different seeds take no part."""
    counted = occurrences.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    graph = keep(counted, "graph")
    support = graph.groupBy("pattern").agg(F.sum("seed").alias("support")).where(F.col("support") >= LEAST_SUPPORT)
    patterns = keep(support.select("pattern"), "patterns")
    totals = keep(_frequencies(documents, text_col, patterns), "totals")
    graph = graph.join(totals, "pattern")
    seeds = graph.groupBy("instance").agg(F.max("seed").cast("double").alias("s"))
    instances = keep(seeds, "instances")
    for _ in range(ROUNDS):
        scored = (
            graph.join(instances, "instance")
            .groupBy("pattern")
            # One more occurrence counts against each: a few prove little.
            .agg((F.sum(F.col("n") * F.col("s")) / (F.greatest(F.max("total"), F.sum("n")) + 1)).alias("p"))
        )
        weights = keep(scored, "pattern-scores")
        reached = graph.join(weights, "pattern").groupBy("instance").agg(F.max("seed").alias("seed"), F.max("p").alias("p"))
        after = keep(
            reached.select("instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("p")).alias("s")), "instances"
        )
        release(instances)
        instances = after
    return weights, instances


def find_personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row.

    Null and empty texts have no spans.  Repeated rows each get their spans; a
    null id is an id like any other.  Other columns are ignored.
    """
    table = keep(_scanned(documents, id_col, text_col), "personal-parts")
    occurrences = _occurrences(table)
    patterns, instances = score_patterns(occurrences, documents, text_col)
    good = patterns.where(F.col("p") >= LEAST_SCORE).select("pattern")
    known = instances.where(F.col("s") >= LEAST_SCORE).select("instance")
    span = F.struct(
        F.lit(CONTEXT_KIND).alias("kind"), F.lit(len(KINDS)).alias("rank"), "start", "end",
        F.lit("").alias("value"), F.lit("").alias("before"),
    ).cast(SPAN)
    discovered = (
        occurrences.where("seed = 0")
        .join(good, "pattern", "left_semi")
        .join(known, "instance", "left_semi")
        .groupBy("_key1", "_key2")
        .agg(F.collect_set(span).alias(f"_spans_{CONTEXT_KIND}"))
    )
    with_all = table.join(discovered, ["_key1", "_key2"], "left")
    return with_all.select(
        "doc_id", *(F.size(f"_spans_{n}").cast("long").alias(f"n_{n}") for n in _NAMES),
        _spans_of(_NAMES).alias("base"), _spans_of([*_NAMES, CONTEXT_KIND]).alias("spans"),
    )


def personal_data_digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    found = find_personal_data(documents, id_col, text_col)
    return found.select(
        "doc_id", *(f"n_{n}" for n in _NAMES),
        F.sha2(listed(F.col("base"), "rank", "start"), 256).alias("base_sha256"),
        listed(F.col("spans"), "rank", "start").alias("spans"),
    )
