"""Secrets, and credentials that show only by their parts standing together.

JVM expressions only.  Strong secrets are pattern matches.  Weak candidates
(short assigned values, bare 40-character keys) are reported only when a
complementary part, an identifier or an endpoint, lies within ``SCOPE`` code
points of the same text: an interval join of parts, on bins of positions, so
that a text with very many parts is many small join keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.spans import SPAN, Kind, listed, row_key, with_replaced, with_spans, without_overlaps
from earshot.llm.tables import keep, text_of
from earshot.operators.hold import small_side

SCOPE = 200
BIN = 256
MARK = "[SECRET]"

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_VALUE_LENGTH = lambda value: F.length(F.regexp_extract(value, _ASSIGN, 1))

STRONG = [
    Kind("assign", _ASSIGN, lambda value: _VALUE_LENGTH(value) >= 12),
    Kind("access", "AKIA[A-Z0-9]+", lambda value: F.length(value) >= 18),
    # Runs of 16 and more are what is left of all runs when shorter ones go.
    Kind("hex", "[0-9a-f]{16,}+"),
]
# Parts that mean little alone.
WEAK = [
    Kind("short", _ASSIGN, lambda value: _VALUE_LENGTH(value).between(6, 11)),
    Kind("bare", r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", lambda v: v.rlike("[A-Z]") & v.rlike("[0-9]")),
]
COMPLEMENT = [
    Kind("identifier", r"""(?i:access_?key_?id|client_?id|user_?name|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}+"""),
    Kind("endpoint", r"""(?i:https?|jdbc:[a-z]{1,20}|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|s3)://[^\s"'<>]++"""),
]
LINKED = "linked"


def _all(names: list[str]) -> Column:
    return F.concat(*(F.col(f"_spans_{n}") for n in names))


def _parts(table: DataFrame, spans: Column, reach: int) -> DataFrame:
    """A row for each part and bin that it, widened by ``reach``, touches."""
    rows = table.select("_key1", "_key2", F.explode(spans).alias("part"))
    low = F.floor((F.col("part.start") - reach) / BIN)
    high = F.floor((F.col("part.end") - 1 + reach) / BIN)
    return rows.select(
        "_key1", "_key2", F.col("part.start").alias("start"), F.col("part.end").alias("end"),
        F.explode(F.sequence(low, high)).alias("bin"),
    )


def _linked(table: DataFrame) -> DataFrame:
    """(_key1, _key2, linked): weak candidates with a complementary part near."""
    weak = _parts(table, _all([k.name for k in WEAK]), SCOPE).alias("w")
    near = _parts(table, _all(["access", *(k.name for k in COMPLEMENT)]), 0).alias("c")
    same = [F.col(f"w.{k}") == F.col(f"c.{k}") for k in ("_key1", "_key2", "bin")]
    reach = (F.col("c.start") < F.col("w.end") + SCOPE) & (F.col("c.end") > F.col("w.start") - SCOPE)
    found = weak.join(near, [*same, reach], "left_semi").select("_key1", "_key2", "start", "end").distinct()
    span = F.struct(
        F.lit(LINKED).alias("kind"), F.lit(len(STRONG)).alias("rank"), "start", "end",
        F.lit("").alias("value"), F.lit("").alias("before"),
    ).cast(SPAN)
    return found.groupBy("_key1", "_key2").agg(F.collect_list(span).alias("_spans_linked"))


def _scanned(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, keys, spans of all kinds) of every row."""
    given = documents.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    keyed = given.select("doc_id", "text", *row_key("doc_id", "text"))
    spans = with_spans(keyed, "text", [*STRONG, *WEAK, *COMPLEMENT]).drop("text")
    return without_overlaps(spans, "_spans_bare", F.col("_spans_assign"))


def _spans_of(kinds: list[str]) -> Column:
    return F.concat(*(F.coalesce(f"_spans_{k}", F.array().cast(f"array<{SPAN}>")) for k in kinds))


def find_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, strong, spans): for each row its strong spans, and all spans.

    Null and empty texts have no spans.  Repeated rows each get their spans; a
    null id is an id like any other.  Other columns are ignored.
    """
    table = keep(_scanned(documents, id_col, text_col), "secret-parts")
    with_all = table.join(_linked(table), ["_key1", "_key2"], "left")
    strong = [k.name for k in STRONG]
    return with_all.select(
        "doc_id", *(F.size(f"_spans_{k}").cast("long").alias(f"n_{k}") for k in strong),
        _spans_of(strong).alias("strong"), _spans_of([*strong, LINKED]).alias("spans"),
    )


def redact_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns, every secret replaced by ``[SECRET]``.

    Strong secrets are found where the text is; only the few linked ones come
    by a join, of a side whose size is checked.  Null texts stay null.
    """
    linked = small_side(_linked(keep(_scanned(documents, id_col, text_col), "secret-parts")))
    text = text_of(text_col)
    keyed = documents.withColumns({"_key1": F.xxhash64(F.col(id_col), text), "_key2": F.xxhash64(F.lit(17), text, F.col(id_col))})
    spans = with_spans(keyed, text_col, STRONG).join(linked, ["_key1", "_key2"], "left")
    return with_replaced(spans, text_col, _spans_of([*(k.name for k in STRONG), LINKED]), MARK).select(*documents.columns)


def secret_digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    found = find_secrets(documents, id_col, text_col)
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(listed(F.col("strong"), "start", "rank"), 256).alias("base_sha256"),
        listed(F.col("spans"), "start", "rank").alias("spans"),
    )
