"""Allow and block rules on URLs, all at once by a bit-parallel automaton.

A rule is a host and a path glob.  Rules are packed side by side into 64-bit
masks, one bit for each symbol.  A step of Shift-And moves every rule of every
URL by one byte: ``D = (((D << 1) | first) & match[byte]) | (D & loop[byte])``,
where ``loop`` holds the bits of ``*``.  URLs are rows of a byte matrix, so a
step is a few array operations for a whole batch.

The canonical form is ``.host/`` and the path, whose own slash follows: no host
holds a slash, so the first one ends it.  A rule's host fits the URL's host and
its subdomains: each rule begins with a wildcard that only host bytes pass, and
a dot.  A ``*`` in a host passes host bytes, one in a path passes any.  A path
fits as a prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm import tokens

# Bytes of masks stepped together; each URL costs a row of ``width`` masks.
BLOCK_BYTES = 1 << 20
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
]


class Automaton:
    """Masks of all rules.  The longest rule that fits wins, of equally long
    ones that with the longer host, then the one listed first."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: (-len(r.text), -len(r.host)))
        symbols: list[tuple[int, bool]] = []  # byte, or -1 for a wildcard; host part
        firsts, finals = [], []
        for rule in self.rules:
            firsts.append(len(symbols))
            host = ("*." + _lower(rule.host) + "/").encode()
            # A prefix needs no wildcard at its end.
            path = rule.path.encode().rstrip(b"*")
            symbols += [(-1 if b == 42 else b, True) for b in host]
            symbols += [(-1 if b == 42 else b, False) for b in path]
            finals.append(len(symbols) - 1)
        self.finals = np.array(finals, dtype=np.int64)
        self.width = max(1, -(-len(symbols) // 64))
        bits = self.width * 64
        match = np.zeros((256, bits), dtype=bool)
        wild = np.zeros(bits, dtype=bool)
        begin = np.zeros(bits, dtype=bool)
        begin[firsts] = True
        for at, (byte, in_host) in enumerate(symbols):
            if byte < 0:
                match[:, at] = np.arange(256) != 47 if in_host else True
                wild[at] = True
            else:
                match[byte, at] = True
        self.match = self._packed(match)
        self.wild, self.begin = self._packed(wild[None])[0], self._packed(begin[None])[0]

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def _after(self, state: np.ndarray) -> np.ndarray:
        """The bits behind those of ``state``, within each rule."""
        moved = state << np.uint64(1)
        moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return moved & ~self.begin

    def _ready(self, bits: np.ndarray) -> np.ndarray:
        """Bits that may take the next byte: these, and those behind wildcards,
        which may be empty."""
        while True:
            more = bits | self._after(bits & self.wild)
            if (more == bits).all():
                return bits
            bits = more

    def _fitting(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(URLs, rules): whether each rule fits, of URLs ``data`` cut at ``offsets``."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        longest_first = lengths[order]
        found = np.zeros((len(lengths), self.width), dtype=np.uint64)
        ready = np.repeat(self._ready(self.begin[None]), len(lengths), axis=0)
        for at in range(longest_first[0] if len(lengths) else 0):
            active = int(np.searchsorted(-longest_first, -at, side="left"))
            rows = order[:active]
            state = ready[:active] & self.match[data[offsets[rows] + at]]
            found[rows] |= state
            if not state.any():
                break
            ready = self._ready(self._after(state) | (state & self.wild))
        bit = np.uint64(1)
        return (found[:, self.finals // 64] >> (self.finals % 64).astype(np.uint64)) & bit > 0

    def winners(self, urls: pa.Array) -> np.ndarray:
        """Index of the winning rule of each canonical URL, -1 for none."""
        winner = np.full(len(urls), -1)
        if not self.rules:
            return winner
        data, offsets = tokens.bytes_of(urls)
        step = max(1, BLOCK_BYTES // (8 * self.width))
        for low in range(0, len(urls), step):
            fits = self._fitting(data, offsets[low : low + step + 1])
            winner[low : low + step] = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
        return winner


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def _host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    capitals = "".join(map(chr, range(65, 91)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), capitals, _lower(capitals))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule] | None = None,
    default: str = ALLOW,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row.

    ``host`` is what stands between the first ``://`` and the next ``/``, ``?``
    or ``#``, in lower case; ``path`` goes on to ``?`` or ``#``.  URLs that are
    null or have no ``://`` have neither and fit no rule.  ``rule`` is the text
    of the longest rule that fits, else null, and the verdict ``default``.
    Repeated rows and null ids stay; other columns are not read.
    """
    host, path = _host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    shared = pages.sparkSession.sparkContext.broadcast(Automaton(RULES if rules is None else rules))
    id_type = parts.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        names = pa.array([r.text for r in automaton.rules], pa.string())
        verdicts = pa.array([r.verdict for r in automaton.rules], pa.string())
        for batch in batches:
            winner = automaton.winners(batch.column(3))
            index = pa.array(winner, mask=winner < 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], names.take(index), verdicts.take(index).fill_null(default)],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    canonical = parts.withColumn("_url", F.concat(F.lit("."), "host", F.lit("/"), "path"))
    return canonical.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, verdict string")


def allowed_pages(pages: DataFrame, rules: list[Rule] | None = None, default: str = ALLOW) -> DataFrame:
    """(page_id) of the rows whose URL is allowed."""
    return judge_urls(pages, rules, default).where(F.col("verdict") == ALLOW).select("page_id")
