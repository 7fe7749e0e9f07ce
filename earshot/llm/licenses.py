"""Licence passages by a generalised suffix automaton of their words.

The automaton holds every run of words of every template and phrase, so a text
streamed through it yields, at each word, the longest run that ends there
(matching statistics).  Runs of ``LEAST_RUN`` words and more that cannot be
lengthened are placed in their templates, and chained where they follow each
other in text and template; a chain that covers ``LEAST_COVER`` of a template
is a span of that licence.  Phrases are states with a mark of their own.

Templates are a small constant (some hundred words each).  Texts are handled
row by row in Arrow batches; only stretches of words that templates know are
streamed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm import tokens
from earshot.llm.templates import PHRASES, TEMPLATES

LEAST_RUN = 4
LEAST_COVER = 0.5
# Words of the text that may lie between two runs of one chain.
LARGEST_GAP = 20

SPANS = "array<struct<label:string,start:long,end:long,cover:double>>"


@dataclass
class State:
    length: int
    link: int
    next: dict[int, int] = field(default_factory=dict)
    # (template, word) pairs at which the state's runs end.
    ends: list[tuple[int, int]] = field(default_factory=list)
    # Phrases (index, words) that are endings of the state's longest run.
    phrases: list[tuple[int, int]] = field(default_factory=list)


class SuffixAutomaton:
    """Of several word sequences; each starts anew at the root."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [State(0, -1)]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.states[last].ends.append((number, place))
        # What ends at a state ends at every state its link leads to.
        for at in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            state = self.states[at]
            if state.link > 0:
                self.states[state.link].ends.extend(state.ends)
        for state in self.states:
            state.ends = sorted(set(state.ends))

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        known = states[last].next.get(word)
        if known is not None:
            if states[known].length == states[last].length + 1:
                return known
            return self._split(last, word, known)
        new = len(states)
        states.append(State(states[last].length + 1, 0))
        at = last
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = new
            at = states[at].link
        if at >= 0:
            target = states[at].next[word]
            exact = states[target].length == states[at].length + 1
            states[new].link = target if exact else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        states = self.states
        copy = len(states)
        states.append(State(states[at].length + 1, states[target].link, dict(states[target].next)))
        while at >= 0 and states[at].next.get(word) == target:
            states[at].next[word] = copy
            at = states[at].link
        states[target].link = copy
        return copy

    def walk(self, sequence: list[int]) -> int:
        at = 0
        for word in sequence:
            at = self.states[at].next[word]
        return at

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest known run that ends at each word."""
        states, at, length = self.states, 0, 0
        for word in words:
            while at and word not in states[at].next:
                at = states[at].link
                length = states[at].length
            if word in states[at].next:
                at, length = states[at].next[word], length + 1
            yield at, length


class Scanner:
    """Templates and phrases, ready to be found in texts."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = list(templates)
        split = lambda text: tokens.text_words([text], tokens.ALPHANUMERIC).hashes
        hashed = [split(t) for t in [*templates.values(), *phrases]]
        self.vocabulary = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, dtype=np.uint64)
        sequences = [np.searchsorted(self.vocabulary, h).tolist() for h in hashed]
        self.sizes = [len(s) for s in sequences[: len(self.labels)]]
        self.phrase_labels = list(phrases.values())
        self.phrase_sizes = [len(s) for s in sequences[len(self.labels) :]]
        self.automaton = SuffixAutomaton(sequences)
        states = self.automaton.states
        for number, sequence in enumerate(sequences[len(self.labels) :]):
            if sequence:
                states[self.automaton.walk(sequence)].phrases.append((number, len(sequence)))
        for at in sorted(range(1, len(states)), key=lambda s: states[s].length):
            states[at].phrases = states[at].phrases + states[states[at].link].phrases
        self.shortest = min([LEAST_RUN, *(n for n in self.phrase_sizes if n)])

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, -1 where templates lack it."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        index = np.searchsorted(self.vocabulary, hashes)
        index[index == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[index] == hashes, index, -1)

    def stretches(self, known: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(start, words) of maximal stretches of known words, long enough."""
        inside = np.concatenate([[False], known >= 0, [False]])
        steps = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = steps[::2], steps[1::2]
        long_ = ends - starts >= self.shortest
        for start, end in zip(starts[long_].tolist(), ends[long_].tolist()):
            yield start, known[start:end].tolist()

    def scan(self, stretches: list[tuple[int, list[int]]]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Phrase places (phrase, start) and runs (template, its start, text
        start, words)."""
        states = self.automaton.states
        places, runs = [], []
        for start, words in stretches:
            held = None
            for at, (state, length) in enumerate(self.automaton.statistics(words), start):
                for number, size in states[state].phrases:
                    if size <= length:
                        places.append((number, at - size + 1))
                # A run is maximal when the next word does not lengthen it.
                if held and length <= held[2]:
                    runs.extend(self._placed(*held))
                held = (at, state, length) if length >= LEAST_RUN else None
            if held:
                runs.extend(self._placed(*held))
        return places, runs

    def _placed(self, at: int, state: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        for template, end in self.automaton.states[state].ends:
            if template < len(self.labels) and end + 1 >= length:
                yield template, end - length + 1, at - length + 1, length

    def spans(self, runs: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chains that cover enough of their template: (label, start, end, share)."""
        found, chosen = [], {}
        for template in {r[0] for r in runs}:
            own = sorted((r[2], r[1], r[3]) for r in runs if r[0] == template)
            best: list[tuple[int, int, int]] = []  # (words covered, text start, previous)
            recent = 0
            for k, (text, place, size) in enumerate(own):
                covered, begun = size, text
                while own[recent][0] + own[recent][2] + LARGEST_GAP < text and recent < k:
                    recent += 1
                for j in range(recent, k):
                    t, p, s = own[j]
                    if p < place and t < text and text - (t + s) <= LARGEST_GAP:
                        fresh = size - max(0, p + s - place, t + s - text)
                        if fresh > 0 and best[j][0] + fresh > covered:
                            covered, begun = best[j][0] + fresh, best[j][1]
                best.append((covered, begun, text + size))
            share = [(c / self.sizes[template], begun, end) for c, begun, end in best]
            label = self.labels[template]
            taken = chosen.setdefault(label, [])  # (start, end) in order, apart from each other
            for cover, begun, end in sorted(share, key=lambda x: (-x[0], x[1])):
                if cover < LEAST_COVER:
                    break
                at = bisect_left(taken, (begun, end))
                if (at == 0 or taken[at - 1][1] <= begun) and (at == len(taken) or taken[at][0] >= end):
                    taken.insert(at, (begun, end))
                    found.append((label, begun, end, min(1.0, cover)))
        return sorted(found, key=lambda x: (x[1], x[0], x[2]))


def scan_licenses(
    documents: DataFrame,
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, licenses) for each row.

    ``base_labels`` come from phrases, ``labels`` also from template spans,
    which ``licenses`` lists; ``score`` is the largest share of a template that
    a span covers, 1 where a phrase stands, 0 where nothing is found.  Words
    count from 0.  Null and empty texts have no words, no labels, null first
    and last.  Repeated rows and null ids stay; other columns are ignored.
    """
    given = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scanner = Scanner(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    shared = given.sparkSession.sparkContext.broadcast(scanner)
    id_type = given.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        for batch in batches:
            for at, data, bounds in tokens.slices(batch.column(1)):
                found = tokens.words(data, bounds, tokens.ALPHANUMERIC)
                counts, known = found.counts, scanner.known(found.hashes)
                rows = [_row(scanner, known[a:b]) for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist())]
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span_type]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(counts)), pa.array(counts),
                        *(pa.array(c, t) for c, t in zip(columns, types)),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "licenses"],
                )

    return given.mapInArrow(
        run,
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        f"labels string, score double, licenses {SPANS}",
    )


def _row(scanner: Scanner, known: np.ndarray) -> tuple:
    places, runs = scanner.scan(list(scanner.stretches(known)))
    spans = scanner.spans(runs)
    starts = [start for _, start in places]
    base = {scanner.phrase_labels[number] for number, _ in places}
    labels = base | {span[0] for span in spans}
    score = 1.0 if base else max((s[3] for s in spans), default=0.0)
    listed = [dict(zip(("label", "start", "end", "cover"), s)) for s in spans]
    return (
        len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score, listed,
    )
