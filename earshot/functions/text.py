r"""Whole-text column functions and the pattern notation bridge.

Expected results are defined by Python's ``re`` on Unicode strings.  Java's
``\w``, ``\s`` and ``\b`` mean something else, so patterns are written with
explicit classes here:

* word character  = letter, number or underscore, in any script;
* white space     = what ``str.isspace`` accepts;
* word boundary   = look-around on the word class.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
# Single characters rather than ranges: the JVM tests those with one lookup.
SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\p{Z}"

BEFORE_WORD = f"(?<![{WORD}])"
AFTER_WORD = f"(?![{WORD}])"
BOUNDARY = f"(?:{BEFORE_WORD}(?=[{WORD}])|(?<=[{WORD}]){AFTER_WORD})"

# Characters that equal an ASCII letter when case is ignored but are not its
# plain upper case: dotted and dotless i, long s, Kelvin sign.
CASE_TWINS = {"İ": "i", "ı": "i", "ſ": "s", "K": "k"}


def java_pattern(pattern: str, flags: str = "iu") -> str:
    r"""Python pattern -> Java pattern with the classes above.

    Covers ``\w \s \S`` (inside or outside a class) and ``\b``.
    """
    out, in_class = [], False
    for token in re.findall(r"\\.|.", pattern, flags=re.S):
        if token in "[]":
            in_class = token == "["
        if token == r"\w":
            token = WORD if in_class else f"[{WORD}]"
        elif token == r"\s":
            token = SPACE if in_class else f"[{SPACE}]"
        elif token == r"\S":
            token = f"[^{SPACE}]"
        elif token == r"\b":
            token = BOUNDARY
        out.append(token)
    return (f"(?{flags})" if flags else "") + "".join(out)


def word_start(letters: str) -> str:
    """Start of a word that begins with one of ``letters``.  The letter test
    comes first: it is cheaper than the look-behind and usually fails."""
    return f"(?=[{''.join(sorted(set(letters)))}]){BEFORE_WORD}"


def whole_words(phrases: tuple[str, ...], flags: str = "iu") -> str:
    """Java pattern for any of some plain phrases as whole words."""
    start = word_start("".join(p[0] for p in phrases))
    return f"(?{flags}){start}(?:{'|'.join(map(re.escape, phrases))}){AFTER_WORD}"


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one space; both ends are stripped.

    Single plain spaces, the common case, are left alone instead of being
    rewritten one by one: after a first white-space character either more
    follow, or it must not be a plain space.
    """
    return F.trim(F.regexp_replace(text, rf"[{SPACE}](?:[{SPACE}]++|(?<! ))", " "))


def fold_case(text: Column) -> Column:
    """Lower case in which every twin of an ASCII letter is that letter, so a
    plain comparison with lower-case ASCII equals a case-blind one."""
    plain = reduce(
        lambda out, kv: F.replace(out, F.lit(kv[0]), F.lit(kv[1])), CASE_TWINS.items(), text
    )
    return F.lower(plain)


def words(text: Column) -> Column:
    """The words of a text, in order, as an array.

    The array may hold one empty string at either end (text that starts or
    ends between words); consumers look words up, so it is never filtered out
    with an extra pass.
    """
    return F.split(text, f"[^{WORD}]+")
