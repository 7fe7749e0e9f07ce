"""Channel cleaners: text column in, cleaned column out, no shuffle.

All of them are projections of built-in expressions, and every pass over the
text is linear: groups are repeated possessively only, which needs no stack
frame per repetition.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot import constants as C
from earshot.functions import text as T


def _text(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def _delete(text: Column, pattern: str, flags: str) -> Column:
    return F.regexp_replace(text, T.java_pattern(pattern, flags), "")


def clean_phone(text: Column | str) -> Column:
    out = F.lower(_text(text))
    for fillers in (C.PHONE_FILLERS, C.PHONE_FILLER_PHRASES):
        out = F.regexp_replace(out, T.whole_words(fillers), " ")
    # A run of the repeated word goes, a single one stays.  Each further word
    # must be whole by itself, so the possessive loop never has to go back.
    word = C.PHONE_REPEATED_WORD
    run = f"{T.word_start(word[0])}{word}(?:[{T.SPACE}]++{word}{T.AFTER_WORD})++"
    out = F.regexp_replace(out, run, " ")
    out = reduce(lambda o, p: _delete(o, p, "iu"), C.PHONE_OPENERS, out)
    return T.collapse_spaces(out)


def clean_email(text: Column | str) -> Column:
    out = _text(text)
    for pattern in C.EMAIL_SALUTATIONS:
        # White space that no salutation follows is consumed once and put
        # back; else the search would begin anew at each of its lines.
        body = T.java_pattern(pattern.removeprefix(r"^\s*"), "")
        line = f"(?iumd)^(?:[{T.SPACE}]*+{body}|(?<gap>[{T.SPACE}]++))"
        out = F.regexp_replace(out, line, "${gap}")
    for pattern in C.EMAIL_SIGNOFFS:
        starts = "".join(re.findall(r"(?:^\\b\(?|\|)(\w)", pattern))
        body = pattern.removeprefix(r"\b")
        tail = T.word_start(starts) + T.java_pattern(body, flags="")
        out = F.regexp_replace(out, "(?ius)" + tail, "")
    return T.collapse_spaces(out)


def clean_chat(text: Column | str) -> Column:
    """The abbreviations that occur are found in one pass; only those are
    then written out.  No expansion contains another abbreviation, so their
    order does not matter."""
    out = F.lower(_text(text))
    found = F.array_distinct(
        F.regexp_extract_all(out, F.lit(T.whole_words(tuple(C.CHAT_ABBREVIATIONS))), F.lit(0))
    )
    full = F.create_map(*(F.lit(x) for kv in C.CHAT_ABBREVIATIONS.items() for x in kv))
    out = F.aggregate(
        found,
        out,
        lambda done, short: F.regexp_replace(
            done,
            F.concat(F.lit(T.BEFORE_WORD), short, F.lit(T.AFTER_WORD)),
            F.element_at(full, T.fold_case(short)),
        ),
    )
    return T.collapse_spaces(out)


def clean_social(text: Column | str) -> Column:
    out = _delete(_text(text), C.SOCIAL_HANDLE, "")
    out = F.regexp_replace(out, T.java_pattern(C.SOCIAL_HASHTAG, ""), "$1")
    out = _delete(out, C.SOCIAL_URL, "")
    return T.collapse_spaces(out)


CLEANERS = {
    "phone": clean_phone,
    "email": clean_email,
    "chat": clean_chat,
    "social": clean_social,
}


def clean_by_channel(
    channel: Column | str, text: Column | str, on_unknown: str = "error"
) -> Column:
    """Dispatch on the channel.  An unknown or null channel fails the job, or
    gives null with ``on_unknown="null"``."""
    if on_unknown not in ("error", "null"):
        raise ValueError("on_unknown must be 'error' or 'null'")
    channel = F.col(channel) if isinstance(channel, str) else channel
    cases = reduce(
        lambda w, kv: w.when(channel == kv[0], kv[1](text)), CLEANERS.items(), F
    )
    if on_unknown == "null":
        return cases.otherwise(F.lit(None).cast("string"))
    message = F.concat(
        F.lit("Unsupported channel '"),
        F.coalesce(channel, F.lit("null")),
        F.lit(f"'; known are {', '.join(sorted(CLEANERS))}"),
    )
    return cases.otherwise(F.raise_error(message).cast("string"))
