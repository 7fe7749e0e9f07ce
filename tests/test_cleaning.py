"""Cleaners: exact cases, and random text against the steps run one by one."""

import random
import re
import time

import pytest
from pyspark.errors import PySparkException

from earshot import constants as C
from earshot.functions.channels import CLEANERS
from earshot.operators.clean import preprocess

CASES = [
    # fillers and filler phrases go wherever they stand as whole words
    ("phone", "the uh tablets came erm broken", "the tablets came broken"),
    ("phone", "two boxes i mean three kind of arrived", "two boxes three arrived"),
    ("phone", "umbrella factory", "umbrella factory"),
    ("phone", "éum hmm² ah", "éum hmm²"),
    ("phone", "know like you", "know you"),
    # a run of the repeated word goes, one alone stays
    ("phone", "fine yeah yeah  yeah bye", "fine bye"),
    ("phone", "yeah sure", "yeah sure"),
    ("phone", "yeah yeahs yeah", "yeah yeahs yeah"),
    ("phone", "yeah\ufdd0yeah \ufdd0", "yeah\ufdd0yeah \ufdd0"),
    # openers, each tried once in turn
    ("phone", "Hello there, anyone in", "there, anyone in"),
    ("phone", "HELLO YEAH the van left", "the van left"),
    ("phone", "hi so the van left", "the van left"),
    ("phone", "so hello the van left", "hello the van left"),
    # salutations go at every line start, up to a comma or line end
    ("email", "Hey all,\nThe lid leaks.\nhello again, Still leaks.", "The lid leaks. Still leaks."),
    ("email", "\n \n Good evening,\nNo label.", "No label."),
    ("email", "to whom it may concern\nNo label.", "No label."),
    ("email", "No label, dear sir,\nright?", "No label, dear sir, right?"),
    ("email", "a\rHi Ann,b", "a Hi Ann,b"),
    # sign-offs cut to the end of the text
    ("email", "The seal was torn.\nYours faithfully\nR. Reader\nFlat 2", "The seal was torn."),
    ("email", "Cheers, but no.\nThe seal was torn.", "Cheers, but no. The seal was torn."),
    ("email", "Torn again. sent from my ipad mini", "Torn again."),
    ("email", "best\n\nbefore date is gone", ""),
    # abbreviations as whole words, in any case
    ("chat", "Tks, my PW is wrong", "thanks, my password is wrong"),
    ("chat", "rm cant find\nflat 2fa", "royal mail cannot find flat two factor authentication"),
    ("chat", "ive said id wait, wont i", "i have said i would wait, will not i"),
    ("chat", "plzz idle gps", "plzz idle gps"),
    ("chat", "tKs ſo plſ", "thanks ſo please"),
    # handles and links go, tags lose their sign
    ("social", "@one@two hm", "hm"),
    ("social", "#lost_parcel and # alone", "lost_parcel and # alone"),
    ("social", "look http://a.b/c?d#e, bad", "look bad"),
    ("social", "write x@y.org #ü9", "write x.org ü9"),
]


def test_exact_cases(spark):
    rows = [(i, channel, text) for i, (channel, text, _) in enumerate(CASES)]
    cleaned = preprocess(spark.createDataFrame(rows, "i int, channel string, text string"))
    got = {r["i"]: r["cleaned_text"] for r in cleaned.collect()}
    for i, (channel, text, want) in enumerate(CASES):
        assert got[i] == want, (channel, text)


# The method as a table: patterns with what takes their place, in order.  The
# values are the library's; one runner applies them.
WHOLE = lambda phrases: rf"\b(?:{'|'.join(phrases)})\b"
STEPS = {
    "phone": [
        (WHOLE(C.PHONE_FILLERS), " "), (WHOLE(C.PHONE_FILLER_PHRASES), " "),
        (WHOLE([rf"{C.PHONE_REPEATED_WORD}(?:\s+{C.PHONE_REPEATED_WORD})+"]), " "), *((p, "") for p in C.PHONE_OPENERS),
    ],
    "email": [(f"(?m:{p})", "") for p in C.EMAIL_SALUTATIONS] + [(f"(?s:{p})", "") for p in C.EMAIL_SIGNOFFS],
    "chat": [(WHOLE([short]), full) for short, full in C.CHAT_ABBREVIATIONS.items()],
    "social": [(C.SOCIAL_HANDLE, ""), (C.SOCIAL_HASHTAG, r"\1"), (C.SOCIAL_URL, "")],
}
FOLDS_CASE = ("phone", "chat")


def by_steps(channel, text):
    text = text.lower() if channel in FOLDS_CASE else text
    for pattern, to in STEPS[channel]:
        text = re.sub(pattern, to, text, flags=0 if channel == "social" else re.IGNORECASE)
    return " ".join(text.split())


PIECES = [
    *C.PHONE_FILLERS, "like", "you", "know", "i", "mean", "sort", "of", "kind", "yeah", "yeah",
    "hi", "hello", "there", "so", "dear", "hey", "good", "morning", "to whom it may concern",
    "regards", "best", "thanks", "cheers", "yours faithfully", "sent from my iphone", "team",
    *C.CHAT_ABBREVIATIONS, "@a_b", "#tag", "#é", "http://x.y", "https://é", "a@b.c", "word",
    "x", "Straße", "naïve", "日本", "²", "́", "ſo", "lıke", "İd", "Kind", "ΟΔΟΣ", "_", "1",
]
GAPS = [" ", " ", " ", "\n", "\n\n", ",", ", ", ".", "\t", "\r", "\r\n", " ", "\x1c", "\x85", " ", "", "-", "'"]


def random_texts(count, seed, ascii_only=False):
    rng = random.Random(seed)
    for _ in range(count):
        text = "".join(
            rng.choice((str, str.upper, str.title))(rng.choice(PIECES)) + rng.choice(GAPS)
            for _ in range(rng.randrange(0, 14))
        )
        yield rng.choice(["", "", " ", "\n"]) + text


@pytest.mark.parametrize("channel", C.CHANNELS)
def test_random_text_equals_the_steps(spark, channel):
    texts = list(random_texts(3000, seed=C.CHANNELS.index(channel)))
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(8)
    got = dict(table.select("i", CLEANERS[channel]("text").alias("c")).collect())
    changed = 0
    for i, text in enumerate(texts):
        want = by_steps(channel, text)
        changed += want != text
        assert got[i] == want, repr(text)
    assert changed > 2000


def test_long_runs_are_linear_and_do_not_overflow(spark):
    words = [
        "yeah " * 60_000 + "stop", "hi there " + "a b " * 60_000, "thanks, " * 50_000 + "\n bye", "yeah\ufdd0" * 20_000,
    ]
    # The steps themselves would take minutes on blank lines.
    blank = {"x" + "\n" * 60_000 + "y": "x y", "\n \t" * 30_000: "", "\n" * 60_000 + "Dear Ann,\nok": "dear ann, ok"}
    table = spark.createDataFrame(list(enumerate([*words, *blank])), "i int, text string").repartition(1)
    for channel in C.CHANNELS:
        begun = time.time()
        got = [r[0] for r in table.orderBy("i").select(CLEANERS[channel]("text")).collect()]
        assert time.time() - begun < 20
        assert got[: len(words)] == [by_steps(channel, t) for t in words]
        want = [*list(blank.values())[:2], "ok" if channel == "email" else "dear ann, ok"]
        assert [t.lower() for t in got[len(words) :]] == want


def test_cleaning_again_changes_nothing_in_social_text(spark):
    texts = [t for _, t, _ in CASES]
    once = spark.createDataFrame([(t,) for t in texts], "text string").select(CLEANERS["social"]("text").alias("text"))
    for row in once.select("text", CLEANERS["social"]("text").alias("again")).collect():
        assert "\n" not in row["text"] and "  " not in row["text"] and not re.search(r"https?://\S|@\w", row["again"])


def test_null_text_is_empty(spark):
    table = spark.createDataFrame([(c, None) for c in C.CHANNELS], "channel string, text string")
    assert [r["cleaned_text"] for r in preprocess(table).collect()] == [""] * 4


def test_other_columns_pass_through(spark):
    table = spark.createDataFrame(
        [("chat", "tia all", "REFUND_BILLING", True)],
        "channel string, text string, intent string, vulnerability_flag boolean",
    )
    row = preprocess(table).first()
    assert (row["intent"], row["vulnerability_flag"], row["text"]) == ("REFUND_BILLING", True, "tia all")
    assert "cleaned_text" not in table.columns


@pytest.mark.parametrize("channel", ["fax", None])
def test_unknown_channel(spark, channel):
    table = spark.createDataFrame([(channel, "hello")], "channel string, text string")
    with pytest.raises(PySparkException, match="Unsupported channel"):
        preprocess(table).collect()
    assert preprocess(table, on_unknown="null").first()["cleaned_text"] is None
    with pytest.raises(ValueError):
        preprocess(table, on_unknown="skip")
