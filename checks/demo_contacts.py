"""A contacts table derived from a table of documents.

The documents used for checks hold no customer-service wording, so each one
is wrapped, whole, in an invented phrase and the habits of a channel.  The
derivation is a projection of constants and the document text; the same
values build it in SQL (``checks/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot import constants as C

# (true intent, phrase).  Some match no rule, some only a weight-1 rule, some
# rules of several intents, some tie.
PHRASES = (
    ("PRESCRIPTION_DELAY", "it has not arrived, where is my order then"),
    ("PRESCRIPTION_DELAY", "I'm running out and my tablets are days late"),
    ("PRESCRIPTION_DELAY", "the pack was supposed to come on Monday"),
    ("PRESCRIPTION_DELAY", "any news on dispatch"),
    ("PRESCRIPTION_DELAY", "nothing came and i am worried"),
    ("REPEAT_PRESCRIPTION_QUERY", "my son told me to press add a new item, yet the repeat list stayed empty"),
    ("REPEAT_PRESCRIPTION_QUERY", "my inhaler isn't on the list"),
    ("REPEAT_PRESCRIPTION_QUERY", "how do i reorder now that i left my old chemist"),
    ("REPEAT_PRESCRIPTION_QUERY", "the cream is missing from my order"),
    ("REPEAT_PRESCRIPTION_QUERY", "i want two months at once please"),
    ("DELIVERY_ISSUE", "aunt maud signed for it: delivered to the wrong village, wrong address on your label"),
    ("DELIVERY_ISSUE", "the box is soaked and it was left with a neighbour"),
    ("DELIVERY_ISSUE", "i got a rm card but no parcel"),
    ("DELIVERY_ISSUE", "it was returned to you"),
    ("DELIVERY_ISSUE", "the driver threw it over the fence, disgraceful"),
    ("APP_WEBSITE_ISSUE", "i cant log in and the app keeps crashing"),
    ("APP_WEBSITE_ISSUE", "2fa code is not sent"),
    ("APP_WEBSITE_ISSUE", "after a password reset the screen of my tablet goes blank"),
    ("APP_WEBSITE_ISSUE", "the website is useless"),
    ("APP_WEBSITE_ISSUE", "nhs login and two-factor both failed"),
    ("CLINICAL_QUERY", "grapefruit juice at breakfast, is it safe"),
    ("CLINICAL_QUERY", "since i missed a dose there is a side effect"),
    ("CLINICAL_QUERY", "the pills are a different colour, same medication"),
    ("CLINICAL_QUERY", "can the pharmacist call me"),
    ("CLINICAL_QUERY", "does it make you sleepy"),
    ("REFUND_BILLING", "i was charged twice and want a refund"),
    ("REFUND_BILLING", "your clerk overlooked the HC2 i had stapled on"),
    ("REFUND_BILLING", "what is the price"),
    ("REFUND_BILLING", "the payment taken is wrong"),
    ("REFUND_BILLING", "you took too much from my card"),
    ("GP_INTEGRATION", "my gp says the script was sent"),
    ("GP_INTEGRATION", "our GP surgery wants one more form before they nominate anyone"),
    ("GP_INTEGRATION", "script not received and i am stuck in the middle"),
    ("GP_INTEGRATION", "the doctor and you disagree"),
    ("CUSTOMER_SERVICE_RESPONSIVENESS", "post, fax, pigeon: still no reply, and the third time i wrote in capitals"),
    ("CUSTOMER_SERVICE_RESPONSIVENESS", "i have been on hold for an hour, going round in circles"),
    ("CUSTOMER_SERVICE_RESPONSIVENESS", "let me speak to a manager"),
    ("CUSTOMER_SERVICE_RESPONSIVENESS", "nobody answers"),
    ("CUSTOMER_SERVICE_RESPONSIVENESS", "thank you, great and friendly help, all resolved"),
    ("REFUND_BILLING", "refund please, the parcel arrived damaged"),
    ("DELIVERY_ISSUE", "refund please, the parcel arrived damaged"),
)

# Channel -> (before the phrase, after the phrase, after the document), three
# habits each.
WRAPPERS = {
    "phone": (
        ("Uh hi this line crackles, ", " like, ", " ah yeah yeah yeah"),
        ("Hello there yeah ", " er sort of like ", " hmm"),
        ("So I mean ", " uh. ", " kind of"),
    ),
    "email": (
        ("Dear Team,\n\n", ".\n\n", "\n\nKind regards,\nCustomer A"),
        ("Good morning,\nHi all\n", ".\n", "\nSent from my iPhone"),
        ("To whom it may concern\n\n", " - ", "\nThanks\nB"),
    ),
    "chat": (
        ("pls help\n", "\n", "\nthx tia"),
        ("im lost, ", "\n\ni dont know ", " plz"),
        ("ID 42\n", " PW rm ", "\n2FA cant wont"),
    ),
    "social": (
        ("@chemist ", " #fail ", " https://example.org/a?b=1 now"),
        ("#help_me ", " @a_b,", " http://example.org"),
        ("so bad! ", " see https://example.org/x\t", " #the_end @you"),
    ),
}

DEMO_START, DEMO_DAYS = "2024-01-01 00:00:00", 182


def _pick(options, index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(o) for o in options)), (index + 1).cast("int"))


def contacts_from_documents(documents: DataFrame) -> DataFrame:
    """(contact_id, channel, intent, text); no shuffle, whole texts."""
    n = F.floor(F.col("doc_id") / len(C.CHANNELS))
    phrase, habit = n % len(PHRASES), n % 3
    channel = _pick(C.CHANNELS, F.col("doc_id") % len(C.CHANNELS))
    parts = [
        F.coalesce(
            *(
                F.when(channel == name, _pick([h[i] for h in habits], habit))
                for name, habits in WRAPPERS.items()
            )
        )
        for i in range(3)
    ]
    text = F.concat(
        parts[0],
        _pick([p for _, p in PHRASES], phrase),
        parts[1],
        F.coalesce("text", F.lit("")),
        parts[2],
    )
    return documents.select(
        F.col("doc_id").alias("contact_id"),
        channel.alias("channel"),
        _pick([i for i, _ in PHRASES], phrase).alias("intent"),
        text.alias("text"),
    )


def with_demo_time(contacts: DataFrame) -> DataFrame:
    """``event_time`` in the 26 weeks from 2024, by the id; every 17th has none."""
    minutes = (F.col("contact_id") * 7919) % (DEMO_DAYS * 1440)
    at = F.timestamp_add("MINUTE", minutes.cast("int"), F.lit(DEMO_START).cast("timestamp"))
    return contacts.withColumn("event_time", F.when(F.col("contact_id") % 17 != 5, at))


def read_demo_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contacts_from_documents(documents)
