"""Fixed values of the method: channels, word lists, patterns and rules.

Patterns are written in Python ``re`` notation, which is the notation the
expected results are defined in; ``functions.text`` turns them into Spark
patterns.  Everything here is a value, not logic.
"""

# --- Fixed values: must stay as they are for results to match -------------

CHANNELS = ("phone", "email", "chat", "social")

PHONE_FILLERS = ("um", "uh", "er", "erm", "ah", "hmm")

PHONE_FILLER_PHRASES = ("like", "you know", "i mean", "sort of", "kind of")

PHONE_REPEATED_WORD = "yeah"

PHONE_OPENERS = (
    r"^\s*(yeah\s+)?hi\s+(there\s+)?(yeah\s+)?",
    r"^\s*(yeah\s+)?hello\s+(there\s+)?(yeah\s+)?",
    r"^\s*so\s+",
)

EMAIL_SALUTATIONS = (
    r"^\s*(dear|hi|hello|hey)\s+[\w\s]+?[,\n]",
    r"^\s*good\s+(morning|afternoon|evening)[,\n]",
    r"^\s*to\s+whom\s+it\s+may\s+concern[,\n]",
)

EMAIL_SIGNOFFS = (
    r"\b(kind\s+regards|best\s+regards|regards|thanks|thank\s+you|sincerely"
    r"|yours\s+(faithfully|sincerely)|cheers|best)[,\s]*\n.*$",
    r"\bsent\s+from\s+my\s+(iphone|ipad|android|samsung).*$",
)

CHAT_ABBREVIATIONS = {
    "pls": "please",
    "plz": "please",
    "thx": "thanks",
    "tks": "thanks",
    "tia": "thanks in advance",
    "dont": "do not",
    "cant": "cannot",
    "wont": "will not",
    "im": "i am",
    "ive": "i have",
    "id": "i would",
    "pw": "password",
    "rm": "royal mail",
    "gp": "gp",
    "2fa": "two factor authentication",
}

SOCIAL_HANDLE = r"@\w+"
SOCIAL_HASHTAG = r"#(\w+)"
SOCIAL_URL = r"https?://\S+"

# Intent -> (pattern, weight).  The order of intents decides ties.  Every
# pattern is a whole-word phrase: read it with a word boundary at both ends.
INTENT_RULES = {
    "PRESCRIPTION_DELAY": (
        ("where is my (prescription|order|medication|repeat)", 3),
        ("(still waiting|not yet arrived|not arrived|not received|not come)", 3),
        ("(running low|running out|run out|ran out)", 3),
        ("(supposed to arrive|supposed to come|expected to arrive)", 2),
        ("(days late|days overdue|weeks late)", 2),
        ("dispatch", 1),
    ),
    "REPEAT_PRESCRIPTION_QUERY": (
        ("(repeat list|repeat prescription)", 3),
        ("add a new item", 3),
        ("add an item", 3),
        ("missing from", 2),
        ("missing item", 2),
        ("isn't on the list", 2),
        ("isn't on my list", 2),
        ("how do i order", 2),
        ("how do i reorder", 2),
        ("how does the repeat work", 2),
        ("how does ordering work", 2),
        ("(switching from|transferred from)", 1),
    ),
    "DELIVERY_ISSUE": (
        ("wrong address", 3),
        ("delivered to the wrong", 3),
        ("(damaged|soaked|soggy|opened|tampered)", 3),
        ("(royal mail|rm) (card|note|notice)", 3),
        ("(left in|left with|unsafe place|neighbour)", 2),
        ("(returned to|sent back)", 1),
    ),
    "APP_WEBSITE_ISSUE": (
        ("can'?t log ?in", 3),
        ("cannot log ?in", 3),
        ("app (is )?crashing", 3),
        ("app keeps crashing", 3),
        ("password reset", 3),
        ("reset my password", 3),
        ("2fa", 2),
        ("two factor", 2),
        ("two-factor", 2),
        ("nhs app", 2),
        ("nhs login", 2),
        ("(reinstall|website|browser)", 1),
    ),
    "CLINICAL_QUERY": (
        ("side effect", 3),
        ("interaction", 3),
        ("interact with", 3),
        ("safe to take", 3),
        ("is it safe", 3),
        ("safe with", 3),
        ("missed a dose", 3),
        ("skip a dose", 3),
        ("different (colour|shape|tablet|pill)", 2),
        ("same medication", 2),
        ("(pregnant|pregnancy|breastfeeding|allergic)", 2),
        ("(pharmacist|clinical|advice)", 1),
    ),
    "REFUND_BILLING": (
        ("charged twice", 3),
        ("double charged", 3),
        ("duplicate charge", 3),
        ("refund", 3),
        ("hc2", 3),
        ("hc3", 3),
        ("exemption certificate", 3),
        ("prescription charge exempt", 3),
        ("exempt from charges", 3),
        ("(billed|invoice|payment taken)", 2),
        ("(money back|cost|price)", 1),
    ),
    "GP_INTEGRATION": (
        ("gp says", 3),
        ("gp sent", 3),
        ("gp surgery", 3),
        ("gp practice", 3),
        ("surgery says", 3),
        ("surgery sent", 3),
        ("nominat(e|ion|ed)", 3),
        ("script not sent", 2),
        ("script not received", 2),
        ("blaming each other", 2),
        ("stuck in the middle", 2),
    ),
    "CUSTOMER_SERVICE_RESPONSIVENESS": (
        ("(third|3rd|second|2nd) (time|email|call)", 3),
        ("no response", 3),
        ("no reply", 3),
        ("haven'?t heard", 3),
        ("haven'?t replied", 3),
        ("been on hold", 2),
        ("been waiting", 2),
        ("on hold for", 2),
        ("round in circles", 2),
        ("getting nowhere", 2),
        ("speak to someone", 1),
        ("speak to a manager", 1),
        ("escalate", 1),
    ),
}

INTENTS = tuple(INTENT_RULES)

MIN_SCORE = 2
MEDIUM_SCORE = 3
HIGH_SCORE = 5

SENTIMENT_LABELS = ("negative", "neutral", "positive")

UNKNOWN_INTENT = "UNKNOWN"
OUTLIER_TOPIC = -1
ALIGNED_SHARE = 0.7

# --- Our own defaults (the default scorer; replaceable) --------------------

NEGATIVE_WORDS = (
    "angry", "annoyed", "appalling", "awful", "bad", "blaming", "broken",
    "circles", "complaint", "crashing", "damaged", "disappointed",
    "disgraceful", "disgusted", "failed", "frustrated", "frustrating",
    "horrible", "ignored", "late", "lost", "missing", "nowhere", "overdue",
    "poor", "problem", "ridiculous", "rude", "soaked", "stuck", "stressed",
    "terrible", "twice", "unacceptable", "unhappy", "unsafe", "upset",
    "useless", "waiting", "worried", "worst", "worthless", "wrong",
)

POSITIVE_WORDS = (
    "amazing", "appreciate", "appreciated", "brilliant", "easy", "excellent",
    "fantastic", "fast", "friendly", "glad", "good", "grateful", "great",
    "happy", "helpful", "impressed", "kind", "love", "lovely", "perfect",
    "pleased", "quick", "recommend", "resolved", "smooth", "superb",
    "thank", "thanks", "wonderful", "working",
)

# Logit of the neutral class when no listed word occurs.
NEUTRAL_LOGIT = 1.0
