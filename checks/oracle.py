r"""SQL statements that compute every registered query another way.

They share the library's fixed values and nothing else: other regex engine,
other way to find word boundaries, brute-force neighbours.

Word boundaries: this SQL dialect's ``\b`` knows ASCII only, so words are
first put between marks (``chr(1)`` and ``chr(2)``) and a whole word is
searched with its marks.
"""

from __future__ import annotations

import re

from earshot import constants as C
from checks import demo_contacts as D

W = r"\p{L}\p{N}_"
S = r"\t-\r\x1c-\x20\x85\p{Z}"
DIM = 256


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pattern(python: str) -> str:
    out, in_class = [], False
    for token in re.findall(r"\\.|.", python, flags=re.S):
        if token in "[]":
            in_class = token == "["
        token = {
            r"\w": W if in_class else f"[{W}]",
            r"\s": S if in_class else f"[{S}]",
            r"\S": f"[^{S}]",
        }.get(token, token)
        out.append(token)
    return "".join(out)


def sub(text: str, regex: str, to: str, everywhere: bool = True) -> str:
    return f"regexp_replace({text}, {lit(regex)}, {to}" + (", 'g')" if everywhere else ")")


def mark(text: str) -> str:
    return sub(text, f"([{W}]+)", "chr(1) || '\\1' || chr(2)")


def unmark(text: str) -> str:
    return f"replace(replace({text}, chr(1), ''), chr(2), '')"


def marked(phrase: str) -> str:
    return re.sub(r"\w+", lambda m: rf"\x01{m[0]}\x02", phrase)


def marked_value(phrase: str) -> str:
    return re.sub(r"\w+", lambda m: f"\x01{m[0]}\x02", phrase)


def tidy(text: str) -> str:
    return f"trim({sub(text, f'[{S}]+', lit(' '))}, ' ')"


def phone(text: str) -> str:
    out = mark(f"lower({text})")
    for phrases in (C.PHONE_FILLERS, C.PHONE_FILLER_PHRASES):
        out = sub(out, "(?i)(" + "|".join(map(marked, phrases)) + ")", lit(" "))
    again = marked(C.PHONE_REPEATED_WORD)
    out = unmark(sub(out, rf"(?i){again}([{S}]+{again})+", lit(" ")))
    for opener in C.PHONE_OPENERS:
        out = sub(out, "(?i)" + pattern(opener), "''", everywhere=False)
    return tidy(out)


def email(text: str) -> str:
    out = text
    for salutation in C.EMAIL_SALUTATIONS:
        out = sub(out, "(?im)" + pattern(salutation), "''")
    for signoff in C.EMAIL_SIGNOFFS:
        body = pattern(signoff.removeprefix(r"\b"))
        out = sub(out, rf"(?is)(^|[^{W}]){body}", "'\\1'", everywhere=False)
    return tidy(sub(out, r"\n+", lit(" ")))


def chat(text: str) -> str:
    out = mark(sub(f"lower({text})", r"\n+", lit(" ")))
    for short, full in C.CHAT_ABBREVIATIONS.items():
        out = sub(out, "(?i)" + marked(short), lit(marked_value(full)))
    return tidy(unmark(out))


def social(text: str) -> str:
    out = sub(text, pattern(C.SOCIAL_HANDLE), "''")
    out = sub(out, pattern(C.SOCIAL_HASHTAG), "'\\1'")
    return tidy(sub(out, pattern(C.SOCIAL_URL), "''"))


def folded(text: str) -> str:
    return f"lower(replace(replace(replace(replace({text}, 'İ', 'i'), 'ı', 'i'), 'ſ', 's'), 'K', 'k'))"


def words(text: str) -> str:
    return f"string_split_regex({text}, {lit(f'[^{W}]+')})"


# --- shared table expressions ---------------------------------------------


def contacts_cte() -> str:
    def part(i: int) -> str:
        whens = " ".join(
            f"WHEN {lit(c)} THEN {lits(h[i] for h in habits)}[n % 3 + 1]"
            for c, habits in D.WRAPPERS.items()
        )
        return f"CASE channel {whens} END"

    count = len(D.PHRASES)
    return f"""numbered AS (
  SELECT doc_id, text, doc_id // 4 AS n, {lits(C.CHANNELS)}[doc_id % 4 + 1] AS channel FROM documents
), contacts AS (
  SELECT doc_id AS contact_id, channel,
    {lits(i for i, _ in D.PHRASES)}[n % {count} + 1] AS intent,
    {part(0)} || {lits(p for _, p in D.PHRASES)}[n % {count} + 1] || {part(1)}
      || coalesce(text, '') || {part(2)} AS text
  FROM numbered
)"""


def cleaned_cte() -> str:
    cases = {"phone": phone, "email": email, "chat": chat, "social": social}
    whens = " ".join(f"WHEN {lit(c)} THEN {f('text')}" for c, f in cases.items())
    return f"{contacts_cte()}, cleaned AS MATERIALIZED (SELECT *, CASE channel {whens} END AS cleaned_text FROM contacts)"


def rule_points(rules, text: str) -> str:
    return " + ".join(
        f"CASE WHEN regexp_matches({text}, {lit(f'(?i)(^|[^{W}])(?:{p})([^{W}]|$)')}) THEN {w} ELSE 0 END"
        for p, w in rules
    )


def scored_cte(text: str = "cleaned_text") -> str:
    scores = ", ".join(
        f"{rule_points(rules, text)} AS {intent}" for intent, rules in C.INTENT_RULES.items()
    )
    return f"{cleaned_cte()}, scored AS MATERIALIZED (SELECT *, {scores} FROM cleaned)"


def classified_cte(min_score: int = C.MIN_SCORE) -> str:
    names = lits(C.INTENTS)
    return f"""{scored_cte()}, topped AS (
  SELECT *, greatest({', '.join(C.INTENTS)}) AS top_score, [{', '.join(C.INTENTS)}] AS scores FROM scored
), classified AS (
  SELECT * EXCLUDE (scores),
    CASE WHEN top_score >= {min_score} THEN {names}[list_position(scores, top_score)] END AS predicted_intent,
    CASE WHEN top_score < {min_score} THEN 'none' WHEN top_score >= {C.HIGH_SCORE} THEN 'high'
         WHEN top_score >= {C.MEDIUM_SCORE} THEN 'medium' ELSE 'low' END AS confidence
  FROM topped
)"""


def bucket_ctes() -> str:
    """Hashed word vectors: ``buckets`` (non-zero entries), ``vectors``."""
    return f"""tokens AS (
  SELECT contact_id, unnest({words('lower(cleaned_text)')}) AS w FROM cleaned
), counted AS (
  SELECT contact_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {DIM} AS bucket, count(*) AS c
  FROM tokens WHERE w <> '' GROUP BY ALL
), buckets AS (
  SELECT contact_id, bucket,
    CAST(c / sqrt(sum(c * c) OVER (PARTITION BY contact_id)) AS FLOAT) AS value FROM counted
), vectors AS MATERIALIZED (
  SELECT c.contact_id, list(CAST(coalesce(value, 0) AS DOUBLE) ORDER BY d.bucket) AS v
  FROM (SELECT contact_id FROM cleaned) c CROSS JOIN (SELECT unnest(range({DIM})) AS bucket) d
  LEFT JOIN buckets b ON b.contact_id = c.contact_id AND b.bucket = d.bucket
  GROUP BY c.contact_id
)"""


def ranked(queries: str, corpus: str, k: int, extra: str = "") -> str:
    """k nearest by brute force; both sides have ``id`` and ``v``."""
    return f"""SELECT * FROM (
  SELECT q.id AS query_id, c.id AS neighbour_id, {extra}
    round(list_inner_product(q.v, c.v), 9) AS similarity,
    row_number() OVER (PARTITION BY q.id ORDER BY round(list_inner_product(q.v, c.v), 9) DESC, c.id)::INTEGER AS rank
  FROM {queries} q CROSS JOIN {corpus} c) WHERE rank <= {k}"""


VOTES = """votes AS (
  SELECT query_id, label, round(sum(similarity), 9) AS vote, min(rank) AS best
  FROM neighbours WHERE similarity > 0 GROUP BY query_id, label
), ordered_votes AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY vote DESC, best) AS place,
    sum(vote) OVER (PARTITION BY query_id) AS total FROM votes
), predictions AS (
  SELECT q.query_id, o.label AS predicted_intent, coalesce(o.vote / o.total, 0.0) AS confidence
  FROM (SELECT DISTINCT query_id FROM neighbours) q
  LEFT JOIN (SELECT * FROM ordered_votes WHERE place = 1) o USING (query_id)
)"""

GIVEN_VECTORS = """given AS (
  SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
)"""

SPLIT = """split AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || contact_id), contact_id)
    <= floor(count(*) OVER () * 0.8) AS is_train FROM {table}
)"""


def knn_ctes() -> str:
    return f"""{classified_cte()}, {bucket_ctes()}, {SPLIT.format(table='classified')},
train AS (SELECT contact_id AS id, intent, v FROM split JOIN vectors USING (contact_id) WHERE is_train),
test AS (SELECT contact_id AS id, intent, v FROM split JOIN vectors USING (contact_id) WHERE NOT is_train),
neighbours AS ({ranked('test', 'train', 5, 'c.intent AS label,')}), {VOTES}"""


def sentiment_cte() -> str:
    cues = lambda listed: (
        f"len(list_filter({lits(listed)}, lambda w: list_contains(found, w)))"
    )
    return f"""{cleaned_cte()}, worded AS MATERIALIZED (
  SELECT *, {words(folded('cleaned_text'))} AS found FROM cleaned
), cues AS MATERIALIZED (
  SELECT * EXCLUDE (found), {cues(C.NEGATIVE_WORDS)} AS cn, {cues(C.POSITIVE_WORDS)} AS cp FROM worded
), powers AS (
  SELECT *, power(cn + 1, 2) AS a, exp({C.NEUTRAL_LOGIT}) AS b, power(cp + 1, 2) AS c FROM cues
), sentiment AS (
  SELECT *, a / (a + b + c) AS negative, b / (a + b + c) AS neutral, c / (a + b + c) AS positive,
    CASE WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral' ELSE 'positive' END AS sentiment_label,
    greatest(a, b, c) / (a + b + c) AS sentiment_confidence FROM powers
)"""


def topics_cte() -> str:
    return f"""{cleaned_cte()}, {bucket_ctes()}, topics AS MATERIALIZED (
  SELECT contact_id, CASE WHEN contact_id % 7 <> 3 THEN intent END AS intent, cleaned_text,
    (contact_id % 10 - 1)::INTEGER AS topic, v
  FROM cleaned JOIN vectors USING (contact_id)
)"""


def top_words_cte(n: int) -> str:
    return f"""terms AS (
  SELECT topic, unnest({words('lower(cleaned_text)')}) AS term FROM topics
), tf AS (
  SELECT topic, term, count(*) AS tf FROM terms WHERE length(term) >= 2 GROUP BY ALL
), weighted AS (
  SELECT topic, term, round(tf * ln(1 + (SELECT sum(tf) / count(DISTINCT topic) FROM tf)
    / sum(tf) OVER (PARTITION BY term)), 9) AS weight FROM tf
), top_words AS (
  SELECT * FROM (SELECT topic, term, weight,
    row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term)::INTEGER AS rank FROM weighted WHERE topic <> -1)
  WHERE rank <= {n}
)"""


CROSSTAB = "crosstab AS (SELECT topic, coalesce(intent, 'UNKNOWN') AS intent, count(*) AS n FROM topics GROUP BY ALL)"


def spikes_sql() -> str:
    """Weeks against the up to eight before them, by their plain median."""
    minutes = f"(contact_id * 7919) % ({D.DEMO_DAYS} * 1440)"
    return f"""WITH {sentiment_cte()}, timed AS (
  SELECT coalesce(intent, 'UNKNOWN') AS intent, sentiment_label,
    date_trunc('week', TIMESTAMP {lit(D.DEMO_START)} + to_minutes({minutes})) AS week FROM sentiment WHERE contact_id % 17 <> 5
), weeks AS (
  SELECT week, intent, count(*) AS n, count(*) FILTER (sentiment_label = 'negative') AS negative FROM timed GROUP BY ALL
), before AS (
  SELECT *, negative / n AS share, list(negative / n) OVER (PARTITION BY intent ORDER BY week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS earlier
  FROM weeks
), middles AS (
  SELECT *, CASE WHEN len(earlier) >= 3 THEN list_median(earlier) END AS usual FROM before
), scored AS (
  SELECT *, (share - usual) / greatest(1.4826::DOUBLE * list_median(list_transform(earlier, lambda s: abs(s - usual))), sqrt(usual * (1 - usual) / n), 0.01::DOUBLE) AS z
  FROM middles
)
SELECT strftime(week, '%Y-%m-%d') AS week, intent, n, negative, round(share, 6) AS share, round(usual, 6) AS usual,
  round(z, 6) AS z, coalesce(z >= 3 AND n >= 5, false) AS spike FROM scored"""


NEXT_CONTACT = """placed AS (
  SELECT *, first_value(CASE WHEN event_type = 'error' THEN {'id': event_id, 'at': ts} END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL
), nexts AS (
  SELECT * EXCLUDE (later), CASE WHEN later.at <= ts + INTERVAL 2 DAY THEN later.id END AS next_id FROM placed
)"""
SESSIONS = """SELECT user_id, session, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ended, count(*) AS n
FROM (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session FROM (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL))
GROUP BY ALL"""


def labels_sql() -> str:
    return ", ".join(
        f"({i}, {lit(label)})" for i, label in enumerate(C.SENTIMENT_LABELS)
    )


def statements() -> dict[str, str]:
    cleaned, contacts, classified = cleaned_cte(), contacts_cte(), classified_cte()
    sentiment, topics = sentiment_cte(), topics_cte()
    cut = lambda c, n, m: f"left({c}, {n}) || CASE WHEN length({c}) > {n} THEN {lit(m)} ELSE '' END"
    firsts = "firsts AS (SELECT min(contact_id) AS contact_id FROM cleaned GROUP BY channel)"
    by = lambda key: f"""WITH {sentiment} SELECT {key}, count(*) FILTER (sentiment_label = 'negative') AS negative,
  count(*) FILTER (sentiment_label = 'neutral') AS neutral, count(*) FILTER (sentiment_label = 'positive') AS positive,
  count(*) AS total FROM sentiment GROUP BY {key}"""
    evaluation = """count(*) AS total, count(*) FILTER (predicted_intent = intent) AS correct,
  count(*) FILTER (predicted_intent IS NULL) AS none_count,
  round(coalesce(count(*) FILTER (predicted_intent = intent) / nullif(count(predicted_intent), 0), 0), 6)
    AS accuracy_when_classified,
  round(count(predicted_intent) / count(*), 6) AS coverage"""
    held = f"""{cleaned}, {bucket_ctes()}, {firsts},
asked AS (SELECT contact_id AS id, v FROM vectors WHERE contact_id IN (SELECT contact_id FROM firsts)),
known AS (SELECT contact_id AS id, v FROM vectors WHERE contact_id NOT IN (SELECT contact_id FROM firsts)),
neighbours AS ({ranked('asked', 'known', 3)})"""
    channel = lambda name, f: f"WITH {contacts} SELECT contact_id, {f('text')} AS cleaned_text FROM contacts"
    lower_intents = ", ".join(f"{i} AS {i.lower()}" for i in C.INTENTS)
    return {
        "clean_phone": channel("phone", phone),
        "clean_email": channel("email", email),
        "clean_chat": channel("chat", chat),
        "clean_social": channel("social", social),
        "clean_chat_turns": f"SELECT conv_id, turn, {chat('text')} AS cleaned_text FROM conversations",
        "preprocess_dispatch": f"WITH {cleaned} SELECT contact_id, channel, intent, text, cleaned_text FROM cleaned",
        "score_intents": f"WITH {scored_cte()} SELECT contact_id, {lower_intents} FROM scored",
        "score_intents_raw": f"WITH {scored_cte('text')} SELECT contact_id, {lower_intents} FROM scored",
        "classify_min_score": f"""WITH {classified_cte(1)} SELECT contact_id, predicted_intent,
  CASE WHEN top_score >= 1 THEN top_score END AS score FROM classified""",
        "classify_confidence": f"""WITH {classified} SELECT contact_id, predicted_intent, confidence, top_score,
  {lower_intents} FROM classified""",
        "rule_eval": f"WITH {classified} SELECT {evaluation} FROM classified",
        "rule_eval_by_channel": f"WITH {classified} SELECT channel, {evaluation} FROM classified GROUP BY channel",
        "channel_distribution": f"WITH {contacts} SELECT channel, count(*) AS n FROM contacts GROUP BY channel",
        "intent_distribution": f"WITH {contacts} SELECT intent, count(*) AS n FROM contacts GROUP BY intent",
        "preview_per_channel": f"""WITH {cleaned}, {firsts}, shown AS (
  SELECT channel, intent, replace(text, chr(10), ' ⏎ ') AS b, cleaned_text AS a FROM cleaned JOIN firsts USING (contact_id)
) SELECT channel, intent, {cut('b', 140, '…')} AS before, {cut('a', 140, '…')} AS after FROM shown""",
        "holdout_per_channel": f"""WITH {cleaned}, {firsts} SELECT contact_id, channel,
  contact_id IN (SELECT contact_id FROM firsts) AS is_query FROM cleaned""",
        "embed_hashing": f"""WITH {cleaned}, {bucket_ctes()} SELECT contact_id, bucket,
  round(CAST(value AS DOUBLE), 6) AS value FROM buckets""",
        "topk_similar": f"""WITH {GIVEN_VECTORS}, neighbours AS ({ranked('given', 'given', 5)})
SELECT query_id, rank, neighbour_id, round(similarity, 6) AS similarity FROM neighbours""",
        "topk_per_channel": f"""WITH {held} SELECT query_id, rank, neighbour_id, round(similarity, 6) AS similarity,
  q.channel AS query_channel, q.intent AS query_intent, {cut('q.cleaned_text', 110, '…')} AS query_text,
  c.channel, c.intent, {cut("replace(c.cleaned_text, chr(10), ' ')", 100, '…')} AS text
FROM neighbours JOIN cleaned q ON q.contact_id = query_id JOIN cleaned c ON c.contact_id = neighbour_id""",
        "knn_predict": f"""WITH {GIVEN_VECTORS}, marked AS (
  SELECT id, CAST(label AS VARCHAR) AS intent, v,
    row_number() OVER (ORDER BY md5('42:' || id), id) <= floor(count(*) OVER () * 0.8) AS is_train FROM given),
train AS (SELECT * FROM marked WHERE is_train), test AS (SELECT * FROM marked WHERE NOT is_train),
neighbours AS ({ranked('test', 'train', 5, 'c.intent AS label,')}), {VOTES}
SELECT query_id, predicted_intent, round(confidence, 6) AS confidence,
  string_agg(neighbour_id, ',' ORDER BY rank) AS neighbour_ids
FROM predictions JOIN neighbours USING (query_id) GROUP BY ALL""",
        "knn_eval": f"""WITH {knn_ctes()} SELECT count(*) AS total,
  count(*) FILTER (predicted_intent = intent) AS correct,
  round(count(*) FILTER (predicted_intent = intent) / count(*), 6) AS accuracy
FROM test JOIN predictions ON query_id = id""",
        "disagreements": f"""WITH {knn_ctes()} SELECT query_id, intent, c.predicted_intent AS rule_intent,
  top_score AS rule_score, p.predicted_intent AS knn_intent, round(p.confidence, 6) AS knn_confidence
FROM predictions p JOIN classified c ON contact_id = query_id
WHERE p.predicted_intent IS DISTINCT FROM c.predicted_intent""",
        "train_test_split": f"WITH {contacts}, {SPLIT.format(table='contacts')} SELECT contact_id, is_train FROM split",
        "sentiment_score": f"""WITH {sentiment} SELECT contact_id, sentiment_label,
  round(sentiment_confidence, 6) AS sentiment_confidence, round(negative, 6) AS negative,
  round(neutral, 6) AS neutral, round(positive, 6) AS positive FROM sentiment""",
        "sentiment_distribution": f"""WITH {sentiment} SELECT ordinal, l.label AS sentiment_label, count(contact_id) AS n,
  round(coalesce(100.0 * count(contact_id) / nullif((SELECT count(*) FROM sentiment), 0), 0), 6) AS pct
FROM (VALUES {labels_sql()}) l(ordinal, label) LEFT JOIN sentiment ON sentiment_label = l.label GROUP BY ALL""",
        "sentiment_by_intent": by("intent"),
        "sentiment_by_channel": by("channel"),
        "top_negative": f"""WITH {sentiment} SELECT contact_id, intent, channel,
  round(sentiment_confidence, 6) AS sentiment_confidence, {cut('cleaned_text', 110, '...')} AS preview
FROM sentiment WHERE sentiment_label = 'negative'
ORDER BY round(sentiment.sentiment_confidence, 9) DESC, contact_id LIMIT 3""",
        "negative_spikes": spikes_sql(),
        "contact_sessions": SESSIONS,
        "next_contact": f"WITH {NEXT_CONTACT} SELECT event_id, next_id FROM nexts",
        "repeat_contact": f"""WITH {NEXT_CONTACT} SELECT event_type, count(*) AS contacts, count(next_id) AS repeated,
  round(count(next_id) / count(*), 6) AS rate FROM nexts WHERE event_type = 'error' GROUP BY ALL""",
        "contact_deflection": f"""WITH {NEXT_CONTACT} SELECT event_type, count(*) AS visits,
  count(*) FILTER (next_id IS NULL) AS deflected, round(count(*) FILTER (next_id IS NULL) / count(*), 6) AS rate
FROM nexts WHERE event_type IN ('view', 'click') GROUP BY ALL""",
        "topic_info": f"""WITH {topics}, {top_words_cte(6)}, dims AS (
  SELECT topic, i, avg(v[i]) AS m FROM topics, (SELECT unnest(range(1, {DIM + 1})) AS i) GROUP BY ALL
), centres AS (SELECT topic, list(m ORDER BY i) AS m FROM dims GROUP BY topic
), near AS (
  SELECT * FROM (SELECT topic, contact_id, row_number() OVER (PARTITION BY topic ORDER BY
    round(list_inner_product(v, m) / sqrt(list_inner_product(m, m)), 9) DESC, contact_id) AS rank
    FROM topics JOIN centres USING (topic)) WHERE rank <= 3
), docs AS (SELECT topic, string_agg(contact_id, ',' ORDER BY rank) AS representative_ids FROM near GROUP BY topic
), listed AS (SELECT topic, list(term ORDER BY rank) AS w FROM top_words GROUP BY topic
) SELECT topic, count(*) AS n, topic || '_' || CASE WHEN topic = -1 THEN 'outliers'
    ELSE array_to_string(w[1:4], '_') END AS name,
  coalesce(array_to_string(w, ','), '') AS words, representative_ids
FROM topics LEFT JOIN listed USING (topic) LEFT JOIN docs USING (topic) GROUP BY ALL""",
        "topic_top_words": f"""WITH {topics}, {top_words_cte(6)}
SELECT topic, rank, term, round(weight, 6) AS weight FROM top_words""",
        "topic_assignments": f"WITH {topics} SELECT contact_id, topic FROM topics",
        "topic_crosstab": f"WITH {topics}, {CROSSTAB} SELECT topic, intent, n FROM crosstab",
        "topic_crosstab_dense": f"WITH {topics} SELECT topic, "
        + ", ".join(f"count(*) FILTER (intent = {lit(i)}) AS {i.lower()}" for i in sorted(C.INTENTS))
        + ", count(*) FILTER (intent IS NULL) AS unknown"
        + f", count(*) FILTER (NOT list_contains({lits(C.INTENTS)}, intent)) AS other"
        + " FROM topics GROUP BY topic",
        "jsonl_roundtrip": f"""WITH {cleaned} SELECT CAST(contact_id AS VARCHAR) AS contact_id, channel, intent,
  NULL::BOOLEAN AS vulnerability_flag, NULL::BOOLEAN AS urgency_flag, NULL::VARCHAR AS customer_placeholder,
  text, cleaned_text FROM cleaned""",
        "topic_alignment": f"""WITH {topics}, {CROSSTAB}, per_topic AS (
  SELECT topic, max(n) / sum(n) >= {C.ALIGNED_SHARE} AS aligned FROM crosstab WHERE topic <> -1 GROUP BY topic
), totals AS (SELECT count(*) FILTER (aligned) AS aligned_topics, count(*) AS total_topics FROM per_topic)
SELECT *, CASE WHEN total_topics = 0 THEN 'none' WHEN aligned_topics = total_topics THEN 'strong'
  WHEN aligned_topics >= total_topics // 2 THEN 'partial' ELSE 'weak' END AS verdict FROM totals""",
    }
