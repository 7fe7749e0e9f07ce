"""SQL for the operators that SQL can express."""

from __future__ import annotations

from earshot.llm.chat import BEGIN, END, MIDDLE
from earshot.llm.urls import RULES


def url_filter() -> str:
    rules = ", ".join(f"('{r.text}', '{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    lower = lambda text: f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {rules}),
    rest AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ),
    parts AS (
        SELECT page_id, {lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest
    ),
    fitting AS (
        SELECT page_id, host, path, rule, verdict,
               row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, length(rule_host) DESC) AS place
        FROM parts LEFT JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1
    """


def topk_search() -> str:
    return """
    WITH usable AS (
        SELECT vec_id, embedding FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
    ),
    vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM usable
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 50 = 0
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
    )
    SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
    """


def chat_format() -> str:
    escaped = lambda c: rf"regexp_replace({c}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"
    return f"""
    WITH given AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
    ),
    whole AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
               string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text) AS loss,
               sum({len(BEGIN + MIDDLE + END)} + length({escaped("role")}) + length({escaped("text")}))::BIGINT AS formatted_chars
        FROM given GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars
    FROM whole
    """


def _tree(name: str, leaves: str) -> str:
    """CTEs of one forest over ``leaves`` (tree, idx, n, digest): all nodes, and
    for each leaf of ``<name>_shown`` (row, tree, idx, n, digest) its siblings and
    the root that it folds to."""
    return f"""
    {name}_nodes AS (
        SELECT tree, 0 AS level, idx, n, digest FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
        FROM {name}_nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n
    ),
    {name}_proofs AS (
        SELECT l.tree, l.idx, coalesce(string_agg(s.digest, '' ORDER BY s.level), '') AS proof
        FROM {leaves} l LEFT JOIN {name}_nodes s ON s.tree = l.tree AND s.idx = xor(l.idx >> s.level, 1)
        GROUP BY l.tree, l.idx
    ),
    {name}_folded AS (
        SELECT row, tree, 0 AS level, idx, n, digest FROM {name}_shown
        UNION ALL
        SELECT f.row, f.tree, f.level + 1, f.idx // 2, (f.n + 1) // 2, sha256(CASE WHEN f.idx % 2 = 1 THEN s.digest || f.digest ELSE f.digest || coalesce(s.digest, '') END)
        FROM {name}_folded f LEFT JOIN {name}_nodes s ON s.tree = f.tree AND s.level = f.level AND s.idx = xor(f.idx, 1)
        WHERE f.n > 1
    )"""


def merkle_manifest() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda n_chars: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"
    # The bits of crc32, each byte followed by eight shifts (-1).
    steps = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"""xor(list_reduce(list_concat([4294967295::BIGINT], {steps}),
        lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)"""
    return f"""
    WITH RECURSIVE given AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS digest,
               CASE WHEN coalesce({crc} % 7 = 0, false) AND n_chars IS NOT NULL THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS shown
        FROM documents
    ),
    leaves AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
               count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS row
        FROM given
    ),
    low_shown AS (SELECT row, tree, idx, n, shown AS digest FROM leaves),
    {_tree("low", "leaves")},
    subroots AS (
        SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, digest
        FROM low_nodes WHERE n = 1
    ),
    high_shown AS (
        SELECT f.row, '' AS tree, s.idx, s.n, f.digest FROM low_folded f JOIN subroots s ON s.lang = f.tree WHERE f.n = 1
    ),
    {_tree("high", "subroots")}
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(p.proof || h.proof) AS proof_sha256,
           f.digest AS folded_root, f.digest = r.digest AS verified
    FROM leaves l JOIN subroots s ON s.lang = l.tree JOIN low_proofs p ON p.tree = l.tree AND p.idx = l.idx
    JOIN high_proofs h ON h.idx = s.idx JOIN high_folded f ON f.row = l.row AND f.n = 1
    CROSS JOIN (SELECT digest FROM high_nodes WHERE n = 1) r
    """


def statements() -> dict[str, str]:
    return {
        "op2_url_filter": url_filter(), "op4_topk_search": topk_search(), "op8_chat_format": chat_format(),
        "op13_merkle_manifest": merkle_manifest(),
    }
