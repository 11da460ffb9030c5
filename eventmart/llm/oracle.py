"""DuckDB SQL of the text operators that SQL can express, on the same tables."""

from __future__ import annotations

from eventmart.llm import mixing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = r"[\x20\x09-\x0D]"

OP1 = rf"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), spot AS (
    SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (
        SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size
    )
), hit AS (
    SELECT DISTINCT r, i, spot.size, item_id FROM spot JOIN win USING (words, size)
), counted AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT r, i, size FROM hit)) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN counted USING (r) LEFT JOIN named USING (r)
"""


def _weights(level: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {w}" for name, w in mixing.WEIGHTS[level].items())
    return f"CASE {level} {cases} ELSE 1 END"


def _division(number: int, parent: list[str], level: str) -> str:
    """Common table expressions that divide each parent's budget among its children."""
    path = ", ".join([*parent, level])
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    joined = f"JOIN node{number} USING ({', '.join(parent)})" if parent else f"CROSS JOIN node{number}"
    return f"""
child{number} AS (
    SELECT *, capacity / weight AS ratio
    FROM (SELECT {path}, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * {mixing.MAX_EPOCHS} AS BIGINT) AS capacity,
                 CAST({_weights(level)} AS BIGINT) AS weight FROM leaf GROUP BY {path}) AS c {joined}
), ranked{number} AS (
    SELECT *, coalesce(sum(capacity) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(weight) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
    FROM child{number}
), marked{number} AS (
    SELECT *, before * weight + capacity * after <= budget * weight AS filled FROM ranked{number}
), node{number + 1} AS (
    SELECT {path}, tokens, CAST(CASE WHEN filled THEN capacity ELSE
           ((budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({part})) * weight)
           // nullif(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part}), 0) END AS BIGINT) AS budget
    FROM marked{number}
)"""


OP3 = rf"""
WITH row_ AS (
    SELECT doc_id, lang, source, md5(coalesce(text, '')) AS content,
           'd' || translate(substr(md5(coalesce(source, '')), 1, 1), '0123456789abcdef', '0000111122223333') AS domain,
           coalesce(lang, '') AS language,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
    FROM documents
), keyed AS (
    SELECT doc_id, content, lang, domain, language, coalesce(source, '') AS source, source AS given_source, tokens FROM row_
), leaf AS (
    SELECT domain, language, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM keyed GROUP BY ALL
), node0 AS (
    SELECT CAST(least(coalesce(sum(tokens), 0) * {mixing.BUDGET_SHARE[0]} // {mixing.BUDGET_SHARE[1]},
                      coalesce(sum(tokens), 0) * {mixing.MAX_EPOCHS}) AS BIGINT) AS budget FROM leaf
),{_division(0, [], "domain")},{_division(1, ["domain"], "language")},{_division(2, ["domain", "language"], "source")},
plan AS (
    SELECT domain, language, source, coalesce(budget // nullif(tokens, 0), 0) AS epochs,
           budget - coalesce(budget // nullif(tokens, 0), 0) * tokens AS rest FROM node3
), hashed AS (
    SELECT keyed.*, epochs, rest, 
           md5('{mixing.SEED}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || content) AS h
    FROM keyed JOIN plan USING (domain, language, source)
), summed AS (
    SELECT *, sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           - sum(tokens) OVER (PARTITION BY domain, language, source, h) AS before FROM hashed
)
SELECT doc_id, domain, lang, given_source AS source,
       CAST(unnest(range(0, epochs + CASE WHEN before < rest THEN 1 ELSE 0 END)) AS BIGINT) AS epoch
FROM summed
"""

OP6 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, regexp_replace(text, '([\\\[<])', '\\\1', 'g') AS escaped,
           CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                ELSE 22 + length(regexp_replace(role, '([\\\[<])', '\\\1', 'g')) END AS marks,
           lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, escaped)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(escaped) + marks) AS BIGINT) AS formatted_chars,
       bool_and((before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
           AND last(role ORDER BY turn NULLS FIRST, role, escaped) IN ('user', 'assistant') AS valid
FROM sized GROUP BY conv_id
"""

OP7 = rf"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g') AS norm FROM documents
), g AS (
    SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

OP10 = rf"""
WITH line AS (
    SELECT doc_id, n, raw, translate(regexp_replace(raw, '^{BLANK}+|{BLANK}+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n FROM documents)
), frequent AS (
    SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT doc_id, n, raw, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM line LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(coalesce(sum(CAST(gone AS INTEGER)), 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

RULE_SQL = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]+", 0, 16),
}


def _op5() -> str:
    """Base spans: the gaps between matches give the positions; further kinds have no match of their own in the tables."""
    parts = " UNION ALL ".join(
        f"""SELECT r, {rank} AS rank, '{kind}' AS kind, n, len(hit) AS size, len(part) >= {least} AS counts, len(gap) AS gap FROM (
            SELECT r, unnest(range(len(regexp_extract_all(text, '{pattern}')))) AS n,
                   unnest(regexp_extract_all(text, '{pattern}')) AS hit,
                   unnest(regexp_extract_all(text, '{pattern}', {group})) AS part,
                   unnest(regexp_split_to_array(text, '{pattern}')[:len(regexp_extract_all(text, '{pattern}'))]) AS gap
            FROM doc)"""
        for rank, (kind, (pattern, group, least)) in enumerate(RULE_SQL.items())
    )
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), m AS ({parts}), placed AS (
    SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, kind ORDER BY n) AS BIGINT) AS stop FROM m
), base AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || (stop - size) || ':' || stop, ',' ORDER BY stop - size, rank) AS spans
    FROM placed WHERE counts GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN base USING (r)
"""


OP12 = """
WITH e AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
           CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM e AS a JOIN e AS c ON a.r <> c.r WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5
), ranked AS (
    SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS rank
    FROM positive AS p JOIN pair AS n ON n.anchor = p.anchor AND NOT n.same
     AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""

OP13 = rf"""
WITH piece AS (
    SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
), total AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang
), place AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece
), phrase AS (
    SELECT lang, k, words, count(*) AS f
    FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS words FROM place, range(1, 6) AS size(k) WHERE i + k - 1 <= len(w))
    GROUP BY lang, k, words HAVING count(*) >= 100
), inner_ AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS words, max(f) AS longer
    FROM (SELECT lang, string_split(words, ' ') AS w, k AS size, f FROM phrase WHERE k > 2),
         range(1, 5) AS start(i), range(2, 5) AS length(k)
    WHERE k < size AND i + k - 1 <= size GROUP BY ALL
), cut AS (
    SELECT c.lang, c.words, c.k AS size, c.f AS a, i,
           array_to_string(string_split(c.words, ' ')[:i], ' ') AS head, array_to_string(string_split(c.words, ' ')[i + 1:], ' ') AS tail
    FROM phrase AS c LEFT JOIN inner_ AS b USING (lang, words), range(1, 5) AS spot(i)
    WHERE c.k > 1 AND i < c.k AND (longer IS NULL OR 100 * longer < 100 * c.f)
), scored AS (
    SELECT cut.lang, cut.words AS phrase, a, x.f AS l, y.f AS r, n,
           (1000 * CAST(a AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cut JOIN phrase AS x ON x.lang = cut.lang AND x.words = head JOIN phrase AS y ON y.lang = cut.lang AND y.words = tail
    JOIN total ON total.lang = cut.lang
    QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.words ORDER BY score, i) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM scored QUALIFY rank <= 2000
"""

ORACLE_SQL = {
    "op1_decontamination": OP1,
    "op3_mixing": OP3,
    "op5_secret_scan": _op5(),
    "op6_chat_format": OP6,
    "op7_exact_dedup": OP7,
    "op10_line_dedup": OP10,
    "op12_hard_negatives": OP12,
    "op13_phrases": OP13,
}
