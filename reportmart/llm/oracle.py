"""The results of the queries in SQL, where SQL can express them."""

from __future__ import annotations

from .common import UPPER
from .licenses import MAX_GAP, RULES, SENTENCES, beginnings, known_sentences
from .queries import ADDED, ADDED_TEXT

LOWERED = "translate({}, '" + UPPER + "', '" + UPPER.lower() + "')"


def listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


OP1 = rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES ({ADDED}, 0, 'user', '{ADDED_TEXT}'), ({ADDED}, 1, 'assistant', '{ADDED_TEXT}')
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), ''))
        AS loss_sha256,
    sum(14 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g'))
        + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""


ITEM = r"^(\([a-z0-9]{1,2}\)|[0-9]{1,2}[.)]|[-•])[ \t]+"


def licenses_sql() -> str:
    """Lines are numbered and grouped to sentences by a window over their breaks."""
    known = known_sentences(SENTENCES)
    sentence = LOWERED.format("s")
    steps, at = [], "found"
    for number, (name, ids) in enumerate(RULES):
        rule = "'" + "".join(f"<{s}>" for s in ids) + "'"
        n = f"(length(rest) - length(replace(rest, {rule}, ''))) // length({rule})"
        steps.append(
            f"""r{number} AS (
    SELECT doc_id, identifiers, replace(rest, {rule}, '|') AS rest,
        names || CASE WHEN {n} > 0 THEN '{name}:' || ({n})::VARCHAR || ',' ELSE '' END AS names,
        total + {n} AS total
    FROM {at})"""
        )
        at = f"r{number}"
    names = f"coalesce('<' || ({listed([*known.values()])})[list_position({listed([*known])}, {{}})] || '>', {{}})"
    whole, line = names.format("said", "NULL"), names.format("p", "'_'")
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), raw AS (
    SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM docs
), stripped AS (
    SELECT rid, doc_id, n, ltrim(regexp_replace(line, '\r$', ''), ' #*/;' || chr(9)) AS line FROM raw
), marked_lines AS (
    SELECT rid, doc_id, n, regexp_matches(line, '{ITEM}') AS item, regexp_replace(line, '{ITEM}', '') AS line
    FROM stripped
), breaks AS (
    SELECT rid, doc_id, n, line, item OR line = '' OR regexp_matches(line, '^{beginnings(known)}')
        OR coalesce(lag(line = '' OR
        regexp_matches(line, '[.!?:][ \t]*$')) OVER (PARTITION BY rid ORDER BY n), false) AS breaks
    FROM marked_lines
), numbered AS (
    SELECT *, sum(breaks::INT) OVER (PARTITION BY rid ORDER BY n) AS g FROM breaks
), paragraphs AS (
    SELECT rid, doc_id, g, string_split(regexp_replace(string_agg(line, chr(10) ORDER BY n),
        '([.!?])[ \t]+', '\1' || chr(1), 'g'), chr(1)) AS cut
    FROM numbered GROUP BY ALL
), sentences AS (
    SELECT rid, doc_id, g, unnest(cut) AS s, generate_subscripts(cut, 1) AS i FROM paragraphs
), normal AS (
    SELECT *, trim(regexp_replace({sentence}, '[^a-z0-9]+', ' ', 'g'), ' ') AS said FROM sentences
), named AS (
    SELECT rid, doc_id, g, i, coalesce({whole}, array_to_string(list_transform(list_filter(list_transform(
        string_split(regexp_replace(s, '\n([a-z])', ' \1', 'g'), chr(10)),
        lambda p: trim(regexp_replace({LOWERED.format("p")}, '[^a-z0-9]+', ' ', 'g'), ' ')),
        lambda p: p <> ''), lambda p: {line}), ''), '') AS mark
    FROM normal
), marked AS (
    SELECT doc_id, string_agg(mark, '' ORDER BY g, i) AS marked FROM named GROUP BY rid, doc_id
), found AS (
    SELECT doc_id, regexp_replace(replace(regexp_replace(marked, '_{{{MAX_GAP + 1},}}', '|', 'g'), '_', ''),
        '^\||\|$', '', 'g') AS identifiers, identifiers AS rest, '' AS names, 0::BIGINT AS total
    FROM marked
), {", ".join(steps)}
SELECT doc_id, identifiers, rtrim(names, ',') AS licenses, total::BIGINT AS n_matches,
    replace(rest, '|', '') AS unmatched
FROM {at}
"""


OP7 = f"""
WITH lowered AS (SELECT doc_id, {LOWERED.format("coalesce(text, '')")} AS text FROM documents),
groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM lowered GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
    sha256(text) AS text_sha256
FROM lowered JOIN groups USING (text)
"""

OP9 = """
WITH usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
    FROM usable q, usable c
    WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
        vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP11 = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents),
windows AS (
    SELECT doc_id, pos, substr(body, 2 * pos + 1, 100) AS said
    FROM bytes, unnest(range(0, greatest(0, len(body) // 2 - 49))) AS t(pos)
), first AS (SELECT said, min(doc_id) AS first FROM windows GROUP BY said),
gone AS (SELECT doc_id, pos FROM windows JOIN first USING (said) WHERE doc_id > first),
starts AS (
    SELECT doc_id, pos,
        coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, true)::INT AS opens
    FROM gone
), numbered AS (
    SELECT doc_id, pos, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM starts
), spans AS (
    SELECT doc_id, span, min(pos) AS start, max(pos) + 50 AS stop FROM numbered GROUP BY ALL
), kept AS (
    SELECT doc_id, body, start, stop,
        coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS since,
        row_number() OVER (PARTITION BY doc_id ORDER BY start DESC) = 1 AS last
    FROM bytes LEFT JOIN spans USING (doc_id)
), parts AS (
    SELECT doc_id, len(any_value(body)) // 2 AS n_bytes, coalesce(sum(stop - start), 0) AS n_removed,
        count(start) AS n_spans,
        string_agg(substr(body, 2 * since + 1, 2 * (coalesce(start, len(body) // 2) - since))
            || CASE WHEN last AND stop IS NOT NULL THEN substr(body, 2 * stop + 1) ELSE '' END,
            '' ORDER BY start) AS body
    FROM kept GROUP BY doc_id
)
SELECT doc_id, n_bytes, n_removed::BIGINT AS n_removed, n_spans, sha256(unhex(body)) AS kept_sha256
FROM parts
"""

OP13 = r"""
WITH RECURSIVE codes AS (
    SELECT list(code ORDER BY n) AS codes FROM (
        SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS code
        FROM range(256) AS t(n))
), given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce([4294967295] || list_transform(
                string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                lambda c: ord(c)::BIGINT),
            lambda a, b: xor(codes[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS fault
    FROM conversations, codes
), damaged AS (
    SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
    FROM given
), placed AS (
    SELECT conv_id, turn, role, text, role[1] AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM damaged
), faulty AS (
    SELECT *, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
        initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY place) AS pair
    FROM placed
), insertions(state, next, cost, audit, said) AS (
    VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
        (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'),
        (3, 2, 5, 'I', chr(10) || 'user:'), (2, 3, 5, 'I', chr(10) || 'assistant:'),
        (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), edits(letter, state, next, initial, cost, role) AS (
    VALUES ('K', 0, 1, 's', 0, NULL), ('K', 0, 2, 'u', 0, NULL), ('K', 1, 2, 'u', 0, NULL),
        ('K', 3, 2, 'u', 0, NULL), ('K', 2, 3, 'a', 0, NULL), ('R', 0, 2, NULL, 1, 'user'),
        ('R', 1, 2, NULL, 1, 'user'), ('R', 3, 2, NULL, 1, 'user'), ('R', 2, 3, NULL, 1, 'assistant'),
        ('D', 0, 0, NULL, 2, NULL), ('D', 1, 1, NULL, 2, NULL), ('D', 2, 2, NULL, 2, NULL), ('D', 3, 3, NULL, 2, NULL)
), reached AS (
    SELECT conv_id, 0::BIGINT AS place, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'said': ''} AS best
    FROM damaged GROUP BY conv_id
    UNION ALL
    SELECT r.conv_id, p.place, e.next, min({
        'cost': r.best.cost + i.cost + e.cost + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': r.best.audit || i.audit || letter,
        'said': r.best.said || i.said
            || CASE letter WHEN 'D' THEN '' ELSE chr(10) || coalesce(e.role, p.role) || ':' || text END})
    FROM reached r
    JOIN insertions i ON i.state = r.state
    JOIN faulty p ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND p.place = r.place + 1
    JOIN edits e ON e.state = i.next AND (letter = 'D'
        OR fault NOT IN ('blank', 'duplicate') AND (letter = 'R' OR e.initial = p.initial))
    GROUP BY r.conv_id, p.place, e.next
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM faulty GROUP BY conv_id
), goals AS (
    SELECT r.conv_id, min({'cost': r.best.cost + i.cost, 'audit': r.best.audit || i.audit, 'said': r.best.said || i.said}) AS best
    FROM reached r JOIN insertions i ON i.state = r.state
    JOIN counted c ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND c.n = r.place
    WHERE i.next IN (0, 3) GROUP BY r.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN goals g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE = {
    "op1_chat": OP1,
    "op3_licenses": licenses_sql(),
    "op7_exact_dedup": OP7,
    "op9_vector_search": OP9,
    "op11_suffixes": OP11,
    "op13_repair": OP13,
}
