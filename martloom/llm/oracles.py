"""SQL counterparts that take some building: licence rules, and components of a Jaccard join."""

from __future__ import annotations

import re

from martloom.llm.license_scan import GRANT, JOINED_TAG, NO_GRANT, RULES, SENTENCES, SUBJECT, TAG


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    """Known sentences of both readings by a join, rules as patterns over their names."""
    known = ", ".join(f"({quoted(words)}, {quoted(name)})" for name, words in SENTENCES.items())
    cases: dict[str, list[str]] = {}
    for licence, rule, needs in RULES:
        gaps = ["" if name.startswith("gnu-version") else ".*" for name in needs[1:]] + [""]
        pattern = quoted("".join(f" {n} {g}" for n, g in zip(needs, gaps, strict=True)))
        cases.setdefault(licence, []).append(
            f"WHEN regexp_matches(a, {pattern}) OR regexp_matches(b, {pattern}) "
            f"THEN {quoted(f'{licence}:{rule}')}"
        )
    decided = ", ".join(f"CASE {' '.join(whens)} END" for whens in cases.values())
    ends = r"'[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+$|\n+'"
    paragraphs = (
        r"array_to_string(list_transform(string_split_regex(content, '\n\n+'), "
        r"lambda p: replace(p, chr(10), ' ')), chr(10))"
    )

    as_they_stand = ", ".join(quoted(w) for w in SENTENCES.values() if re.match(SUBJECT, w))

    def names(text: str) -> str:
        return f"""(
          SELECT coalesce(list(name ORDER BY place), []) FROM (
            SELECT trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS s, place FROM (
              SELECT unnest(parts) AS part, generate_subscripts(parts, 1) AS place
              FROM (SELECT string_split_regex({text}, {ends}) AS parts)))
          JOIN known ON words = CASE
            WHEN s IN ({as_they_stand}) OR regexp_matches(s, {quoted(NO_GRANT)}) THEN s
            ELSE regexp_replace(s, {quoted(SUBJECT)}, {quoted(GRANT)}) END)"""

    return f"""
    WITH known(words, name) AS (VALUES {known}),
    texts AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), {quoted(TAG)}, {quoted(JOINED_TAG)}, 'g')
               AS content FROM documents),
    found AS (
      SELECT doc_id, {names('content')} AS lines, {names(paragraphs)} AS joined FROM texts),
    spaced AS (
      SELECT doc_id, if(lines = joined, lines, list_concat(lines, joined)) AS ids,
             '  ' || array_to_string(lines, '  ') || '  ' AS a,
             '  ' || array_to_string(joined, '  ') || '  ' AS b
      FROM found)
    SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
           array_to_string(list_sort(list_filter([{decided}], lambda x: x IS NOT NULL)), ',')
             AS licenses
    FROM spaced"""


#: Links from counts of common shingles, and components as the least document within reach.
JACCARD_SQL = r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(
          string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
          lambda w: w <> '') AS w
      FROM documents),
    sets AS (
      SELECT doc_id, CASE
          WHEN len(w) = 0 THEN []
          WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(
              range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        END AS shingles
      FROM words),
    shingled AS (SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS s FROM sets),
    links AS (
      SELECT a.doc_id AS x, b.doc_id AS y
      FROM shingled a JOIN shingled b
        ON a.s = b.s AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
      GROUP BY x, y, a.n, b.n
      HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    reach AS (
      SELECT doc_id AS x, doc_id AS y FROM documents
      UNION
      SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
    SELECT doc_id, len(shingles) AS n_shingles, component_id
    FROM sets JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
      USING (doc_id)"""

# Forward over the rows of each conversation, the cheapest way into each state kept with its edits
# and lines; up to three rows are inserted before a row. The checksum's table is made by its rule.
REPAIR_SQL = r"""
    WITH RECURSIVE remainders AS (
        SELECT list(r ORDER BY b) AS t FROM (
            SELECT b, list_reduce(
                list_prepend(b::BIGINT, range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            ) AS r FROM range(256) AS bytes(b))
    ), drawn AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(
                       string_split(coalesce(conv_id::VARCHAR, ' ') || ':'
                                    || coalesce(turn::VARCHAR, ' '), ''),
                       lambda d: ascii(d)::BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
               )) % 20 AS draw
        FROM conversations, remainders
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
               CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                    ELSE text END AS text
        FROM drawn, range(2) AS copies(copy) WHERE draw <> 0 AND (draw = 3 OR copy = 0)
    ), numbered AS (
        SELECT *, left(role, 1) AS initial, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n
        FROM damaged
    ), judged AS (
        SELECT *, CASE
                WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1
                    THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
                ELSE '' END AS fault,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
        FROM numbered
    ), inserted (state, k, wanted, added, lines) AS (
        VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 1, 2, 'I', ['user:']),
               (0, 2, 3, 'II', ['user:', 'assistant:']),
               (0, 3, 2, 'III', ['user:', 'assistant:', 'user:']),
               (1, 0, 1, '', []), (1, 1, 2, 'I', ['user:']),
               (1, 2, 3, 'II', ['user:', 'assistant:']),
               (1, 3, 2, 'III', ['user:', 'assistant:', 'user:']),
               (2, 0, 2, '', []), (2, 1, 3, 'I', ['assistant:']),
               (2, 2, 2, 'II', ['assistant:', 'user:']),
               (2, 3, 3, 'III', ['assistant:', 'user:', 'assistant:']),
               (3, 0, 3, '', []), (3, 1, 2, 'I', ['user:']),
               (3, 2, 3, 'II', ['user:', 'assistant:']),
               (3, 3, 2, 'III', ['user:', 'assistant:', 'user:'])
    ), edits (state, edit, next_state, needs, new_role, price) AS (
        VALUES (0, 'D', 0, '', '', 2), (1, 'D', 1, '', '', 2), (2, 'D', 2, '', '', 2),
               (3, 'D', 3, '', '', 2), (0, 'K', 1, 's', '', 0), (0, 'K', 2, 'u', '', 0),
               (1, 'K', 2, 'u', '', 0), (2, 'K', 3, 'a', '', 0), (3, 'K', 2, 'u', '', 0),
               (0, 'R', 2, '', 'user', 1), (1, 'R', 2, '', 'user', 1),
               (2, 'R', 3, '', 'assistant', 1), (3, 'R', 2, '', 'user', 1)
    ), ways AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS n, 0 AS state,
               {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best
        FROM judged
        UNION ALL
        SELECT conv_id, n, state, min(way) FROM (
            SELECT w.conv_id, r.n, e.next_state AS state, {
                    'cost': (w.best.cost + 5 * i.k + e.price + CASE WHEN e.edit <> 'D'
                             AND r.fault = 'truncated' THEN 5 ELSE 0 END)::BIGINT,
                    'audit': w.best.audit || i.added || e.edit,
                    'lines': w.best.lines || i.lines || CASE e.edit WHEN 'D' THEN []
                        WHEN 'K' THEN [r.role || ':' || r.text]
                        ELSE [e.new_role || ':' || r.text] END
                } AS way
            FROM ways w
            JOIN inserted i ON i.state = w.state
            JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1
            JOIN edits e ON e.state = i.wanted AND (e.edit = 'D'
                OR r.fault NOT IN ('blank', 'duplicate') AND e.needs IN ('', r.initial))
        ) GROUP BY conv_id, n, state
    ), lengths AS (
        SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
               coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
        FROM judged GROUP BY conv_id
    ), finished AS (
        SELECT w.conv_id, min({'cost': w.best.cost + 5 * i.k, 'audit': w.best.audit || i.added,
                               'lines': w.best.lines || i.lines}) AS best
        FROM ways w JOIN inserted i ON i.state = w.state AND i.wanted IN (0, 3)
        JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.n
        GROUP BY w.conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
           coalesce(best.audit, '') AS audit,
           sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
    """

HARD_NEGATIVES_SQL = """
    WITH rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    ), scored AS (
        SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
               list_inner_product(a.v, r.v)::BIGINT AS score
        FROM rows a JOIN rows r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id
                              ORDER BY score DESC, vec_id)::INT AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    QUALIFY rank <= 10
    """
