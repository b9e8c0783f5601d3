"""SQL for the registered queries over conversations and for the vector codes."""

from __future__ import annotations

from moodtape.llm import chat_format, vector_codes

TRIE = r"""
    WITH RECURSIVE said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ),
    hashed AS (
        SELECT conv_id, turn, substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS digest,
            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
        FROM said
    ),
    own AS (
        SELECT conv_id, list({'digest': digest, 'words': words} ORDER BY turn NULLS FIRST, digest) AS turns FROM hashed GROUP BY conv_id
    ),
    crc_steps AS (SELECT b, 0 AS step, b::BIGINT AS c FROM range(256) t(b)
        UNION ALL SELECT b, step + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE step < 8),
    crc_of AS (SELECT b, c FROM crc_steps WHERE step = 8),
    crc_run AS (
        SELECT conv_id, conv_id::VARCHAR AS rest, 4294967295::BIGINT AS c FROM own
        UNION ALL
        SELECT conv_id, substr(rest, 2), xor(t.c, r.c >> 8)
        FROM crc_run r JOIN crc_of t ON t.b = xor(r.c & 255, unicode(rest)::BIGINT) WHERE rest <> ''
    ),
    taken AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crc_run WHERE rest = ''),
    rebuilt AS (
        SELECT o.conv_id, coalesce(b.turns[1:h], []) || o.turns[h + 1:] AS turns
        FROM own o JOIN taken USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
    ),
    prefixes AS (
        SELECT conv_id, depth, len(turns) = depth AS whole,
            array_to_string(list_transform(turns[1:depth], lambda t: t.digest), '') AS path,
            array_to_string(list_transform(turns[1:depth - 1], lambda t: t.digest), '') AS above,
            CASE WHEN depth > 0 THEN turns[depth].words ELSE 0 END AS words
        FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)
    ),
    nodes AS (
        SELECT path, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
            coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole), '') AS ends
        FROM prefixes GROUP BY path, depth
    ),
    children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
    counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path)),
    below AS (
        SELECT p.path, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((c.n_convs - 1) * c.words) AS saved_tokens
        FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth
        GROUP BY p.path
    )
    SELECT c.conv_id, c.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
        c.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(c.ends) AS ends_sha256
    FROM counted c JOIN below b USING (path) LEFT JOIN nodes u ON c.depth > 0 AND u.path = c.above
"""

_MARK = r"<\|(\\*im_(?:start|end)\|>)"

CHAT = rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
    ),
    shown AS (
        SELECT *, regexp_replace(text, '{_MARK}', '<|\\\1', 'g') AS safe,
            regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '{_MARK}', '<|\\\1', 'g') AS safe_role,
            regexp_matches(text, '{_MARK}') OR regexp_matches(role, '{_MARK}') OR contains(role, chr(10)) OR contains(role, '\n')
                OR contains(role, '\\') AS conflicts
        FROM rows
    ),
    framed AS (
        SELECT conv_id, turn, role, text,
            '{chat_format.START}' || CASE WHEN conflicts THEN safe_role || chr(10) || safe ELSE role || chr(10) || text END
                || '{chat_format.END}' || chr(10) AS rendered
        FROM shown
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length(rendered))::BIGINT AS formatted_chars
    FROM framed GROUP BY conv_id
"""


def _codes() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    steps = [
        f"""
    WITH sound AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v,
            len(embedding) // {parts} AS width, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    parts AS MATERIALIZED (
        SELECT row, vec_id, label, p::INTEGER AS p, v[p * width + 1:(p + 1) * width] AS part FROM sound, range({parts}) t(p)
    ),
    book0 AS MATERIALIZED (SELECT p, (row - 1)::INTEGER AS e, part AS entry FROM parts WHERE row <= {entries})"""
    ]
    apart = "list_sum(list_transform(range(1, len(part) + 1), lambda i: (part[i] - entry[i]) * (part[i] - entry[i])))::BIGINT"
    for n in range(rounds + 1):
        steps.append(
            f"""
    near{n} AS MATERIALIZED (
        SELECT row, a.p, any_value(part) AS part, min({{'d': {apart}, 'e': e}}) AS best FROM parts a JOIN book{n} b ON a.p = b.p GROUP BY row, a.p
    )"""
        )
        if n < rounds:
            steps.append(
                f"""
    sums{n} AS (
        SELECT p, e, i, sum(x)::BIGINT AS total, count(*) AS n FROM (
            SELECT p, best.e AS e, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM near{n}
        ) GROUP BY p, e, i
    ),
    means{n} AS (SELECT p, e, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY i) AS entry FROM sums{n} GROUP BY p, e),
    book{n + 1} AS MATERIALIZED (
        SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{n} b LEFT JOIN means{n} m ON m.p = b.p AND m.e = b.e
    )"""
            )
    steps.append(
        f"""
    coded AS (
        SELECT row, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY row
    ),
    said AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
    FROM sound JOIN coded USING (row), said
"""
        )
    return ",".join(steps[:-1]) + "," + steps[-1]


CODES = _codes()
