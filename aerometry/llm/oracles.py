"""SQL with the same result, for the queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p, len(ws) AS n
            FROM (
                SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
                FROM documents
            )
        ),
        windows AS (
            SELECT doc_id, p, md5(phrase) AS name
            FROM (
                SELECT doc_id, p, n, string_agg(word, ' ') OVER (
                    PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING
                ) AS phrase
                FROM words
            )
            WHERE p + 49 <= n
        ),
        firsts AS (SELECT name, min(doc_id) AS first_doc FROM windows GROUP BY name),
        gone AS (
            SELECT DISTINCT doc_id, p + j AS p
            FROM windows JOIN firsts USING (name), range(50) AS steps(j)
            WHERE first_doc < doc_id
        ),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS left_words, count(*) AS n_left
            FROM words ANTI JOIN gone USING (doc_id, p)
            GROUP BY doc_id
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)
        SELECT
            doc_id,
            CAST(coalesce(n, 0) AS BIGINT) AS n_words,
            CAST(coalesce(n, 0) - coalesce(n_left, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(left_words, '')) AS kept_sha256
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op5_preference_format": r"""
        WITH own AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
        last_answers AS (
            SELECT conv_id, turn, text
            FROM own
            WHERE role = 'assistant'
            QUALIFY row_number() OVER (
                PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text DESC NULLS LAST
            ) = 1
        ),
        swaps AS (
            SELECT a.conv_id, a.turn, a.text, b.text AS other
            FROM last_answers AS a JOIN last_answers AS b ON b.conv_id - 1 = a.conv_id
        ),
        sided AS (
            SELECT conv_id, 0 AS side, turn, role, text FROM own SEMI JOIN swaps USING (conv_id)
            UNION ALL
            SELECT
                own.conv_id, 1, own.turn, role,
                CASE WHEN role = 'assistant' AND own.turn IS NOT DISTINCT FROM swaps.turn
                    AND own.text IS NOT DISTINCT FROM swaps.text THEN other ELSE own.text END
            FROM own JOIN swaps USING (conv_id)
        ),
        turns AS (
            SELECT
                conv_id AS pair_id, side, role, text,
                replace(coalesce(role, ''), '<|', '< |') AS shown_role,
                replace(coalesce(text, ''), '<|', '< |') AS shown_text,
                row_number() OVER (
                    PARTITION BY conv_id, side
                    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
                ) AS n
            FROM sided
        ),
        common AS (
            SELECT pair_id, coalesce(min(n) FILTER (WHERE NOT same) - 1, max(n)) AS c
            FROM (
                SELECT
                    coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.n, b.n) AS n,
                    a.n IS NOT NULL AND b.n IS NOT NULL
                        AND a.role IS NOT DISTINCT FROM b.role
                        AND a.text IS NOT DISTINCT FROM b.text AS same
                FROM (SELECT * FROM turns WHERE side = 0) AS a
                FULL JOIN (SELECT * FROM turns WHERE side = 1) AS b
                    ON a.pair_id = b.pair_id AND a.n = b.n
            )
            GROUP BY pair_id
        ),
        shown AS (
            SELECT
                pair_id, side, n, role, c, n > c AS own,
                '<|im_start|>' || shown_role || chr(10) AS heading, shown_text,
                '<|im_start|>' || shown_role || chr(10) || shown_text || '<|im_end|>' || chr(10)
                    AS turn_text
            FROM turns JOIN common USING (pair_id)
        ),
        placed AS (
            SELECT *, length(heading) + coalesce(sum(length(turn_text)) OVER (
                PARTITION BY pair_id, side, own ORDER BY n
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            ), 0) AS start
            FROM shown
        ),
        sides AS (
            SELECT
                pair_id, side, any_value(c) AS c,
                coalesce(string_agg(turn_text, '' ORDER BY n) FILTER (WHERE NOT own), '') AS prompt,
                coalesce(string_agg(turn_text, '' ORDER BY n) FILTER (WHERE own), '') AS completion,
                coalesce(string_agg(
                    CAST(start AS BIGINT) || ':' || CAST(start + length(shown_text) + 10 AS BIGINT),
                    ',' ORDER BY n
                ) FILTER (WHERE own AND role = 'assistant'), '') AS loss,
                count(*) FILTER (WHERE own) AS n
            FROM placed
            GROUP BY pair_id, side
        )
        SELECT
            pair_id,
            CAST(max(c) AS BIGINT) AS n_prompt_turns,
            max(prompt) AS prompt,
            max(completion) FILTER (WHERE side = 0) AS chosen,
            max(loss) FILTER (WHERE side = 0) AS chosen_loss,
            max(n) FILTER (WHERE side = 0) AS n_chosen_turns,
            max(completion) FILTER (WHERE side = 1) AS rejected,
            max(loss) FILTER (WHERE side = 1) AS rejected_loss,
            max(n) FILTER (WHERE side = 1) AS n_rejected_turns
        FROM sides
        GROUP BY pair_id
    """,
    "op13_warc": """
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ),
        hashed AS (
            SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM payloads
        ),
        told AS (
            SELECT
                page_id, n,
                array_to_string(list_transform(range(32), lambda i: substr(
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER)
                        >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1
                )), '') AS digest
            FROM hashed
        ),
        lasts AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS last_page FROM told)
        SELECT
            page_id,
            CAST(n AS BIGINT) AS payload_bytes,
            digest AS payload_digest,
            CASE WHEN page_id = last_page THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> last_page THEN last_page END AS refers_to
        FROM lasts
    """,
}
