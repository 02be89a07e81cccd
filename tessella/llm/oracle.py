"""SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_MARKS = r"'\\|\[INST\]|\[/INST\]|</s>|<s>|\[ROLE\]|\[/ROLE\]'"
_ESCAPED = lambda c: f"(length({c}) + len(regexp_extract_all({c}, {_MARKS})))"

ORACLE: dict[str, str] = {
    "op4_vantage_points": """
        WITH v AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        d AS (SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda j: (q.e[j] - v.e[j]) * (q.e[j] - v.e[j])), lambda a, b: a + b)) AS score FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id AND len(v.e) = len(q.e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS n FROM d)
        SELECT query_id, cast(n AS INT) AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op7_chat_format": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            cast(3 + sum(CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 22 + {_ESCAPED('role')} END + {_ESCAPED('text')}) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        s AS (SELECT item_id, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0),
        k AS (SELECT DISTINCT cast(item_id AS VARCHAR) AS item_id, n, array_to_string(w[p:p + n - 1], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM s) t),
        x AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS run FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM s) m WHERE len(w) >= n) t),
        h AS (SELECT doc_id, p, x.n, item_id FROM x JOIN k USING (n, run)),
        c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) t GROUP BY doc_id),
        e AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) t GROUP BY doc_id)
        SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN e USING (doc_id)""",
    "op9_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
        l AS (SELECT *, len(regexp_extract_all(line, '\S+')) AS w FROM (SELECT doc_id, a, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM d) t),
        s AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS total FROM l),
        f AS (SELECT x.doc_id, x.a, x.pos AS b, min(y.pos) AS e FROM s AS x JOIN s AS y ON y.doc_id = x.doc_id AND y.pos >= x.pos AND y.total - x.total + x.w >= 50 GROUP BY 1, 2, 3),
        g AS (SELECT y.doc_id, y.a, max(x.pos) AS b, y.pos AS e FROM s AS x JOIN s AS y ON y.doc_id = x.doc_id AND y.pos >= x.pos AND y.total - x.total + x.w >= 50 GROUP BY 1, 2, 4),
        r AS (SELECT DISTINCT doc_id, b, e, array_to_string(a[b:e], chr(10)) AS run FROM (SELECT * FROM f UNION ALL SELECT * FROM g) t),
        o AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, b) AS nth FROM r),
        z AS (SELECT DISTINCT doc_id, unnest(range(b, e + 1)) AS pos FROM o WHERE nth > 1),
        k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) FILTER (z.pos IS NULL) AS kept, count(z.pos) AS n_removed, count(*) AS n_lines FROM l LEFT JOIN z ON z.doc_id = l.doc_id AND z.pos = l.pos GROUP BY 1)
        SELECT documents.doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed FROM documents LEFT JOIN k USING (doc_id)""",
}
