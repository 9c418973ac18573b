"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_ORACLE: dict[str, str] = {
    "op7_url_filter": r"""
        WITH a AS (
            SELECT page_id,
                   lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ),
        given(rule_host, rule_path, decision) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ),
        own(name, words) AS (
            VALUES ('cheap-pills', 'cheap[-_]pills'), ('spam-farm', 'spam[-_]farm'), ('adult-x', 'adult[-_]x'),
                   ('xxx', 'xxx'), ('porn', 'porn'), ('casino', 'casino'), ('free-slots', 'free[-_]slots'),
                   ('link-farm', 'link[-_]farm'), ('payday-loans', 'payday[-_]loans')
        ),
        judged AS (
            SELECT a.*,
                   (SELECT max_by(struct_pack(r := rule_host || rule_path, v := decision),
                                  length(rule_host || rule_path))
                    FROM given
                    WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
                      AND starts_with(path, rule_path)) AS best,
                   least(
                       (SELECT min(name) FROM own
                        WHERE regexp_matches(host, '(^|[^a-z0-9])' || words || '([^a-z0-9]|$)')),
                       CASE WHEN regexp_matches(path, '/[^/]*;jsessionid=') THEN 'session-id' END,
                       CASE WHEN regexp_matches(path, '/[^/]*\.exe$') THEN 'program-file' END
                   ) AS pattern_rule
            FROM a
        )
        SELECT page_id, host, path, best.r AS rule,
               coalesce(best.v, CASE WHEN pattern_rule IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
               pattern_rule
        FROM judged
    """,
    "op8_exact_dedup": """
        WITH cut AS (SELECT (min(doc_id) + max(doc_id)) // 2 AS last_old FROM documents),
        d AS (
            SELECT doc_id, coalesce(text, '') AS t, doc_id <= last_old AS old
            FROM documents, cut
        )
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(t) AS text_sha256,
               bool_or(old) OVER same AS in_history
        FROM d
        WINDOW same AS (PARTITION BY t)
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
                   strlen(coalesce(html, '')) AS payload_bytes
            FROM pages
        ),
        g AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
        FROM g
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
