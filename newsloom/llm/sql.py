"""Queries of the subpackage in DuckDB's SQL, where SQL can express them on whole tables."""

from __future__ import annotations

W = r"\p{L}\p{N}\p{M}"
TRACK = "^(utm_|spm|scm|mc_|ref|refer|aff|share|tk)"


def words(t: str) -> str:
    return f"trim(regexp_replace(lower(url_decode({t})), '[^{W}]+', ' ', 'g'))"


def address(table: str, columns: str) -> str:
    """CTE addressed(columns, address): null where the link has no words."""
    key, value = "split_part(p, '=', 1)", "regexp_extract(p, '(?s)^[^=]*=(.*)$', 1)"
    name = f"regexp_replace(lower(url_decode({key})), '^[^{W}]+', '')"
    return f"""l1 AS (SELECT {columns}, regexp_replace(regexp_replace(regexp_replace(regexp_replace(link, '&(amp;)+', '&', 'gi'), '^[^{W}]+', ''), '^(?i)[a-z][a-z0-9+.\\-]*://+', ''), '(?s)#.*$', '') AS u FROM {table}),
    l2 AS (SELECT *, regexp_replace(lower(url_decode(regexp_extract(u, '(?s)^([^?]*)', 1))), '^[^{W}]*(?:www\\.)?', '') AS head, regexp_extract(u, '(?s)^[^?]*\\?(.*)$', 1) AS query FROM l1),
    l3 AS (SELECT *, {words("regexp_replace(regexp_extract(head, '(?s)^([^/]*)', 1), ':(80|443)\\s*$', '')")} AS host, {words("regexp_extract(head, '(?s)^[^/]*(/.*)$', 1)")} AS path,
      list_sort(list_filter(list_transform(list_filter(string_split(query, '&'), lambda p: NOT regexp_matches({name}, '{TRACK}')), lambda p: {words(key)} || '=' || {words(value)}), lambda x: x <> '=')) AS params FROM l2),
    addressed AS (SELECT *, CASE WHEN host <> '' OR path <> '' THEN host || '/' || path || '?' || coalesce(array_to_string(params, '&'), '') END AS address FROM l3)"""


def found4(table: str) -> str:
    return f"(WITH {address(table, 'article_id')}, g AS (SELECT article_id, min(article_id) OVER (PARTITION BY address) AS first_id FROM addressed WHERE address IS NOT NULL) SELECT first_id, article_id FROM g WHERE first_id <> article_id)"


def records4(table: str) -> str:
    return f"(WITH {address(table, 'article_id')} SELECT '{table}' AS table_name, min(article_id) AS first_id, address, count(*) AS copies FROM addressed WHERE address IS NOT NULL GROUP BY address)"


REPEATS = rf"""{address("rss_articles", "article_id, batch_no, title")},
    t AS (SELECT article_id AS id, batch_no AS b, list_distinct(regexp_extract_all(regexp_replace(lower(title), '([\x{{3400}}-\x{{4dbf}}\x{{4e00}}-\x{{9fff}}])', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')) AS w FROM rss_articles WHERE title IS NOT NULL),
    e AS (SELECT id, b, len(w) AS n, unnest(w) AS word FROM t),
    alike AS (SELECT x.id AS old_id, y.id AS new_id FROM e x JOIN e y ON x.word = y.word AND y.b > 0 AND (x.b < y.b OR (x.b = y.b AND x.id < y.id))
      GROUP BY x.id, y.id, x.n, y.n HAVING count(*) / (x.n + y.n - count(*))::DOUBLE >= 0.7 - 1e-9),
    same AS (SELECT x.article_id AS old_id, y.article_id AS new_id FROM addressed x JOIN addressed y ON x.address = y.address AND y.batch_no > 0 AND (x.batch_no < y.batch_no OR (x.batch_no = y.batch_no AND x.article_id < y.article_id))),
    found AS (SELECT min(old_id) AS first_id, new_id AS article_id FROM (SELECT * FROM alike UNION ALL SELECT * FROM same) GROUP BY new_id)"""
WINDOWS = """w AS (SELECT doc_id, n_chars, k, hash(substring(text, k, 200)) AS h FROM (SELECT doc_id, text, length(text) AS n_chars, unnest(range(1, length(text) - 198)) AS k FROM documents WHERE length(text) >= 200)),
    many AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) <> max(doc_id)), s AS (SELECT DISTINCT doc_id, h FROM w WHERE h IN (SELECT h FROM many))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"WITH {REPEATS} SELECT first_id, article_id FROM found",
        "p1_batches": f"WITH {REPEATS} SELECT batch_no, count(*) AS rows, count(first_id) AS repeats FROM rss_articles LEFT JOIN found USING (article_id) GROUP BY 1",
        "p4_found": f"SELECT * FROM {found4('reddit_articles')} UNION ALL SELECT * FROM {found4('web_articles')}",
        "p4_records": f"SELECT * FROM {records4('reddit_articles')} UNION ALL SELECT * FROM {records4('web_articles')}",
        "p9_found": f"WITH {WINDOWS} SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id",
        "p9_coverage": f"""WITH {WINDOWS}, m AS (SELECT doc_id, k FROM w WHERE h IN (SELECT h FROM many)),
          g AS (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM m),
          c AS (SELECT doc_id, sum(least(200, coalesce(k - before, 200))) AS shared_chars, count(*) FILTER (before IS NULL OR k > before + 200) AS spans FROM g GROUP BY 1)
          SELECT d.doc_id, coalesce(length(text), 0) AS chars, coalesce(shared_chars, 0)::BIGINT AS shared_chars, coalesce(spans, 0) AS spans FROM documents d LEFT JOIN c USING (doc_id)""",
    }
