"""The registered queries in DuckDB's SQL, over views of the same names as the Parquet tables."""

from __future__ import annotations

import unicodedata

CJK = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}"
WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
NOW = "TIMESTAMP '2026-04-21 00:00:00'"


def _kept() -> tuple[str, str]:
    """Characters that compatibility normalisation makes another single one: blanks, letter-like signs, radicals, full and half width."""
    ranges = ((0xA0, 0xA0), (0x2000, 0x200A), (0x2010, 0x2015), (0x202F, 0x202F), (0x205F, 0x205F), (0x2100, 0x214F), (0x2F00, 0x2FD5), (0x3000, 0x3000), (0xFF01, 0xFFEE))
    found = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for lo, hi in ranges for c in range(lo, hi + 1)]
    found = [(a, b) for a, b in found if a != b and len(b) == 1]
    return "".join(a for a, _ in found), "".join(b for _, b in found).replace("'", "''")


def nfkc(t: str) -> str:
    """What NFKC does to the characters of the tables: DuckDB has the canonical composition only."""
    x = f"translate({t}, '{_kept()[0]}', '{_kept()[1]}')"
    for c in map(chr, range(0xFB00, 0xFB07)):
        x = f"replace({x}, '{c}', '{unicodedata.normalize('NFKC', c)}')"
    return f"nfc_normalize({x})"


def norm(t: str) -> str:
    x = f"lower({nfkc(f"coalesce({t}, '')")})"
    x = f"regexp_replace({x}, '([a-z0-9])([{CJK}])', '\\1 \\2', 'g')"
    x = f"regexp_replace({x}, '([{CJK}])([a-z0-9])', '\\1 \\2', 'g')"
    x = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def collapse(t: str) -> str:
    return f"trim(regexp_replace(coalesce({t}, ''), '{WS}', ' ', 'g'))"


URL = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"


def cleaned(u: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({u}, ''), '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '')"


def host(u: str) -> str:
    return f"replace(lower(regexp_extract({cleaned(u)}, '{URL}', 1)), 'www.', '')"


def nurl(u: str) -> str:
    path = f"regexp_replace(regexp_extract({cleaned(u)}, '{URL}', 2), ';[^/]*$', '')"
    return f"{host(u)} || regexp_replace({path}, '/+$', '')"


def tracking(u: str) -> str:
    q = f"regexp_extract(coalesce({u}, ''), '^[^?#]*\\?([^#]*)', 1)"
    return f"len(list_filter(string_split({q}, '&'), lambda p: regexp_matches(lower(trim(split_part(p, '=', 1))), '^(utm_|spm|scm|mc_|ref|refer|aff|share|tk)')))"


def bigrams(s: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({s}), 1)), lambda k: substring({s}, k, 2)))"


PRIO = "greatest(1, least(10, coalesce(s.priority, 3)))"
NO_COUNTS = "NULL::BIGINT AS likes, NULL::BIGINT AS retweets, NULL::BIGINT AS reply_count"
ARTS = f"""plain AS (
  SELECT 10000000000000 + article_id AS article_ix, 'rss' AS source_type, a.source_id, a.source_name, {PRIO} AS source_priority, a.topic, title, link,
    NULL::VARCHAR AS reddit_url, NULL::VARCHAR AS external_url, date, summary, NULL::VARCHAR AS snippet, NULL::BIGINT AS score, NULL::BIGINT AS num_comments, {NO_COUNTS}
  FROM rss_articles a LEFT JOIN feed_sources s ON a.source_id = s.source_id
  UNION ALL SELECT 20000000000000 + article_id, 'twitter', a.source_id, a.source_name, {PRIO}, a.topic, title, link, NULL, NULL, date, NULL, NULL, NULL, NULL,
    metrics.like_count, metrics.retweet_count, metrics.reply_count FROM twitter_articles a LEFT JOIN feed_sources s ON a.source_id = s.source_id
  UNION ALL SELECT 30000000000000 + article_id, 'google', NULL, NULL, 3, topic, title, link, NULL, NULL, date, NULL, snippet, NULL, NULL, NULL, NULL, NULL FROM web_articles
  UNION ALL SELECT 110000000000000 + article_id, 'reddit', a.source_id, a.source_name, {PRIO}, a.topic, title, link, reddit_url, external_url, date, NULL, NULL, a.score, a.num_comments, NULL, NULL, NULL
  FROM reddit_articles a LEFT JOIN reddit_subreddits s ON a.source_id = s.source_id)"""
FEATS = f"""{ARTS}, n1 AS (SELECT *, {norm('title')} AS norm_title FROM plain),
n2 AS (SELECT *, replace(norm_title, ' ', '') AS compact_title, {nurl('link')} AS norm_url, {host('link')} AS domain FROM n1),
feats AS (SELECT *, list_distinct(list_filter(string_split(norm_title, ' '), lambda t: length(t) >= 2)) AS word_tokens,
  {bigrams(f"regexp_replace(compact_title, '[^{CJK}]', '', 'g')")} AS cjk_bigrams, {bigrams('compact_title')} AS compact_bigrams FROM n2)"""


def block(tokens: str, least: int) -> str:
    return f"""SELECT a.ix AS i, b.ix AS j FROM {tokens} a JOIN {tokens} b ON a.token = b.token AND a.ix < b.ix
      GROUP BY 1, 2 HAVING count(*) >= {least}"""


def star(key: str) -> str:
    return f"SELECT m AS i, article_ix AS j FROM (SELECT article_ix, min(article_ix) OVER (PARTITION BY {key}) AS m FROM feats WHERE {key} <> '') WHERE m <> article_ix"


EXACT = " UNION ".join(star(k) for k in ("norm_url", "norm_title", "compact_title"))
PAIRS = f"""{FEATS},
w0 AS (SELECT article_ix AS ix, unnest(word_tokens) AS token FROM feats), w AS (SELECT * FROM w0 WHERE token IN (SELECT token FROM w0 GROUP BY 1 HAVING count(*) BETWEEN 2 AND 128)),
c0 AS (SELECT article_ix AS ix, unnest(cjk_bigrams) AS token FROM feats), c AS (SELECT * FROM c0 WHERE token IN (SELECT token FROM c0 GROUP BY 1 HAVING count(*) BETWEEN 2 AND 128)),
pairs AS ({block('w', 2)} UNION {block('c', 3)} UNION {EXACT}),
x AS (SELECT i, j, a.word_tokens aw, b.word_tokens bw, a.cjk_bigrams ac, b.cjk_bigrams bc, a.compact_bigrams ag, b.compact_bigrams bg, a.norm_title an, b.norm_title bn,
  a.compact_title acp, b.compact_title bcp, a.norm_url au, b.norm_url bu, a.domain ad, b.domain bd FROM pairs JOIN feats a ON i = a.article_ix JOIN feats b ON j = b.article_ix)"""
HINT = "CASE WHEN (an <> '' AND an = bn) OR (acp <> '' AND acp = bcp) OR (au <> '' AND au = bu) THEN 1.0::DOUBLE END"
INTER = lambda a, b: f"len(list_intersect({a}, {b}))"
ALL_A, ALL_B = "list_distinct(list_concat(aw, ac, ag))", "list_distinct(list_concat(bw, bc, bg))"
JAC = f"CASE WHEN len({ALL_A}) = 0 OR len({ALL_B}) = 0 THEN 0.0::DOUBLE ELSE {INTER(ALL_A, ALL_B)} / (len({ALL_A}) + len({ALL_B}) - {INTER(ALL_A, ALL_B)})::DOUBLE END"
URL_HINT = """CASE WHEN au <> '' AND au = bu THEN 1.0::DOUBLE WHEN acp <> '' AND bcp <> '' AND ((contains(bcp, acp) AND length(acp) / length(bcp)::DOUBLE >= 0.7)
  OR (contains(acp, bcp) AND length(bcp) / length(acp)::DOUBLE >= 0.7)) THEN 1.0 WHEN ad <> '' AND ad = bd THEN 0.4 ELSE 0.0 END"""
COMPONENTS = f"""e AS (SELECT i AS u, j AS v FROM ({EXACT}) UNION SELECT j, i FROM ({EXACT})),
r(u, v) AS (SELECT u, u FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
comp AS (SELECT u AS vertex, min(v) AS component FROM r GROUP BY u)"""
REDDIT_TIER = "CASE " + " ".join(f"WHEN coalesce(score, 0) >= {s} OR coalesce(num_comments, 0) >= {c} THEN {v}" for v, s, c in ((5, 1000, 300), (3, 500, 150), (2, 200, 80), (1, 100, 30))) + " ELSE 0 END"
TWITTER_MARKS = ((5, 1000, 500, 300), (3, 500, 200, 150), (2, 100, 50, 60), (1, 50, 20, 20))


def twitter_tier(likes: str, retweets: str, replies: str) -> str:
    return "CASE " + " ".join(f"WHEN coalesce({likes}, 0) >= {a} OR coalesce({retweets}, 0) >= {b} OR coalesce({replies}, 0) >= {c} THEN {v}" for v, a, b, c in TWITTER_MARKS) + " ELSE 0 END"


EXTRA = f"CASE WHEN source_type = 'reddit' THEN {REDDIT_TIER} WHEN source_type = 'twitter' THEN {twitter_tier('likes', 'retweets', 'reply_count')} ELSE 0 END"
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
AGE = f"(epoch_us({NOW}) - epoch_us(CASE WHEN regexp_matches(date, '{ISO}') THEN try_cast(date AS TIMESTAMPTZ) END)) / 3.6e9"
RECENCY = f"CASE WHEN {AGE} < 6 THEN 1.5::DOUBLE WHEN {AGE} < 24 THEN 1.0 ELSE 0.0 END"
RANKED = f"""b AS (SELECT *, source_priority::DOUBLE AS base_score, ({EXTRA})::DOUBLE AS extra_score FROM feats),
pos AS (SELECT *, row_number() OVER (PARTITION BY source_type ORDER BY -(base_score + extra_score), coalesce(title, ''), article_ix) AS position, count(*) OVER (PARTITION BY source_type) AS total FROM b),
ranked AS (SELECT *, round_even(CASE WHEN total = 1 THEN 3.0 ELSE 3.0 * (1.0 - (position - 1) / (total - 1)::DOUBLE) END::DOUBLE, 3) AS rank_score FROM pos)"""
SCORED = f"""{FEATS}, {RANKED}, {COMPONENTS},
kinds AS (SELECT component, count(DISTINCT source_type) AS kinds FROM comp JOIN feats ON vertex = article_ix GROUP BY 1),
scored AS (SELECT ranked.*, coalesce(comp.component, article_ix) AS component,
  round_even(base_score + rank_score + CASE WHEN kinds IS NULL THEN 0.0 ELSE least(6.0, 2.0 * (kinds - 1)) END + {RECENCY}, 3) AS final_score,
  CASE WHEN trim(coalesce(topic, '')) = '' THEN 'uncategorized' ELSE trim(topic) END AS c_topic FROM ranked LEFT JOIN comp ON vertex = article_ix LEFT JOIN kinds ON kinds.component = comp.component)"""
CANON = f"""{SCORED},
heads AS (SELECT component, count(*) AS cluster_size, count(DISTINCT source_type) > 1 AS multi_source, min(article_ix) AS first_ix FROM scored GROUP BY 1),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY component ORDER BY final_score DESC, extra_score DESC, coalesce(title, '') DESC, article_ix) = 1),
per AS (SELECT component, c_topic, sum(final_score) AS s FROM scored GROUP BY 1, 2),
tops AS (SELECT component, c_topic AS primary_topic, count(*) OVER (PARTITION BY component) AS topics FROM per QUALIFY row_number() OVER (PARTITION BY component ORDER BY s DESC, c_topic DESC) = 1),
canon AS (SELECT best.*, cluster_size, multi_source, first_ix, primary_topic, topics FROM best JOIN heads USING (component) JOIN tops USING (component)),
ord AS (SELECT source_type, row_number() OVER (ORDER BY min(-final_score), arg_min(first_ix, (-final_score, first_ix))) - 1 AS source_order FROM canon GROUP BY 1),
co AS (SELECT canon.*, source_order FROM canon JOIN ord USING (source_type))"""
TOP = f"""{CANON},
t1 AS (SELECT *, row_number() OVER (PARTITION BY primary_topic, source_type ORDER BY final_score DESC, first_ix) AS turn FROM co),
t2 AS (SELECT *, row_number() OVER (PARTITION BY primary_topic ORDER BY turn, source_order) AS selection_order FROM t1 WHERE turn <= 5),
t3 AS (SELECT *, row_number() OVER (PARTITION BY primary_topic ORDER BY final_score DESC, source_order, coalesce(title, ''), first_ix) AS rank FROM t2 WHERE selection_order <= 5)"""
MATCHES = f"""{FEATS}, ex AS (SELECT DISTINCT i, j FROM ({EXACT})), bi AS (SELECT i AS article_ix, j AS other FROM ex UNION ALL SELECT j, i FROM ex),
met AS (SELECT bi.article_ix, other, b.source_type, coalesce(b.source_name, '') AS source_name, coalesce(b.topic, '') AS topic, coalesce(nullif(b.link, ''), nullif(b.reddit_url, ''), nullif(b.external_url, ''), '') AS link, b.title
  FROM bi JOIN feats a ON bi.article_ix = a.article_ix JOIN feats b ON other = b.article_ix WHERE a.source_type <> b.source_type),
am0 AS (SELECT article_ix, source_type, coalesce(nullif(title, ''), link) AS title, link, arg_min((source_name, topic), other) AS m FROM met GROUP BY 1, 2, 3, 4),
am AS (SELECT article_ix, source_type, m[1] AS source_name, m[2] AS topic, title, link, 1.0::DOUBLE AS similarity FROM am0)"""
TRACES = """tr AS (SELECT event_id AS trace_id, ts, 'step' || (user_id % 11) AS step_key, ts::DATE AS run_date, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_type = 'error' THEN 'failed for user ' || user_id END AS error, value / 10 AS active_s, value / 10 + (props->>'$.k')::DOUBLE / 100 AS total_s FROM events)"""
RUNS = f"""{TRACES}, runs AS (SELECT step_key, run_date, count(*) AS calls_total, count(*) FILTER (status = 'ok') AS calls_ok, count(*) FILTER (status <> 'ok') AS calls_failed,
  count(*) FILTER (status = 'ok') AS items, CASE WHEN count(*) FILTER (status = 'ok') <= 0 THEN 'error' WHEN count(*) FILTER (status = 'ok') < count(*) THEN 'partial' ELSE 'ok' END AS status,
  round_even(least(sum(active_s), sum(total_s)), 3) AS elapsed_s FROM tr GROUP BY 1, 2)"""


HISTORY = f"""{RUNS}, d AS (SELECT *, CASE WHEN status = 'error' THEN 'error' WHEN calls_failed > 0 THEN 'warn' ELSE 'ok' END AS state FROM runs WHERE run_date > DATE '2024-01-24'),
  g AS (SELECT step_key, count(*) AS checks, count(*) FILTER (state = 'ok') AS ok, count(*) FILTER (state = 'warn') AS warn, count(*) FILTER (state = 'error') AS error,
    round_even(median(elapsed_s), 3) AS median_elapsed_s, max(epoch(run_date::TIMESTAMP)::BIGINT) FILTER (state <> 'ok') AS latest_issue FROM d GROUP BY 1),
  hist AS (SELECT *, round_even((warn + error) / checks::DOUBLE, 4) AS degraded_rate, checks >= 2 AND round_even((warn + error) / checks::DOUBLE, 4) > 0.5 AS unhealthy FROM g)"""


def release_summary(t: str) -> str:
    x = f"coalesce({t}, '')"
    for pattern, kept in ((r"\[([^\]]+)\]\([^)]+\)", r"\1"), (r"\*+([^*]+)\*+", r"\1"), (f"(?m)^#+{WS[:-1]}*", ""), ("```[^`]*```", ""), ("`([^`]+)`", r"\1")):
        x = f"regexp_replace({x}, '{pattern}', '{kept}', 'g')"
    return collapse(x)


#: From m(*, v): summary, cut at 500 characters or at the last blank before, if it stands after 400.
CUT = """cut1 AS (SELECT *, v[:500] AS head, CASE WHEN contains(v[:500], ' ') THEN length(v[:500]) - instr(reverse(v[:500]), ' ') ELSE -1 END AS space FROM m),
    cut2 AS (SELECT *, CASE WHEN length(v) <= 500 THEN v ELSE CASE WHEN space > 400 THEN substring(head, 1, space) ELSE head END || '...' END AS summary FROM cut1)"""


def _quantiles() -> str:
    out = []
    for side in ("active", "total"):
        c = f"{side}_s"
        out += [f"round_even(avg({c}), 3) AS {side}_avg, round_even(min({c}), 3) AS {side}_min, round_even(max({c}), 3) AS {side}_max"]
        out += [f"round_even(quantile_cont({c}, {q}), 3) AS {side}_p{int(q * 100)}" for q in (0.5, 0.9, 0.95)]
    return ", ".join(out)


def oracle_sql() -> dict[str, str]:
    noise = f"""{ARTS}, t AS (SELECT *, {collapse('title')} AS n_title, trim(concat_ws(' ', nullif({collapse('title')}, ''), nullif({collapse("coalesce(nullif(summary, ''), snippet)")}, ''))) AS n_text,
      coalesce(nullif(link, ''), nullif(external_url, ''), nullif(reddit_url, ''), '') AS n_link FROM plain),
    s AS (SELECT article_ix, source_type, regexp_matches(n_text, '(?i)https?://\\S+') AS embedded_url_text,
      {host('n_link')} <> '' AND len(list_filter(list_transform(regexp_extract_all(n_text, '(?i)https?://\\S+'), lambda d: {host('d')}), lambda d: d <> '' AND d <> {host('n_link')})) > 0 AS embedded_external_redirect,
      {tracking('n_link')} >= 1 AS tracking_url,
      len(regexp_extract_all(n_text, '(?i)\\b\\d+\\s*(?:posts?|participants?|comments?|replies?)\\b|\\d+\\s*(?:个帖子|位参与者|条评论|条回复|人参与)')) >= 2 AS engagement_chrome,
      regexp_matches(n_text, '(?i)(?:[¥￥$€£]\\s*\\d)|(?:\\d+\\s*(?:折|off))') AS promotion_shape,
      len(list_filter(string_split({norm('n_title')}, ' '), lambda t: length(t) >= 2)) <= 4 AND length(n_title) <= 48 AS short_low_information_title FROM t),
    z AS (SELECT *, 1.5::DOUBLE * (embedded_url_text::INT + embedded_external_redirect::INT + tracking_url::INT + promotion_shape::INT) + engagement_chrome::INT + short_low_information_title::INT AS noise_score FROM s),
    y AS (SELECT *, noise_score >= 4.0 AND ((engagement_chrome AND (embedded_url_text OR embedded_external_redirect)) OR (tracking_url AND promotion_shape)
      OR (promotion_shape AND short_low_information_title AND (embedded_url_text OR embedded_external_redirect OR tracking_url))) AS is_noise FROM z)"""
    stressed = noise.replace("plain AS (", "plain0 AS (", 1).replace("""), t AS (SELECT""", """), plain AS (SELECT * REPLACE (
      CASE WHEN article_ix % 4 = 0 THEN title ELSE '5折 ' || substring(title, 1, 20) END AS title,
      CASE WHEN article_ix % 4 <= 1 THEN summary ELSE coalesce(summary, '') || ' https://shop.example/x 12 comments' || CASE WHEN article_ix % 4 = 3 THEN ' 7 posts' ELSE '' END END AS summary) FROM plain0), t AS (SELECT""", 1)
    signals = "embedded_url_text, embedded_external_redirect, tracking_url, engagement_chrome, promotion_shape, short_low_information_title"
    primary = "coalesce(nullif(link, ''), nullif(reddit_url, ''), nullif(external_url, ''), '')"
    shown = f"coalesce(nullif(title, ''), {primary})"
    title_key = f"lower({collapse('title')})"
    link_key = f"regexp_replace(lower(trim({primary})), '/+$', '')"
    score_text = "format('{:.1f}', round_even(final_score, 1))"
    metrics = "concat_ws(', ', CASE WHEN coalesce(likes, 0) <> 0 THEN 'likes=' || likes END, CASE WHEN coalesce(num_comments, 0) <> 0 THEN 'comments=' || num_comments END, CASE WHEN coalesce(reply_count, 0) <> 0 THEN 'replies=' || reply_count END, CASE WHEN coalesce(retweets, 0) <> 0 THEN 'retweets=' || retweets END, CASE WHEN coalesce(score, 0) <> 0 THEN 'score=' || score END)"
    summary = collapse("coalesce(nullif(snippet, ''), nullif(summary, ''), '')")
    item_line = f"""rank || '. ⭐' || {score_text} || ' | ' || {shown} || CASE WHEN {summary} <> '' THEN ' - ' || {summary} ELSE '' END
          || ' | *' || concat_ws(' - ', nullif(source_type, ''), nullif(coalesce(source_name, ''), '')) || '*' || CASE WHEN {metrics} <> '' THEN ' | *' || {metrics} || '*' ELSE '' END"""
    return {
        "union_registry": f"""SELECT 10000000000000 + article_id AS article_ix, 'rss' AS source_type, {PRIO} AS source_priority, title FROM rss_articles a LEFT JOIN feed_sources s ON a.source_id = s.source_id
          UNION ALL SELECT 20000000000000 + article_id, 'twitter', {PRIO}, title FROM twitter_articles a LEFT JOIN feed_sources s ON a.source_id = s.source_id
          UNION ALL SELECT 30000000000000 + article_id, 'google', 3, title FROM web_articles
          UNION ALL SELECT 110000000000000 + article_id, 'reddit', {PRIO}, title FROM reddit_articles a LEFT JOIN reddit_subreddits s ON a.source_id = s.source_id""",
        "norm_title": f"WITH {FEATS} SELECT article_ix, norm_title, compact_title FROM feats",
        "norm_url": f"WITH {FEATS} SELECT article_ix, norm_url, domain, {tracking('link')} AS tracking FROM feats",
        "noise_signals": f"WITH {noise} SELECT article_ix, {signals}, noise_score, is_noise FROM y",
        "noise_stressed": f"WITH {stressed} SELECT article_ix, {signals}, noise_score, is_noise FROM y",
        "noise_removed": f"WITH {noise} SELECT source_type, count(*) AS total, count(*) FILTER (is_noise) AS removed FROM y GROUP BY 1",
        "word_tokens": f"WITH {FEATS} SELECT article_ix, len(word_tokens) AS n, array_to_string(list_sort(word_tokens), ' ') AS words FROM feats",
        "bigram_sets": f"WITH {FEATS} SELECT article_ix, coalesce(array_to_string(list_sort(cjk_bigrams), ' '), '') AS cjk, coalesce(array_to_string(list_sort(compact_bigrams), ' '), '') AS compact FROM feats",
        "history_anti_join": f"""WITH {ARTS}, h AS (SELECT *, article_ix // 10000000000000 = 1 AND article_ix - 10000000000000 IN (SELECT article_id FROM rss_articles WHERE batch_no = 0) AS old, {norm('title')} AS ht, {norm(shown)} AS kt, {nurl(primary)} AS kl FROM plain)
          SELECT article_ix, title, link FROM h WHERE NOT old AND (kt = '' OR kt NOT IN (SELECT ht FROM h WHERE old)) AND (kl = '' OR kl NOT IN (SELECT {nurl('link')} FROM h WHERE old))""",
        "same_day_seen": f"""WITH {ARTS}, h AS (SELECT *, article_ix // 10000000000000 = 1 AND article_ix - 10000000000000 IN (SELECT article_id FROM rss_articles WHERE batch_no = 0) AS old, {title_key} AS kt, {link_key} AS kl FROM plain)
          SELECT article_ix, title, link FROM h WHERE NOT old AND (kt = '' OR kt NOT IN (SELECT kt FROM h WHERE old)) AND (kl = '' OR kl NOT IN (SELECT kl FROM h WHERE old))""",
        "candidate_pairs": f"WITH {PAIRS} SELECT i, j FROM pairs",
        "pair_jaccard": f"WITH {PAIRS} SELECT i, j, round_even({JAC}, 6) AS jaccard, {INTER('aw', 'bw')} AS words, {URL_HINT} AS url FROM x",
        "comparable_pairs": f"WITH {PAIRS} SELECT i, j, {HINT} AS hint FROM x WHERE {HINT} IS NOT NULL OR {INTER('aw', 'bw')} >= 2 OR {INTER('ac', 'bc')} >= 3 OR {INTER('ag', 'bg')} >= 4",
        "exact_components": f"WITH RECURSIVE {FEATS}, {COMPONENTS} SELECT vertex, component FROM comp",
        "hot_scores": f"""WITH RECURSIVE {FEATS}, {COMPONENTS}, k AS (SELECT component, count(DISTINCT source_type) AS kinds FROM comp JOIN feats ON vertex = article_ix GROUP BY 1)
          SELECT vertex AS article_ix, least(6.0, 2.0 * (kinds - 1))::DOUBLE AS hot_score FROM comp JOIN k USING (component)""",
        "engagement_tiers": f"""SELECT 10000000000000 + article_id AS article_ix, 0::BIGINT AS extra_score FROM rss_articles UNION ALL SELECT 30000000000000 + article_id, 0 FROM web_articles
          UNION ALL SELECT 20000000000000 + article_id, {twitter_tier('metrics.like_count', 'metrics.retweet_count', 'metrics.reply_count')} FROM twitter_articles UNION ALL SELECT 110000000000000 + article_id, {REDDIT_TIER} FROM reddit_articles""",
        "recency": f"WITH {ARTS} SELECT article_ix, {RECENCY} AS recency_score FROM plain",
        "fetch_rank": f"WITH {FEATS}, {RANKED} SELECT article_ix, base_score, extra_score, rank_score FROM ranked",
        "grouped_ranking": f"WITH {FEATS}, {RANKED} SELECT article_ix, source_type, position FROM ranked",
        "final_score": f"WITH RECURSIVE {SCORED} SELECT article_ix, component, final_score FROM scored",
        "canonical_pick": f"WITH RECURSIVE {CANON} SELECT article_ix, cluster_size, multi_source, first_ix, final_score FROM canon",
        "cluster_topic": f"WITH RECURSIVE {CANON} SELECT article_ix, primary_topic, topics FROM canon",
        "topic_order": f"""WITH RECURSIVE {CANON}, g AS (SELECT primary_topic, count(*) AS available, min((-final_score, source_order, coalesce(title, ''))) AS b FROM co GROUP BY 1)
          SELECT primary_topic, available, row_number() OVER (ORDER BY b, primary_topic) AS topic_rank FROM g""",
        "round_robin_topn": f"WITH RECURSIVE {TOP} SELECT primary_topic AS topic, article_ix, selection_order, rank, turn FROM t3",
        "markdown_lines": f"WITH RECURSIVE {TOP} SELECT primary_topic AS topic, rank, {item_line} AS line FROM t3",
        "noise_samples": f"""WITH {stressed.replace('z AS (SELECT *,', 'z AS (SELECT s.*, t.title, t.n_link,', 1).replace(' FROM s)', ' FROM s JOIN t USING (article_ix))', 1)}
          SELECT article_ix, substring({collapse('title')}, 1, 160) AS title, n_link AS link, concat_ws(' ', {", ".join(f"CASE WHEN {x} THEN '{x}' END" for x in signals.split(", "))}) AS signals FROM y WHERE is_noise ORDER BY article_ix LIMIT 5""",
        "topic_counts": f"""WITH RECURSIVE {CANON}, k AS (SELECT primary_topic, {title_key} AS kt, {link_key} AS kl FROM canon), old AS (SELECT {title_key} AS kt, lower(trim(coalesce(link, ''))) AS l FROM rss_articles WHERE batch_no = 1)
          SELECT primary_topic, count(*) AS available, count(*) FILTER ((kt = '' OR kt NOT IN (SELECT kt FROM old)) AND (kl = '' OR kl NOT IN (SELECT regexp_replace(l, '/+$', '') FROM old))) AS remaining FROM k GROUP BY 1""",
        "article_matches": f"WITH {MATCHES} SELECT * FROM am",
        "cluster_matches": f"""WITH RECURSIVE {MATCHES}, {COMPONENTS},
          cm AS (SELECT coalesce(component, article_ix) AS component, source_type, title, link, arg_min((source_name, topic, similarity), article_ix) AS m FROM am LEFT JOIN comp ON article_ix = vertex GROUP BY 1, 2, 3, 4)
          SELECT component, source_type, m[1] AS source_name, m[2] AS topic, title, link, m[3] AS similarity, row_number() OVER (PARTITION BY component ORDER BY m[3] DESC, source_type, title, link) AS match_rank FROM cm""",
        "merged_output": f"""WITH RECURSIVE {CANON} SELECT article_ix, source_type, row_number() OVER (PARTITION BY source_type ORDER BY -final_score, coalesce(title, ''), article_ix) AS position, title, primary_topic, final_score,
          extra_score AS extra, summary IS NOT NULL AS has_summary FROM canon""",
        "hotspot_items": f"""WITH RECURSIVE {TOP}, g AS (SELECT primary_topic, count(*) AS available FROM co GROUP BY 1)
          SELECT primary_topic AS topic, available, rank, {shown} AS title, {primary} AS link, round_even(final_score, 1) AS hotspot_score, source_type, nullif(likes, 0) AS likes, nullif(num_comments, 0) AS comments, selection_order
          FROM t3 JOIN g USING (primary_topic)""",
        "markdown_document": f"""WITH RECURSIVE {TOP}, g AS (SELECT primary_topic, row_number() OVER (ORDER BY min((-final_score, source_order, coalesce(title, ''))), primary_topic) AS topic_rank FROM co GROUP BY 1),
          had AS (SELECT source_type, count(*) AS n FROM co GROUP BY 1), got AS (SELECT source_type, count(*) AS n FROM t3 GROUP BY 1),
          front AS (SELECT 'summary: mode:daily | total_articles:' || (SELECT count(*) FROM t3) || ' | ' || string_agg(had.source_type || '(' || had.n || '→' || coalesce(got.n, 0) || ',fail=0)', ' | ' ORDER BY had.source_type) || ' | generated_at:2026-04-21T00:00:00+00:00' AS line FROM had LEFT JOIN got USING (source_type)),
          lines AS (SELECT 0 AS a, 0 AS b, '---' AS line UNION ALL SELECT 0, 1, line FROM front UNION ALL SELECT 0, 2, '---' UNION ALL SELECT 0, 3, '# 2026-04-21 daily 全球科技与 AI 热点' UNION ALL SELECT 0, 4, ''
            UNION ALL SELECT topic_rank, 0, '## ' || array_to_string(list_transform(string_split(replace(replace(primary_topic, '-', ' '), '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') FROM g
            UNION ALL SELECT topic_rank, rank, {item_line} FROM t3 JOIN g USING (primary_topic)
            UNION ALL SELECT topic_rank, 99, '' FROM g WHERE topic_rank < (SELECT max(topic_rank) FROM g))
          SELECT row_number() OVER (ORDER BY a, b) AS line_no, line FROM lines""",
        "distribution": """SELECT t AS source_type, CASE t WHEN 'rss' THEN (SELECT count(*) FROM rss_articles) WHEN 'twitter' THEN (SELECT count(*) FROM twitter_articles)
          WHEN 'google' THEN (SELECT count(*) FROM web_articles) WHEN 'reddit' THEN (SELECT count(*) FROM reddit_articles) ELSE 0 END AS n
          FROM unnest(['rss', 'twitter', 'google', 'github', 'github_trending', 'api', 'v2ex', 'zhihu', 'weibo', 'toutiao', 'reddit']) u(t)""",
        "timing_summary": f"WITH {TRACES}, tr3 AS (SELECT * REPLACE (round_even(active_s, 3) AS active_s, round_even(total_s, 3) AS total_s) FROM tr) SELECT step_key, count(*) AS requests, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status <> 'ok') AS errors, {_quantiles()} FROM tr3 GROUP BY 1",
        "slow_buckets": f"""WITH {TRACES}, g AS (SELECT step_key, count(*) AS total, count(*) FILTER (active_s >= 3 AND active_s < 5) AS b0, count(*) FILTER (active_s >= 5) AS b1 FROM tr GROUP BY 1)
          SELECT step_key, total, '3.0-5.0' AS bucket, b0 AS n, round_even(b0 / total::DOUBLE, 4) AS rate FROM g UNION ALL SELECT step_key, total, '5.0+', b1, round_even(b1 / total::DOUBLE, 4) FROM g""",
        "failed_items": f"WITH {TRACES} SELECT trace_id, step_key, error, round_even(active_s, 3) AS active_s FROM tr WHERE status <> 'ok'",
        "step_runs": f"WITH {RUNS} SELECT * FROM runs",
        "pipeline_status": f"""WITH {RUNS} SELECT run_date, count(*) AS steps, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'skipped') AS skipped,
          count(*) FILTER (status = 'error') AS error, count(*) FILTER (status <> 'ok') AS non_ok,
          CASE WHEN count(*) = count(*) FILTER (status = 'ok') THEN 'ok' WHEN count(*) FILTER (status <> 'error') > 0 THEN 'partial' ELSE 'error' END AS status FROM runs GROUP BY 1""",
        "health_history": f"WITH {HISTORY} SELECT * FROM hist",
        "overlay_merge": """WITH b AS (SELECT source_id, source_name, topic, priority FROM feed_sources),
          o AS (SELECT source_id, source_name, NULL AS topic, 5 AS priority FROM reddit_subreddits UNION ALL SELECT source_id, NULL, 'pinned', NULL FROM feed_sources WHERE priority >= 8)
          SELECT coalesce(b.source_id, o.source_id) AS source_id, coalesce(o.source_name, b.source_name) AS source_name, coalesce(o.topic, b.topic) AS topic, coalesce(o.priority, b.priority)::BIGINT AS priority
          FROM b FULL OUTER JOIN o ON b.source_id = o.source_id""",
        "topic_labels": """WITH r AS (SELECT topic, count(*) AS n FROM rss_articles WHERE topic IS NOT NULL GROUP BY 1)
          SELECT r.topic, n, CASE WHEN queries_ok >= 4 THEN topic_id ELSE array_to_string(list_transform(string_split(replace(replace(r.topic, '-', ' '), '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS topic_title
          FROM r LEFT JOIN web_topics t ON r.topic = t.topic_id""",
        "config_violations": """SELECT source_id, 'source_id is empty' AS rule FROM reddit_subreddits WHERE trim(coalesce(source_id, '')) = ''
          UNION ALL SELECT source_id, 'source_name is empty' FROM reddit_subreddits WHERE trim(coalesce(source_name, '')) = ''
          UNION ALL SELECT source_id, 'subreddit is empty' FROM reddit_subreddits WHERE trim(coalesce(subreddit, '')) = ''
          UNION ALL SELECT source_id, 'priority is not in 1..10' FROM reddit_subreddits WHERE NOT coalesce(priority BETWEEN 1 AND 10, false)
          UNION ALL SELECT source_id, 'topic is unknown' FROM reddit_subreddits WHERE topic IS NOT NULL AND topic NOT IN (SELECT topic_id FROM web_topics)
          UNION ALL SELECT source_id, 'id is used twice' FROM reddit_subreddits GROUP BY 1 HAVING count(*) > 1""",
        "first_wins": "SELECT min(article_id) AS article_id, topic, link FROM web_articles WHERE link <> '' GROUP BY topic, link",
        "release_summary": f"""WITH m AS (SELECT doc_id, {release_summary('text')} AS v FROM documents), {CUT} SELECT doc_id, summary FROM cut2""",
        "human_numbers": """SELECT article_id, CASE article_id % 3 WHEN 0 THEN score * 10000 WHEN 1 THEN round(score / 10.0, 1) * 100000000 ELSE score END::BIGINT AS number FROM reddit_articles WHERE score IS NOT NULL""",
        "stars_per_day": """WITH o AS (SELECT o_custkey, count(*) AS stars, min(o_orderdate)::DATE AS created FROM orders GROUP BY 1)
          SELECT o_custkey, stars, round_even(stars / greatest(1, date_diff('day', created, DATE '2000-01-01'))::DOUBLE, 6) AS daily FROM o""",
        "window_cutoff": f"WITH {TRACES} SELECT run_date, count(*) AS n FROM tr WHERE ts >= TIMESTAMP '2024-01-28 00:00:00' GROUP BY 1",
        "search_queries": """SELECT DISTINCT web_query, trim(concat_ws(' ', trim(web_query), '-"press release" -jobs')) AS query FROM web_articles WHERE web_query IS NOT NULL""",
        "top_engaged": """SELECT source_id, article_id, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, article_id) AS rank, score FROM reddit_articles
          WHERE score IS NOT NULL AND source_id IS NOT NULL QUALIFY rank <= 5""",
    }
