"""DuckDB SQL for every registered query with an exact oracle.

Each statement is self-contained: the review views are inlined as CTEs over
the pre-registered tables.  Expressions are spelled out from the same fixed
values the Spark operators use.
"""

from __future__ import annotations

from feedlens.functions.lexicon import FALLBACK_THEME, FALLBACK_THEME_ID, NO_ANSWER, QUESTIONS
from feedlens.functions.text import EMAIL_PATTERN, PHONE_PATTERN
from feedlens.operators.reports import FALLBACK_ACTIONS
from feedlens.operators.prompts import INSTRUCTIONS
from feedlens.plans.params import (CONTEXT_CHARS, CUT_REPLY, FEED_PAGE_SIZE, FENCED_REPLY, NEWEST_N, PACK_SIZE,
                                   QUESTION_TERMS, QUOTE_K, REFUSAL, REFUSED_REPLY, REPLY_CYCLE, RESAMPLE_RATE,
                                   RESAMPLE_SEED, SEARCH_PATTERN, STRAY_EVERY, THEME_NAMES, THEME_TERMS, TOP_K, WEEKS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EMAIL = q(EMAIL_PATTERN)
PHONE = q(PHONE_PATTERN)


def mask(x: str) -> str:
    return (f"coalesce(regexp_replace(regexp_replace({x}, {EMAIL}, '[EMAIL]', 'g'), "
            f"{PHONE}, '[PHONE]', 'g'), '')")


ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"

REVIEWS = """reviews AS (
  SELECT d.doc_id AS review_id,
    CASE e.event_type WHEN 'click' THEN 'playstore' WHEN 'view' THEN 'appstore'
         WHEN 'purchase' THEN 'reddit' WHEN 'signup' THEN 'linkedin' ELSE 'twitter' END AS source,
    CASE WHEN e.event_type IN ('click','view')
         THEN CAST(1 + CAST(floor(abs(e.value)) AS BIGINT) % 5 AS INT) END AS rating,
    CASE WHEN e.event_type <> 'error' THEN substr(d.text, 1, 40) END AS title,
    d.text AS text, e.ts AS date
  FROM documents d JOIN events e ON e.event_id = d.doc_id * 5)"""

ASOF = "(SELECT max(date) FROM reviews)"
START = f"({ASOF} - INTERVAL {WEEKS} WEEK)"

CLEAN = f"""clean AS (
  SELECT review_id, coalesce(source, 'unknown') AS source, rating,
         CASE WHEN length(title) > 0 THEN {mask('title')} END AS title,
         {mask('text')} AS text, date
  FROM reviews)"""


def _terms_list(terms) -> str:
    return "[" + ", ".join(q(t) for t in sorted(set(terms))) + "]"


def _score(lexicon: dict, key: str) -> str:
    return f"len(list_intersect(toks, {_terms_list(lexicon[key])}))"


_TOKS = "list_distinct(string_split_regex(lower(text), '[^a-z]+'))"


def _theme_case(lexicon: dict = THEME_TERMS) -> str:
    keys = sorted(lexicon)
    cands = ", ".join(f"{{'neg': -{_score(lexicon, k)}, 'key': {q(k)}}}" for k in keys)
    return f"list_min([{cands}])"


def _name_case(col: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v[0])}" for k, v in sorted(THEME_NAMES.items()))
    return f"coalesce(CASE {col} {whens} END, {q(FALLBACK_THEME)})"


THEMED = f"""themed0 AS (
  SELECT *, {_theme_case()} AS best,
         greatest({', '.join(_score(THEME_TERMS, k) for k in sorted(THEME_TERMS))}, 0) AS theme_score
  FROM (SELECT *, {_TOKS} AS toks FROM clean)),
themed AS (
  SELECT review_id, source, rating, title, text, date,
         CASE WHEN best.neg < 0 THEN best.key ELSE {q(FALLBACK_THEME_ID)} END AS theme_id,
         theme_score
  FROM themed0),
themed_named AS (
  SELECT *, {_name_case('theme_id')} AS theme FROM themed)"""


def lexicon_values(lexicon: dict, key: str) -> str:
    rows = ", ".join(f"({q(k)}, {q(t)})" for k in sorted(lexicon) for t in lexicon[k])
    return f"(VALUES {rows}) AS lex({key}, term)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_(REVIEWS)
BASE_CLEAN = with_(REVIEWS, CLEAN)
BASE_THEMED = with_(REVIEWS, CLEAN, THEMED)

SQL: dict[str, str] = {}

SQL["mask_pii"] = f"""
SELECT 'documents' AS corpus, doc_id AS id, CAST(0 AS BIGINT) AS part, {mask('text')} AS masked FROM documents
UNION ALL
SELECT 'pages', page_id, CAST(0 AS BIGINT), {mask('html')} FROM pages
UNION ALL
SELECT 'conversations', conv_id, turn, {mask('text')} FROM conversations"""

SQL["clean_reviews"] = BASE_CLEAN + "SELECT * FROM clean"

SQL["pii_marked_rows"] = BASE_CLEAN + """
SELECT review_id, source, text FROM clean
WHERE regexp_matches(text, '\\[EMAIL\\]|\\[PHONE\\]')"""

SQL["pii_incident_counts"] = BASE + f"""
SELECT source, count(*) AS n_rows,
  count(*) FILTER (WHERE {mask('text')} <> coalesce(text, '')) AS masked_rows,
  count(*) FILTER (WHERE regexp_matches({mask('text')}, '\\[EMAIL\\]|\\[PHONE\\]')) AS marked_rows,
  CAST(sum(len(regexp_extract_all(coalesce(text, ''), {EMAIL}))) AS BIGINT) AS email_hits,
  CAST(sum(len(regexp_extract_all(regexp_replace(coalesce(text, ''), {EMAIL}, '[EMAIL]', 'g'), {PHONE})))
       AS BIGINT) AS phone_hits
FROM reviews GROUP BY source"""

SQL["rolling_window_filter"] = BASE + f"SELECT * FROM reviews WHERE date >= {START}"

DUMP = f"""dump AS (
  SELECT review_id, source, rating, title, text,
         CASE WHEN source = 'linkedin' THEN strftime(date, '%B %d, %Y')
              ELSE strftime(date, {ISO}) END AS date_raw,
         CASE WHEN source = 'linkedin' THEN NULL ELSE date END AS date
  FROM reviews)"""

SQL["drop_unparseable_dates"] = with_(REVIEWS, DUMP) + """
SELECT review_id, source, date_raw, date,
       CASE WHEN date IS NULL THEN 'rejected' ELSE 'kept' END AS status
FROM dump"""

SQL["source_window_counts"] = with_(REVIEWS, DUMP) + f"""
SELECT source, count(*) AS seen, count(*) FILTER (WHERE date >= {START}) AS kept,
       count(*) FILTER (WHERE date IS NULL) AS rejected
FROM dump GROUP BY source"""

FEED = f"""feed0 AS (
  SELECT *, review_id % {STRAY_EVERY} = 0 AS stray, row_number() OVER (
    PARTITION BY review_id % {STRAY_EVERY} = 0 ORDER BY date DESC, review_id) AS rn
  FROM reviews WHERE source = 'appstore'),
feed1 AS (SELECT *, CAST(floor((rn - 1) / {FEED_PAGE_SIZE}) AS BIGINT) + 1 AS p FROM feed0),
feed AS (
  SELECT review_id, CASE WHEN stray THEN (SELECT coalesce(max(p), 0) + 1 FROM feed1 WHERE NOT stray) ELSE p END AS page,
         rating, title, text, date
  FROM feed1),
feed_good AS (SELECT DISTINCT page FROM feed WHERE date >= {START}),
feed_stop AS (
  SELECT min(page) AS stop_page FROM (
    SELECT page + 1 AS page FROM feed_good UNION ALL SELECT 1) c
  WHERE page NOT IN (SELECT page FROM feed_good)),
feed_kept AS (SELECT * FROM feed WHERE date >= {START} AND page < (SELECT stop_page FROM feed_stop))"""

SQL["feed_take_while"] = with_(REVIEWS, FEED) + "SELECT * FROM feed_kept"

SQL["newest_n"] = BASE + f"""
SELECT * FROM (SELECT * FROM reviews WHERE source = 'playstore' ORDER BY date DESC, review_id LIMIT {NEWEST_N})
WHERE date >= {START}"""

# Both stores are crawled whole; the dump holds every channel.
CRAWL = f"""win AS (SELECT * FROM reviews WHERE date >= {START}),
crawl AS (SELECT *, CASE source WHEN 'playstore' THEN 1 ELSE 2 END AS priority FROM win
          WHERE source IN ('playstore', 'appstore')),
social AS (SELECT * FROM win WHERE source NOT IN (SELECT source FROM crawl)),
u AS (SELECT * FROM crawl UNION ALL SELECT *, 3 FROM social)"""

SQL["source_precedence"] = with_(REVIEWS, CRAWL) + "SELECT * FROM social"

SQL["union_sources"] = with_(REVIEWS, CRAWL) + "SELECT * FROM u"

SQL["topup_resample"] = BASE + f"""
SELECT r.*, CAST(d.draw AS INT) AS draw FROM reviews r JOIN (VALUES (0), (1)) d(draw)
  ON d.draw = 0 OR substr(md5('{RESAMPLE_SEED}|' || r.review_id), 1, 8) < '{format(int(RESAMPLE_RATE * 16 ** 8), "08x")}'
WHERE r.date >= {START}"""

SQL["dashboard_kpis"] = BASE_CLEAN + """
SELECT count(*) AS total_reviews, round(avg(rating), 2) AS avg_rating,
       count(*) FILTER (WHERE regexp_matches(text, '\\[EMAIL\\]|\\[PHONE\\]')) AS masked_rows,
       count(DISTINCT source) AS active_channels
FROM clean"""

SQL["channel_share"] = BASE + """
SELECT source, count(*) AS n_reviews, count(*) / sum(count(*)) OVER () AS share
FROM reviews GROUP BY source"""

SQL["ratings_distribution"] = BASE + """
SELECT rating, count(*) AS n_reviews FROM reviews WHERE rating IS NOT NULL GROUP BY rating"""

SQL["rated_only"] = BASE + "SELECT review_id, source, rating FROM reviews WHERE rating IS NOT NULL"

SQL["facet_values"] = BASE_THEMED + """
SELECT DISTINCT 'source' AS facet, source AS value FROM themed_named WHERE source IS NOT NULL
UNION ALL SELECT DISTINCT 'rating', CAST(rating AS VARCHAR) FROM themed_named WHERE rating IS NOT NULL
UNION ALL SELECT DISTINCT 'theme', theme FROM themed_named"""

SQL["facet_filter"] = BASE_THEMED + """
SELECT review_id, source, rating, theme, title, text, date FROM themed_named
WHERE source = 'appstore' AND rating = 4 AND theme = 'English-language feedback'"""

SQL["search_reviews"] = BASE_CLEAN + f"""
SELECT review_id, source, title, text FROM clean
WHERE coalesce(regexp_matches(text, {q(SEARCH_PATTERN)}, 'i'), false)
   OR coalesce(regexp_matches(title, {q(SEARCH_PATTERN)}, 'i'), false)"""

SQL["default_theme"] = with_(REVIEWS, CLEAN, THEMED) + f"""
SELECT c.review_id, coalesce(m.theme, {q(FALLBACK_THEME)}) AS theme
FROM clean c LEFT JOIN (SELECT review_id, {_name_case('theme_id')} AS theme FROM themed
                        WHERE theme_id <> {q(FALLBACK_THEME_ID)}) m USING (review_id)"""

SQL["display_projection"] = BASE_THEMED + """
SELECT source, coalesce(CAST(rating AS VARCHAR), 'N/A') AS rating, theme, title, text, date
FROM themed_named"""

SQL["preview_lines"] = BASE_CLEAN + f"""
SELECT review_id, '- [' || upper(source) || '] (' || strftime(date, {ISO}) || '): '
       || substr(text, 1, 60) || '...' AS preview
FROM clean"""

SQL["theme_lexicon_join"] = BASE_CLEAN + f"""
SELECT t.review_id, lex.theme_id, lex.term
FROM (SELECT review_id, unnest({_TOKS}) AS term FROM clean) t
JOIN {lexicon_values(THEME_TERMS, 'theme_id')} USING (term)"""

SQL["question_evidence_join"] = BASE_CLEAN + f"""
SELECT t.review_id, lex.question_key, lex.term
FROM (SELECT review_id, unnest({_TOKS}) AS term FROM clean) t
JOIN {lexicon_values(QUESTION_TERMS, 'question_key')} USING (term)"""

SQL["assign_themes"] = BASE_THEMED + """
SELECT review_id, source, theme_id, theme, theme_score FROM themed_named"""

SQL["theme_volume_severity"] = BASE_THEMED + """
SELECT theme_id, theme, count(*) AS n_reviews, count(rating) AS n_rated,
       count(*) FILTER (WHERE rating <= 2) AS n_low, round(avg(rating), 4) AS avg_rating,
       round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(count(*) FILTER (WHERE rating <= 2) / nullif(count(rating), 0), 6) AS low_share
FROM themed_named GROUP BY theme_id, theme"""

SEV_BY_SOURCE = """sev AS (
  SELECT source, theme_id, theme, count(*) AS n_reviews, count(rating) AS n_rated,
         count(*) FILTER (WHERE rating <= 2) AS n_low, round(avg(rating), 4) AS avg_rating,
         round(count(*) / sum(count(*)) OVER (PARTITION BY source), 6) AS share,
         round(count(*) FILTER (WHERE rating <= 2) / nullif(count(rating), 0), 6) AS low_share
  FROM themed_named GROUP BY source, theme_id, theme)"""

SQL["top_themes"] = with_(REVIEWS, CLEAN, THEMED, SEV_BY_SOURCE) + f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY n_reviews DESC,
                                    avg_rating ASC NULLS LAST, theme_id) AS INTEGER) AS rank
  FROM sev) WHERE rank <= {TOP_K}"""

SQL["representative_quotes"] = BASE_THEMED + """
SELECT source, theme_id, theme, review_id, text AS quote FROM (
  SELECT *, row_number() OVER (PARTITION BY source, theme_id
                               ORDER BY theme_score DESC, length(text), review_id) AS rn
  FROM themed_named) WHERE rn = 1"""

_QROWS = ", ".join(f"({i + 1}, {q(k)}, {q(label)})" for i, (k, label) in enumerate(QUESTIONS))

QEVIDENCE = f"""qpairs AS (
  SELECT t.review_id, lex.question_key, lex.term
  FROM (SELECT review_id, unnest({_TOKS}) AS term FROM clean) t
  JOIN {lexicon_values(QUESTION_TERMS, 'question_key')} USING (term)),
qscored AS (SELECT question_key, review_id, count(*) AS score FROM qpairs GROUP BY ALL),
qtop AS (
  SELECT question_key, string_agg('#' || review_id, ', ' ORDER BY rank) AS top_review_ids
  FROM (SELECT *, row_number() OVER (PARTITION BY question_key ORDER BY score DESC, review_id) AS rank
        FROM qscored) WHERE rank <= {QUOTE_K} GROUP BY question_key),
qmatched AS (SELECT question_key, count(*) AS n_matched FROM qscored GROUP BY question_key)"""

SQL["question_evidence"] = with_(REVIEWS, CLEAN, QEVIDENCE) + f"""
SELECT qq.q_order, qq.question_key, qq.question, CAST(coalesce(m.n_matched, 0) AS BIGINT) AS n_matched,
       t.top_review_ids,
       CASE WHEN coalesce(m.n_matched, 0) = 0 THEN {q(NO_ANSWER)}
            ELSE m.n_matched || ' matching reviews; top evidence: ' || t.top_review_ids END AS answer
FROM (VALUES {_QROWS}) AS qq(q_order, question_key, question)
LEFT JOIN qmatched m USING (question_key) LEFT JOIN qtop t USING (question_key)"""

# ---------------------------------------------------------------- prompts

NUMBERED = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC, review_id) AS rn FROM clean)"""

SQL["number_reviews"] = with_(REVIEWS, CLEAN, NUMBERED) + "SELECT review_id, source, date, rn FROM numbered"


def line_sql(idx: str) -> str:
    return (f"'Review #' || {idx} || ' [Source: ' || source"
            " || CASE WHEN coalesce(rating, 0) <> 0 THEN ' | Rating: ' || rating || '/5' ELSE '' END"
            " || CASE WHEN length(title) > 0 THEN ' | Title: ' || title ELSE '' END"
            f" || ' | Date: ' || coalesce(strftime(date, {ISO}), '') || ']:' || chr(10) || '\"'"
            " || text || '\"' || chr(10) || chr(10)")


SQL["prompt_lines"] = with_(REVIEWS, CLEAN, NUMBERED) + f"""
SELECT review_id, source, rn, {line_sql('rn')} AS line FROM numbered"""

BATCHED = f"""batched AS (
  SELECT *, CAST((rn - 1) // {PACK_SIZE} AS BIGINT) AS batch,
         CAST(rn - ((rn - 1) // {PACK_SIZE}) * {PACK_SIZE} AS INT) AS review_index
  FROM numbered)"""

SQL["pack_prompts"] = with_(REVIEWS, CLEAN, NUMBERED, BATCHED) + f"""
SELECT source, batch, count(*) AS n_reviews,
       string_agg({line_sql('review_index')}, '' ORDER BY review_index) AS body
FROM batched GROUP BY source, batch"""

SQL["subsample_head"] = with_(REVIEWS, CRAWL) + """
SELECT 'head' AS variant, review_id, source, priority, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY priority, date DESC, review_id) AS rank FROM u)
WHERE rank <= 35
UNION ALL
SELECT 'fair', review_id, source, priority, CAST(rank AS INTEGER) FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC, review_id) AS rank FROM u)
WHERE rank <= 7"""

SQL["preview_head"] = with_(REVIEWS, CLEAN) + "SELECT * FROM clean ORDER BY review_id LIMIT 3"

SQL["annotate_batches"] = with_(REVIEWS, CLEAN, NUMBERED, BATCHED) + f"""
, sent AS (
  SELECT source, batch, {q(INSTRUCTIONS)} || string_agg({line_sql('review_index')}, '' ORDER BY review_index) AS prompt
  FROM batched GROUP BY source, batch)
SELECT source, batch, sha256(prompt) AS prompt_sha256,
       CASE WHEN length(prompt) <= {CONTEXT_CHARS} THEN '{{"characters": ' || length(prompt) || '}}' END AS response,
       CASE WHEN length(prompt) > {CONTEXT_CHARS}
            THEN 'ValueError: ' || length(prompt) || ' characters are more than {CONTEXT_CHARS}' END AS error,
       CAST(1 AS INT) AS attempts
FROM sent"""

# The replies' payloads, spelled out relationally: themes, assignments,
# answers and note per (source, batch) whose reply can be read.
_PLACE = f"batch % {REPLY_CYCLE}"
READABLE = f"{_PLACE} NOT IN ({REFUSED_REPLY}, {CUT_REPLY})"
ALL_BATCH_THEMES = f"""bt AS (
  SELECT b.source, b.batch, b.review_index, b.text, t.theme_id, {_name_case('t.theme_id')} AS theme_name
  FROM batched b JOIN themed t USING (review_id)),
bn AS (SELECT source, batch, count(*) AS n FROM bt GROUP BY ALL),
bc AS (
  SELECT source, batch, theme_id, any_value(theme_name) AS theme_name, count(*) AS c,
         arg_min(text, review_index) AS first_text
  FROM bt GROUP BY source, batch, theme_id),
btop AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, batch ORDER BY c DESC, theme_id) AS r
                 FROM bc) WHERE r <= 3),
bq AS (
  SELECT b.source, b.batch, lex.question_key, count(DISTINCT b.review_index) AS m
  FROM (SELECT source, batch, review_index, unnest({_TOKS}) AS term FROM batched) b
  JOIN {lexicon_values(QUESTION_TERMS, 'question_key')} USING (term)
  GROUP BY ALL)"""
BATCH_THEMES = ALL_BATCH_THEMES.replace("USING (review_id))", f"USING (review_id) WHERE b.{READABLE})", 1)

_QKEYS = ", ".join(f"({q(k)})" for k, _ in QUESTIONS)

PARSED_CTES = with_(REVIEWS, CLEAN, THEMED, NUMBERED, BATCHED, BATCH_THEMES)
# The payloads of all batches.
PAYLOAD_CTES = with_(REVIEWS, CLEAN, THEMED, NUMBERED, BATCHED, ALL_BATCH_THEMES)

SQL["parse_responses"] = PARSED_CTES + f"""
SELECT bn.source, bn.batch, CASE WHEN bn.{_PLACE} = {FENCED_REPLY} THEN 'recovered' ELSE 'ok' END AS status,
  CAST((SELECT count(*) FROM bc WHERE bc.source = bn.source AND bc.batch = bn.batch
        AND bc.theme_id <> {q(FALLBACK_THEME_ID)}) AS BIGINT) AS n_themes,
  CAST(bn.n AS BIGINT) AS n_assignments
FROM bn
UNION ALL
SELECT DISTINCT source, batch, 'rejected', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM batched WHERE NOT ({READABLE})"""

SQL["reply_quarantine"] = PARSED_CTES + f"""
SELECT DISTINCT source, batch, CASE WHEN {_PLACE} = {CUT_REPLY} THEN 'broken JSON' ELSE 'no JSON object' END AS reason,
  CASE WHEN {_PLACE} = {CUT_REPLY} THEN '{{"themes":' ELSE {q(REFUSAL[:10])} END AS starts_with
FROM batched WHERE NOT ({READABLE})"""

SQL["explode_payload"] = PAYLOAD_CTES + f"""
SELECT 'theme' AS kind, source, batch,
       CAST(row_number() OVER (PARTITION BY source, batch ORDER BY theme_id) - 1 AS BIGINT) AS pos,
       theme_id AS key, theme_name AS value
FROM bc WHERE theme_id <> {q(FALLBACK_THEME_ID)}
UNION ALL
SELECT 'assignment', source, batch, CAST(review_index - 1 AS BIGINT), CAST(review_index AS VARCHAR), theme_id
FROM bt
UNION ALL
SELECT 'answer', bn.source, bn.batch, NULL, k.question_key,
       coalesce(bq.m, 0) || ' of ' || bn.n || ' reviews'
FROM bn CROSS JOIN (VALUES {_QKEYS}) AS k(question_key)
LEFT JOIN bq ON bq.source = bn.source AND bq.batch = bn.batch AND bq.question_key = k.question_key
UNION ALL
SELECT 'top_theme', source, batch, CAST(r - 1 AS BIGINT), CAST(r AS VARCHAR), theme_name FROM btop
UNION ALL
SELECT 'quote', source, batch, CAST(r - 1 AS BIGINT), NULL, first_text FROM btop
UNION ALL
SELECT 'action', source, batch, CAST(r - 1 AS BIGINT), NULL, 'Review the ' || theme_name || ' feedback'
FROM btop"""

SQL["theme_back_join"] = PARSED_CTES + f"""
SELECT b.source, b.batch, b.review_index, b.review_id, CASE WHEN {READABLE} THEN t.theme_id END AS theme_id,
       CASE WHEN {READABLE} THEN {_name_case("t.theme_id")} ELSE {q(FALLBACK_THEME)} END AS theme
FROM batched b JOIN themed t USING (review_id)"""

# ---------------------------------------------------------------- reports

NOTES = f"""wk AS (SELECT *, date_trunc('week', date) AS week FROM themed_named),
nsev AS (
  SELECT source, week, theme_id, theme, count(*) AS n_reviews, count(*) FILTER (WHERE rating <= 2) AS n_low,
         round(avg(rating), 4) AS avg_rating
  FROM wk GROUP BY source, week, theme_id, theme),
ntop AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, week ORDER BY n_reviews DESC,
                                              avg_rating ASC NULLS LAST, theme_id) AS rank FROM nsev)
  WHERE rank <= {TOP_K}),
nquo AS (
  SELECT source, week, theme_id, text AS quote FROM (
    SELECT *, row_number() OVER (PARTITION BY source, week, theme_id
                                 ORDER BY theme_score DESC, length(text), review_id) AS rn FROM wk)
  WHERE rn = 1),
nsec AS (
  SELECT t.source, t.week,
    string_agg('### ' || t.rank || '. ' || t.theme || chr(10) || '> ' || t.n_reviews || ' reviews, '
               || t.n_low || ' rated 1 or 2' || chr(10) || chr(10), '' ORDER BY t.rank) AS themes_md,
    string_agg('- *"' || coalesce(q.quote, '') || '"*' || chr(10), '' ORDER BY t.rank) AS quotes_md,
    string_agg(t.rank || '. **Investigate ' || t.theme || '**' || chr(10), '' ORDER BY t.rank) AS actions_md
  FROM ntop t LEFT JOIN nquo q ON q.source = t.source AND q.week = t.week AND q.theme_id = t.theme_id
  GROUP BY t.source, t.week),
nqp AS (
  SELECT w.source, w.week, w.review_id, lex.question_key
  FROM (SELECT source, week, review_id, unnest({_TOKS}) AS term FROM wk) w
  JOIN {lexicon_values(QUESTION_TERMS, 'question_key')} USING (term)),
nqs AS (SELECT source, week, question_key, review_id, count(*) AS score FROM nqp GROUP BY ALL),
nqm AS (SELECT source, week, question_key, count(*) AS n_matched FROM nqs GROUP BY ALL),
nqt AS (
  SELECT source, week, question_key, string_agg('#' || review_id, ', ' ORDER BY rank) AS top_ids
  FROM (SELECT *, row_number() OVER (PARTITION BY source, week, question_key
                                     ORDER BY score DESC, review_id) AS rank FROM nqs)
  WHERE rank <= {QUOTE_K} GROUP BY ALL),
ngrp AS (SELECT source, week, count(*) AS n_reviews FROM wk GROUP BY ALL),
nqa AS (
  SELECT g.source, g.week,
    string_agg('### ' || qq.q_order || '. ' || qq.question || chr(10)
               || CASE WHEN coalesce(m.n_matched, 0) = 0 THEN {q(NO_ANSWER)}
                       ELSE m.n_matched || ' matching reviews; top evidence: ' || t.top_ids END
               || chr(10) || chr(10), '' ORDER BY qq.q_order) AS answers_md
  FROM ngrp g CROSS JOIN (VALUES {_QROWS}) AS qq(q_order, question_key, question)
  LEFT JOIN nqm m ON m.source = g.source AND m.week = g.week AND m.question_key = qq.question_key
  LEFT JOIN nqt t ON t.source = g.source AND t.week = g.week AND t.question_key = qq.question_key
  GROUP BY g.source, g.week),
notes AS (
  SELECT g.source || '/' || strftime(g.week, '%Y-%m-%d') AS report_key, g.source, g.week, g.n_reviews,
    '# Feedback Pulse Note - ' || g.source || chr(10) || '**Week of**: ' || strftime(g.week, '%B %d, %Y')
    || chr(10) || '**Reviews**: ' || g.n_reviews || chr(10) || chr(10) || '---' || chr(10) || chr(10)
    || '## Top Themes' || chr(10) || s.themes_md || '---' || chr(10) || chr(10) || '## User Quotes' || chr(10)
    || s.quotes_md || chr(10) || '---' || chr(10) || chr(10) || '## Strategic Action Ideas' || chr(10)
    || s.actions_md || chr(10) || '---' || chr(10) || chr(10) || '## Product Questions' || chr(10)
    || a.answers_md AS note
  FROM ngrp g JOIN nsec s ON s.source = g.source AND s.week = g.week
  JOIN nqa a ON a.source = g.source AND a.week = g.week)"""

SQL["weekly_note"] = with_(REVIEWS, CLEAN, THEMED, NOTES) + "SELECT * FROM notes"

_FALLBACK_ROWS = ", ".join(f"({i + 1}, {q(t)})" for i, t in enumerate(FALLBACK_ACTIONS))

ITEMS = f"""nlines AS (
  SELECT report_key, generate_subscripts(string_split(note, chr(10)), 1) - 1 AS pos,
         unnest(string_split(note, chr(10))) AS line FROM notes),
nev AS (
  SELECT *, CASE WHEN contains(line, 'Action Ideas') THEN 1 WHEN starts_with(line, '#') THEN 0 END AS event,
         regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS s
  FROM nlines),
nst AS (
  SELECT *, last_value(event IGNORE NULLS) OVER (PARTITION BY report_key ORDER BY pos
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state
  FROM nev),
nit AS (
  SELECT report_key, pos, line,
    CASE WHEN starts_with(s, '-') THEN regexp_replace(regexp_replace(s, '^-+', ''), '^\\s+|\\s+$', '', 'g')
         WHEN regexp_matches(s, '^[0-9]') AND contains(line, '.')
         THEN regexp_replace(substr(line, strpos(line, '.') + 1), '^\\s+|\\s+$', '', 'g') END AS item,
    state
  FROM nst),
nfirst AS (
  SELECT report_key, item, min(pos) AS pos FROM nit
  WHERE state = 1 AND NOT contains(line, 'Action Ideas') AND length(item) > 0
  GROUP BY report_key, item),
nfound AS (
  SELECT report_key, CAST(row_number() OVER (PARTITION BY report_key ORDER BY pos) AS INT) AS item_no, item
  FROM nfirst),
items AS (
  SELECT * FROM nfound
  UNION ALL
  SELECT n.report_key, f.item_no, f.item FROM notes n CROSS JOIN (VALUES {_FALLBACK_ROWS}) AS f(item_no, item)
  WHERE n.report_key NOT IN (SELECT report_key FROM nfound))"""

SQL["parse_action_items"] = with_(REVIEWS, CLEAN, THEMED, NOTES, ITEMS) + "SELECT * FROM items"

SQL["first_wins_dedupe"] = with_(REVIEWS, CLEAN, THEMED, NOTES, ITEMS) + f"""
, firsts AS (
  SELECT item, min({{'k': report_key, 'n': item_no}}) AS f FROM items GROUP BY item)
SELECT item, f.k AS first_report_key, f.n AS first_item_no FROM firsts
UNION ALL
SELECT item, NULL, NULL FROM (VALUES {_FALLBACK_ROWS}) AS a(i, item)
WHERE item NOT IN (SELECT item FROM firsts)"""

# ---------------------------------------------------------------- sources and sinks

# The channels' own ids are strings.
NATIVE = "* REPLACE (CAST(review_id AS VARCHAR) AS review_id)"

SQL["scan_reviews_json"] = BASE + f"SELECT {NATIVE} FROM reviews WHERE source <> 'linkedin'"

_PART = "length(coalesce({0}, '')) || ':' || coalesce({0}, '')"
SQL["review_identity"] = with_(REVIEWS, DUMP) + f"""
, landed AS (
  SELECT CASE source WHEN 'reddit' THEN 't3_' || review_id WHEN 'appstore' THEN CAST(review_id AS VARCHAR) END AS review_id,
         source, date_raw, title, text
  FROM dump, unnest(CASE WHEN rating = 5 THEN [1, 2] ELSE [1] END) AS c(copy)),
keyed AS (
  SELECT *, source || '/' || coalesce(review_id, '#' || sha256({_PART.format('date_raw')} || {_PART.format('title')}
            || {_PART.format('text')})) AS base FROM landed)
SELECT base || '#' || row_number() OVER (PARTITION BY base) AS review_key, review_id, source FROM keyed"""

SQL["scan_appstore_feed"] = BASE + """
SELECT CAST(review_id AS VARCHAR) AS review_id,
       CAST((row_number() OVER (ORDER BY date DESC, review_id) - 1) // 50 + 1 AS BIGINT) AS page,
       'appstore' AS source, rating, coalesce(title, '') AS title, coalesce(text, '') AS text, date
FROM reviews WHERE source = 'appstore'"""

SQL["scan_appstore_feed_rejects"] = BASE + f"""
SELECT CAST((rn - 1) // {FEED_PAGE_SIZE} + 1 AS BIGINT) AS page, CAST((rn - 1) % {FEED_PAGE_SIZE} AS INT) AS position,
       'no ISO date' AS reason, CAST(review_id AS VARCHAR) AS native_id
FROM (SELECT *, row_number() OVER (ORDER BY date DESC, review_id) AS rn FROM reviews WHERE source = 'appstore')
WHERE rating = 1"""

SQL["scan_playstore"] = BASE + """
SELECT CAST(review_id AS VARCHAR) AS review_id, 'playstore' AS source, rating, CAST(NULL AS VARCHAR) AS title, text, date
FROM reviews WHERE source = 'playstore'"""

SQL["sink_reviews_json"] = BASE_THEMED + """
SELECT review_id, source, rating, title, text, date, theme FROM themed_named"""

SQL["scan_labelled_reviews"] = SQL["sink_reviews_json"]

PAYLOAD_THEMES = f"""pthemes AS (
  SELECT DISTINCT theme_id, {_name_case('theme_id')} AS name FROM batched b JOIN themed t USING (review_id)
  WHERE theme_id <> {q(FALLBACK_THEME_ID)} AND {READABLE})"""

_DESC_CASE = "CASE theme_id " + " ".join(
    f"WHEN {q(k)} THEN {q(v[1])}" for k, v in sorted(THEME_NAMES.items())) + " END"

SQL["scan_themes_csv"] = with_(REVIEWS, CLEAN, THEMED, NUMBERED, BATCHED, PAYLOAD_THEMES) + f"""
SELECT theme_id, name, {_DESC_CASE} AS description FROM pthemes"""

SQL["sink_themes_csv"] = with_(REVIEWS, CLEAN, THEMED, NUMBERED, BATCHED, PAYLOAD_THEMES) + f"""
SELECT 'Theme ID,Theme Name,Description' AS line
UNION ALL
SELECT theme_id || ',' || name || ',' || {_DESC_CASE} FROM pthemes"""

REPORT_ANSWERS = f"""wk AS (SELECT *, date_trunc('week', date) AS week FROM clean),
nqp AS (
  SELECT w.source, w.week, w.review_id, lex.question_key
  FROM (SELECT source, week, review_id, unnest({_TOKS}) AS term FROM wk) w
  JOIN {lexicon_values(QUESTION_TERMS, 'question_key')} USING (term)),
nqs AS (SELECT source, week, question_key, review_id, count(*) AS score FROM nqp GROUP BY ALL),
nqm AS (SELECT source, week, question_key, count(*) AS n_matched FROM nqs GROUP BY ALL),
nqt AS (
  SELECT source, week, question_key, string_agg('#' || review_id, ', ' ORDER BY rank) AS top_ids
  FROM (SELECT *, row_number() OVER (PARTITION BY source, week, question_key
                                     ORDER BY score DESC, review_id) AS rank FROM nqs)
  WHERE rank <= {QUOTE_K} GROUP BY ALL),
ngrp AS (SELECT DISTINCT source, week FROM wk),
ranswers AS (
  SELECT g.source || '/' || strftime(g.week, '%Y-%m-%d') AS report_key, qq.q_order, qq.question_key,
    CASE WHEN coalesce(m.n_matched, 0) = 0 THEN {q(NO_ANSWER)}
         ELSE m.n_matched || ' matching reviews; top evidence: ' || t.top_ids END AS answer
  FROM ngrp g CROSS JOIN (VALUES {_QROWS}) AS qq(q_order, question_key, question)
  LEFT JOIN nqm m ON m.source = g.source AND m.week = g.week AND m.question_key = qq.question_key
  LEFT JOIN nqt t ON t.source = g.source AND t.week = g.week AND t.question_key = qq.question_key)"""

SQL["scan_qa_json"] = with_(REVIEWS, CLEAN, REPORT_ANSWERS) + "SELECT * FROM ranswers"

SQL["sink_qa_json"] = with_(REVIEWS, CLEAN, REPORT_ANSWERS) + """
SELECT '{"report_key":"' || report_key || '","question_answers":{'
       || string_agg('"' || question_key || '":"' || answer || '"', ',' ORDER BY q_order) || '}}' AS line
FROM ranswers GROUP BY report_key"""

SQL["sink_notes_text"] = with_(REVIEWS, CLEAN, THEMED, NOTES) + "SELECT report_key, note FROM notes"

SQL["sink_filtered_csv"] = BASE_THEMED + f"""
SELECT review_id, source, rating, theme, title, text, date FROM themed_named
WHERE source = 'reddit'
  AND (coalesce(regexp_matches(text, {q(SEARCH_PATTERN)}, 'i'), false)
       OR coalesce(regexp_matches(title, {q(SEARCH_PATTERN)}, 'i'), false))"""

# ---------------------------------------------------------------- projections

SQL["normalize_reviews"] = BASE + """
SELECT CAST(review_id AS VARCHAR) AS review_id, source, rating,
       CASE WHEN source = 'playstore' THEN NULL WHEN source = 'appstore' THEN coalesce(title, '')
            ELSE title END AS title,
       text, date
FROM reviews"""

SQL["coerce_rating"] = BASE + """
SELECT review_id, source, rating_raw,
       CASE WHEN TRY_CAST(rating_raw AS INTEGER) BETWEEN 1 AND 5 THEN TRY_CAST(rating_raw AS INTEGER) END AS rating
FROM (SELECT review_id, source,
        CASE WHEN source IN ('playstore', 'appstore') THEN CAST(rating AS VARCHAR)
             WHEN source = 'reddit' THEN '' WHEN source = 'linkedin' THEN 'N/A' END AS rating_raw
      FROM reviews)"""

SQL["parse_dates"] = BASE + """
SELECT review_id, source,
  CASE source WHEN 'playstore' THEN strftime(date, '%Y-%m-%dT%H:%M:%S.%fZ')
              WHEN 'appstore' THEN strftime(date - INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S.%f-07:00')
              WHEN 'reddit' THEN strftime(date, '%Y-%m-%d %H:%M:%S.%f')
              WHEN 'linkedin' THEN strftime(date, '%Y-%m-%d')
              ELSE strftime(date, '%B %d, %Y') END AS date_raw,
  CASE WHEN source = 'linkedin' THEN date_trunc('day', date)
       WHEN source = 'twitter' THEN NULL ELSE date END AS date
FROM reviews"""

# The same results by another way.
SQL["landing_window"] = SQL["rolling_window_filter"]
SQL["landing_feed"] = SQL["feed_take_while"]
SQL["search_indexed"] = SQL["search_reviews"]
