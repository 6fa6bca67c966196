"""SQL twins of the registered queries, for DuckDB over the driver's tables."""

from __future__ import annotations

from example_tables import MULTIPLIERS, NOW, TERMS
from threadwarden.schemas import ATTRIBUTES

LF = "chr(10)"
POST_RULE = "-" * 50
COMMENT_RULE = "-" * 30
EVENT_NOW = 1_706_659_200.0

# ---- views ----

THREADS = """
tp AS (SELECT conv_id || '_' || turn AS id, '[No Title]' AS title, text AS selftext, role AS author
       FROM conversations WHERE turn = 0),
tc AS (SELECT conv_id || '_' || turn AS id, turn AS ord, text AS body, role AS author,
              CASE WHEN (turn - 1) // 2 = 0 THEN 't3_' ELSE 't1_' END || conv_id || '_' || ((turn - 1) // 2) AS parent_id
       FROM conversations WHERE turn > 0)"""

EVENT_THREAD = """
tp AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type AS title, props AS selftext, CAST(user_id AS VARCHAR) AS author
       FROM events WHERE event_id = 0),
tc AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id AS ord, event_type || ' ' || props AS body,
              CAST(user_id AS VARCHAR) AS author,
              CASE WHEN event_id // 2 = 0 THEN 't3_' ELSE 't1_' END || (event_id // 2) AS parent_id
       FROM events WHERE event_id > 0)"""

TREE = """
tree(id, post_id, parent_comment_id, depth, path, author, body) AS (
  SELECT c.id, p.id, CAST(NULL AS VARCHAR), 0, [c.ord], c.author, c.body FROM tc c JOIN tp p ON c.parent_id = 't3_' || p.id
  UNION ALL
  SELECT c.id, t.post_id, t.id, t.depth + 1, list_append(t.path, c.ord), c.author, c.body
  FROM tc c JOIN tree t ON c.parent_id = 't1_' || t.id)"""


def node_lines(body: str = "body") -> str:
    pad = "repeat('  ', depth)"
    return (
        f"{pad} || 'Comment ID: ' || id || {LF} || "
        f"CASE WHEN parent_comment_id IS NULL THEN '' ELSE {pad} || 'This comment is a reply to parent comment: ' || parent_comment_id || {LF} END || "
        f"{pad} || 'Comment Author: ' || author || {LF} || {pad} || 'Comment Body: ' || {body} || {LF} || {pad} || '{COMMENT_RULE}' || {LF}"
    )


HEADER = (
    f"'Post ID: ' || id || {LF} || 'Post Title: ' || title || {LF} || 'Post Content: ' || selftext || {LF} "
    f"|| 'Post Author: ' || author || {LF} || '{POST_RULE}' || {LF}"
)
LINES = f"""
lines AS (SELECT post_id, path, id, depth, {node_lines()} AS line FROM tree)"""
CONVERSATIONS = f"""
bodies AS (SELECT post_id, string_agg(line, '' ORDER BY path) AS body FROM lines GROUP BY post_id),
conv AS (SELECT p.id AS post_id, {HEADER.replace("id ||", "p.id ||", 1)} || coalesce(b.body, 'No comments' || {LF}) AS full_conversation
         FROM tp p LEFT JOIN bodies b ON b.post_id = p.id)"""
ALL_LINES = f"""
all_lines AS (SELECT id AS post_id, CAST([] AS BIGINT[]) AS path, CAST(NULL AS VARCHAR) AS id, -1 AS depth, {HEADER} AS line FROM tp
              UNION ALL SELECT post_id, path, id, depth, line FROM lines),
placed AS (SELECT *, CAST(coalesce(sum(length(line)) OVER (PARTITION BY post_id ORDER BY path
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_, count(id) OVER (PARTITION BY post_id) AS n_comments
           FROM all_lines)"""

POSTS = """
dp AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, source AS subreddit, lang || ' ' || source AS title, text AS selftext, lang AS author,
              CAST(n_chars AS DOUBLE) AS score, 1700000000.0::DOUBLE + doc_id * 60 AS created FROM documents)"""
ITEMS = """
items AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS author, event_type AS subreddit, props AS body, value AS score,
                 CAST(floor(epoch(ts)) AS DOUBLE) AS created FROM events)"""


def term_rows() -> str:
    return ", ".join(f"({i}, '{t}')" for i, t in enumerate(TERMS))


BREAK = r"[^\p{L}\p{N}]+"
TERM_MATCHES = f"""
terms(term_no, term) AS (VALUES {term_rows()}),
words AS (SELECT DISTINCT term, word FROM (SELECT term, unnest(regexp_split_to_array(lower(term), '{BREAK}')) AS word FROM terms) WHERE word <> ''),
symbols AS (SELECT DISTINCT term FROM terms WHERE NOT regexp_matches(term, '[\\p{{L}}\\p{{N}}]') AND trim(term) <> ''),
needed AS (SELECT term, count(*) AS n_words FROM words GROUP BY term),
seen AS (SELECT DISTINCT id, unnest(regexp_split_to_array(lower(body), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM texts),
matches AS (SELECT s.id, w.term FROM seen s JOIN words w USING (word) JOIN needed n USING (term)
            GROUP BY s.id, w.term, n.n_words HAVING count(*) = n.n_words
            UNION ALL SELECT t.id, s.term FROM texts t JOIN symbols s ON contains(lower(t.body), lower(s.term)))"""
POST_TEXTS = """
texts AS (SELECT id, title || ' ' || selftext AS body FROM dp)"""


def draws(num_posts: int) -> str:
    last = -(-num_posts // 40) - 1
    return f"""
draws AS (SELECT s.subreddit, CAST(d.draw AS INTEGER) AS draw, CAST(least(40, {num_posts} - 40 * d.draw) AS INTEGER) AS requested, t.term AS query
          FROM (SELECT DISTINCT source AS subreddit FROM documents) s CROSS JOIN (SELECT unnest(range(0, {last} + 1)) AS draw) d
          JOIN terms t ON t.term_no = (CAST(substr(s.subreddit, 4) AS INTEGER) + d.draw) % {len(TERMS)})"""


HITS = """
candidates AS (SELECT p.id, p.doc_id, p.subreddit, p.created, d.draw, d.query, d.requested,
                 row_number() OVER (PARTITION BY d.subreddit, d.draw ORDER BY p.created DESC, p.id) AS rn
               FROM dp p JOIN matches m ON m.id = p.id JOIN draws d ON d.subreddit = p.subreddit AND d.query = m.term)"""


def score_sql(m: int, text: str = "text") -> str:
    return f"((length({text}) * {m}) % 1000)::DOUBLE / 1000.0::DOUBLE"


SCORES = "\nscores AS (SELECT CAST(doc_id AS VARCHAR) AS post_id, text, " + ", ".join(
    f"{score_sql(m)} AS {a}_score, ((length(text) * {m}) % 50)::DOUBLE AS {a}_max_span_begin, "
    f"((length(text) * {m}) % 50 + {m})::DOUBLE AS {a}_max_span_end"
    for a, m in zip(ATTRIBUTES, MULTIPLIERS)
) + " FROM documents)"
SCORE_COLUMNS = ", ".join(f"{a}_score, {a}_max_span_begin, {a}_max_span_end" for a in ATTRIBUTES)


def pick(part: str, source: str = "max_score") -> str:
    whens = " ".join(f"WHEN {a}_score = {source} THEN {part.format(a=a)}" for a in ATTRIBUTES)
    return f"CASE {whens} END"


MAXIMA = f"""
tops AS (SELECT *, greatest({", ".join(f"{a}_score" for a in ATTRIBUTES)}) AS max_score FROM scores),
maxima AS (SELECT *, {pick("'{a}'")} AS max_attribute, {pick("{a}_max_span_begin")} AS max_span_begin,
                  {pick("{a}_max_span_end")} AS max_span_end FROM tops)"""


DOCUMENT_TEXTS = "SELECT CAST(doc_id AS VARCHAR) AS post_id, text AS full_conversation FROM documents"


def sent(source: str = DOCUMENT_TEXTS, limit: int = 19_000, name: str = "sent") -> str:
    """What a model reads of each conversation."""
    cut = f"substr(full_conversation, 1, {limit})"
    return f"\n{name} AS (SELECT post_id, {cut} AS text, CAST(length({cut}) AS INTEGER) AS n FROM ({source}))"


ANSWERED = "n % 10 NOT IN (1, 5, 7, 9)"


def answer_columns() -> str:
    out = []
    for i, (a, m) in enumerate(zip(ATTRIBUTES, MULTIPLIERS)):
        value = f"((n * {m}) % 1000)::DOUBLE / 1000.0::DOUBLE"
        second = f"((n * {m}) % 7)::DOUBLE / 10.0::DOUBLE"
        gone = "n % 3 = 0" if a == "threat" else "false"
        none = f"({gone}) OR (n + {i}) % 4 = 0"
        out += [
            f"CASE WHEN {gone} THEN NULL ELSE {value} END AS {a}_score",
            f"CASE WHEN {none} THEN NULL WHEN {second} > {value} THEN (n // 2)::DOUBLE ELSE 0.0::DOUBLE END AS {a}_max_span_begin",
            f"CASE WHEN {none} THEN NULL WHEN {second} > {value} THEN n::DOUBLE ELSE (n // 2)::DOUBLE END AS {a}_max_span_end",
        ]
    return ", ".join(out)


PROMPTS = f"""
{sent(limit=1_000_000, name="whole")},
prompts AS (SELECT post_id, n, '[Post ID: ' || post_id || '] ' || text AS prompt, CAST(length('[Post ID: ' || post_id || '] ' || text) AS INTEGER) AS pn FROM whole)"""


def compact_verdict() -> str:
    """The judge's JSON as json.dumps writes it, for its length."""
    return (
        "'{\"user_id\": \"' || user_id || '\", \"post_id\": \"made up\", \"comment_id\": \"' || comment_id || "
        "'\", \"is_flagged\": ' || CASE WHEN is_flagged THEN 'true' ELSE 'false' END || ', \"reasoning\": \"' || reasoning || "
        "'\", \"suggested_prompt_modifications\": \"' || suggested_prompt_modifications || '\"}'"
    )


VERDICTS = f"""
{PROMPTS},
raw AS (SELECT post_id, n, pn, i, CASE WHEN i = 0 THEN '[deleted]' ELSE 'u' || (pn % 5) END AS user_id,
               CASE WHEN i = 0 THEN 'c' || post_id ELSE 'c' || (pn % 11 + i) END AS comment_id, (pn + i) % 3 = 0 AS is_flagged, 'length ' || pn AS reasoning,
               CASE WHEN i = 0 THEN 'hint ' || (pn % 4) ELSE '' END AS suggested_prompt_modifications
        FROM (SELECT *, unnest(range(0, pn % 7 - 2)) AS i FROM prompts WHERE pn % 7 > 2)),
response AS (SELECT post_id, length('[' || string_agg({compact_verdict()}, ', ' ORDER BY i) || CASE WHEN max(pn) % 14 = 6 THEN ', 5' ELSE '' END || ']') AS rn FROM raw GROUP BY post_id),
verdicts AS (SELECT raw.*, sha256('conversations:' || raw.post_id || ':' || i) AS gemini_id, 'conversations' AS sheet_name,
                    CAST(n AS BIGINT) AS conversation_length, CAST(pn // 4 + rn // 4 AS BIGINT) AS tokens_used
             FROM raw JOIN response USING (post_id))"""

COMMENT_TABLE = """
ct AS (SELECT 'c' || doc_id AS id, CASE WHEN lang = 'de' THEN '[deleted]' ELSE lang END AS author,
              CASE WHEN lang = 'fr' THEN '[removed]' ELSE text END AS body, CAST(doc_id AS VARCHAR) AS post_id FROM documents)"""

PATCHY = """
patchy AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'de' THEN NULL ELSE lang || ' ' || source END AS title,
                  CASE WHEN length(text) < 200 THEN NULL ELSE text END AS selftext, CASE WHEN lang = 'fr' THEN NULL ELSE lang END AS author
           FROM documents)"""

DAY = 86400

ORACLES: dict[str, str] = {
    "A1_csv_scan": "SELECT doc_id, text AS body, CASE WHEN lang = 'en' THEN lang END AS lang FROM documents",
    "A2_header_promotion": "SELECT doc_id, toxic FROM labels",
    "A3_schema_file": f"""WITH {POSTS} SELECT id, subreddit, score, CAST(created AS BIGINT) AS created, CAST(NULL AS BOOLEAN) AS over_18 FROM dp""",
    "A4_generated_scores_schema": f"""WITH {SCORES}
SELECT CAST(NULL AS VARCHAR) AS perspective_id, CAST(NULL AS VARCHAR) AS sheet_name, CAST(NULL AS VARCHAR) AS subreddit, post_id,
       CAST(NULL AS VARCHAR) AS languages, CAST(NULL AS VARCHAR) AS detected_languages, {SCORE_COLUMNS} FROM scores""",
    "A5_config_scan": f"""WITH terms(term_no, term) AS (VALUES {term_rows()})
SELECT 'subreddit' AS kind, source AS name FROM (SELECT DISTINCT source FROM documents)
UNION ALL SELECT 'term', term FROM terms
UNION ALL SELECT 'attribute', unnest([{", ".join(f"'{a}'" for a in ATTRIBUTES)}])""",
    "A6_prompt_asset": f"SELECT CAST(doc_id AS VARCHAR) AS post_id, 'Judge each comment.' || {LF} || 'Answer as a list.' AS system_instruction FROM documents",
    "A7_aligned_append": """SELECT doc_id, source, n_chars FROM documents
UNION ALL SELECT doc_id, NULL, NULL FROM labels""",
    "A8_csv_sink": f"WITH RECURSIVE {THREADS}, {TREE}, {LINES}, {CONVERSATIONS} SELECT post_id, 0::BIGINT AS part, full_conversation FROM conv",
    "A9_entity_json_sink": f"WITH {POSTS} SELECT id, subreddit, selftext, created FROM dp",
    "A10_materialize_once": "SELECT doc_id, n_chars FROM documents",
    "A11_input_fallback": "SELECT CAST(doc_id AS VARCHAR) AS post_id, text AS full_conversation FROM documents",
    "B1_subreddit_listing": f"""WITH {POSTS}, top AS (SELECT * FROM dp WHERE subreddit = 'src3' ORDER BY score DESC, id LIMIT 20)
SELECT id, score, created FROM top WHERE created >= {NOW - 29.8 * DAY}""",
    "B2_global_search": f"""WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES}
SELECT id, created FROM dp WHERE id IN (SELECT id FROM matches WHERE term = 'the of') ORDER BY created DESC, id LIMIT 25""",
    "B3_subreddit_search": f"""WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES},
top AS (SELECT * FROM dp WHERE subreddit = 'src5' AND id IN (SELECT id FROM matches WHERE term = 'the of') ORDER BY created DESC, id LIMIT 15)
SELECT id, created, 'the of' AS query FROM top WHERE created >= {NOW - 29.7 * DAY}""",
    "B4_batched_search": f"""WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES}, {draws(90)}, {HITS}
SELECT id, subreddit, draw, query, created FROM candidates WHERE rn <= requested AND created >= {NOW - 29.9 * DAY}""",
    "B5_term_match": f"WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES} SELECT id, term FROM matches",
    "B5_term_match_by_join": f"WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES} SELECT id, term FROM matches",
    "B6_comments_of_posts": f"""WITH RECURSIVE {THREADS}, {TREE}
SELECT t.id, t.post_id, t.depth, t.body FROM tree t JOIN tp ON tp.id = t.post_id WHERE tp.author = 'user' AND CAST(split_part(t.id, '_', 2) AS INTEGER) >= 2""",
    "B7_user_lookup": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS username FROM events WHERE user_id = 8",
    "B8_user_posts": f"""WITH {ITEMS}, top AS (SELECT * FROM items WHERE author = '8' ORDER BY created DESC, id LIMIT 20)
SELECT id, author, created FROM top WHERE created >= {EVENT_NOW - 10 * DAY}""",
    "B8_posts_of_all_users": f"""WITH {ITEMS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY created DESC, id) AS rn FROM items)
SELECT id, author, created FROM ranked WHERE rn <= 5 AND created >= {EVENT_NOW - 2 * DAY}""",
    "B9_user_comments": f"""WITH {ITEMS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY score DESC, id) AS rn FROM items)
SELECT id, author, score, body FROM ranked WHERE rn <= 3 AND author IN (SELECT author FROM items WHERE subreddit = 'signup')""",
    "B10_draw_plan": """SELECT subreddit, CAST(draw AS INTEGER) AS draw, CAST(least(40, 90 - 40 * draw) AS INTEGER) AS requested
FROM (SELECT DISTINCT source AS subreddit FROM documents) CROSS JOIN (SELECT unnest(range(0, 3)) AS draw)""",
    "B11_term_per_draw": f"WITH terms(term_no, term) AS (VALUES {term_rows()}), {draws(200)} SELECT subreddit, draw, requested, query FROM draws",
    "B12_query_lineage": f"""WITH RECURSIVE {THREADS}, {TREE}, texts AS (SELECT id, selftext AS body FROM tp), {TERM_MATCHES}
SELECT t.id, t.post_id, m.term AS query FROM tree t JOIN matches m ON m.id = t.post_id""",
    "B13_recency_cutoff": f"WITH {ITEMS} SELECT id, created FROM items WHERE created >= {EVENT_NOW - 7 * DAY}",
    "B14_duplicate_control": f"""WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES}, {draws(200)}, {HITS}
SELECT id, min(query) AS query, string_agg(DISTINCT query, '|' ORDER BY query) AS queries FROM candidates WHERE rn <= requested GROUP BY id""",
    "B15_gather_progress": f"""WITH {POSTS}, {POST_TEXTS}, {TERM_MATCHES}, {draws(90)}, {HITS}
SELECT d.subreddit, CAST(sum(d.requested) AS BIGINT) AS requested,
       (SELECT count(*) FROM candidates c WHERE c.subreddit = d.subreddit AND c.rn <= c.requested) AS posts_saved,
       (SELECT count(*) FROM labels l JOIN documents x USING (doc_id) WHERE x.source = d.subreddit) AS comments_saved
FROM draws d GROUP BY d.subreddit""",
    "C1_C2_C7_clean_records": """SELECT source AS subreddit, text AS selftext, 'c' || doc_id || ',d' || doc_id AS _comments_by_id,
       CASE WHEN lang <> 'de' THEN lang END AS author, doc_id * 60.0::DOUBLE + 1700000000 AS created, CAST(doc_id AS VARCHAR) AS id,
       '' AS query, '' AS perspective_id, '' AS custom_llm_id FROM documents""",
    "C3_C5_nested_to_scalar": """SELECT CAST(doc_id AS VARCHAR) AS id, source AS subreddit, CASE WHEN lang <> 'de' THEN lang END AS author,
       unnest(['c' || doc_id, 'd' || doc_id]) AS comment_key FROM documents""",
    "C4_epoch_text": """SELECT CAST(doc_id AS VARCHAR) AS id,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(1700000000 + doc_id * 60), '%Y-%m-%d %H:%M:%S') AS created_utc FROM documents""",
    "C6_placeholder_fill": f"""WITH {PATCHY} SELECT id, coalesce(title, '[No Title]') AS title, coalesce(selftext, '[No Content]') AS selftext,
       coalesce(author, '[Unknown Author]') AS author FROM patchy""",
    "C8_null_tokens": f"WITH {PATCHY} SELECT id, title, selftext, author FROM patchy",
    "C9_required_columns": f"WITH {POSTS} SELECT id, title, selftext, author FROM dp",
    "C10_parent_decode": f"""WITH {THREADS}, odd AS (SELECT id, CASE WHEN ord >= 6 THEN 'x9_odd' WHEN author <> 'system' THEN parent_id END AS parent_id FROM tc)
SELECT id, CASE substr(parent_id, 1, 3) WHEN 't3_' THEN 'post' WHEN 't1_' THEN 'comment' END AS parent_kind,
       CASE WHEN substr(parent_id, 1, 3) IN ('t3_', 't1_') THEN substr(parent_id, 4) END AS parent_key FROM odd""",
    "C11_membership_ignoring_case": "SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')",
    "C12_scored_text": f"WITH {POSTS} SELECT id, title || ' ' || selftext AS scored_text FROM dp",
    "C13_C14_truncated_text": """SELECT CAST(doc_id AS VARCHAR) AS post_id, substr(text, 1, 19000) AS text, CAST(length(substr(text, 1, 19000)) AS INTEGER) AS text_length
FROM documents WHERE doc_id <> 3""",
    "C15_token_estimate": f"WITH {POSTS} SELECT id, CAST(length(selftext) // 4 + length(title) // 4 AS BIGINT) AS tokens FROM dp",
    "C16_prompt": f"WITH {PROMPTS} SELECT post_id, prompt FROM prompts",
    "C17_C18_stable_id": """SELECT CAST(doc_id AS VARCHAR) AS post_id, sha256('conversations:' || doc_id) AS perspective_id,
       'conversations' AS sheet_name FROM documents""",
    "D1_top_level_comments": f"WITH {THREADS} SELECT c.id, p.id AS post_id FROM tc c JOIN tp p ON c.parent_id = 't3_' || p.id",
    "D2_reply_tree": f"WITH RECURSIVE {THREADS}, {TREE} SELECT id, post_id, parent_comment_id, depth FROM tree",
    "D2_deep_tree_in_one_thread": f"WITH RECURSIVE {EVENT_THREAD}, {TREE} SELECT id, post_id, parent_comment_id, depth FROM tree",
    "D3_node_lines": f"WITH RECURSIVE {THREADS}, {TREE}, {LINES} SELECT id, line AS lines FROM lines",
    "D4_reading_order": f"""WITH RECURSIVE {EVENT_THREAD}, {TREE}, {LINES}, {ALL_LINES}
SELECT post_id, id, depth, offset_ AS "offset", n_comments FROM placed WHERE depth >= 0""",
    "D5_post_header": f"WITH {THREADS} SELECT id AS post_id, {HEADER} AS header FROM tp",
    "D6_empty_threads": f"""WITH {POSTS}
SELECT id AS post_id, 0::BIGINT AS part, {HEADER} || CASE WHEN l.doc_id IS NULL THEN 'No comments' || {LF} ELSE 'Comment ID: c' || l.doc_id || {LF} ||
       'Comment Author: rater' || {LF} || 'Comment Body: quality ' || l.quality || {LF} || '{COMMENT_RULE}' || {LF} END AS full_conversation
FROM dp LEFT JOIN labels l ON l.doc_id = dp.doc_id""",
    "D7_compose_conversations": f"WITH RECURSIVE {THREADS}, {TREE}, {LINES}, {CONVERSATIONS} SELECT post_id, 0::BIGINT AS part, full_conversation FROM conv",
    "D7_compose_big_thread_in_parts": f"""WITH RECURSIVE {EVENT_THREAD}, {TREE}, {LINES}, {ALL_LINES}
SELECT post_id, offset_ // 50000 AS part, string_agg(line, '' ORDER BY path) AS full_conversation FROM placed GROUP BY post_id, offset_ // 50000""",
    "D7_conversation_beginnings": f"""WITH RECURSIVE {EVENT_THREAD}, {TREE}, {LINES}, {CONVERSATIONS}
SELECT post_id, 0::BIGINT AS part, substr(full_conversation, 1, 19000) AS full_conversation FROM conv""",
    "D8_unreached_comments": """WITH RECURSIVE tc AS (
  SELECT conv_id || '_' || turn AS id, conv_id, CASE WHEN turn = 3 AND conv_id % 5 = 0 THEN 't1_' || conv_id || '_7'
         WHEN turn = 4 AND conv_id % 7 = 0 THEN 'x9_odd'
         ELSE CASE WHEN (turn - 1) // 2 = 0 THEN 't3_' ELSE 't1_' END || conv_id || '_' || ((turn - 1) // 2) END AS parent_id
  FROM conversations WHERE turn > 0 AND turn <> 2),
walk(id, parent_id, above, steps) AS (SELECT id, parent_id, parent_id, 0 FROM tc
  UNION ALL SELECT w.id, w.parent_id, c.parent_id, w.steps + 1 FROM walk w JOIN tc c ON w.above = 't1_' || c.id WHERE w.steps < 20),
ends AS (SELECT id, any_value(parent_id) AS parent_id, arg_max(above, steps) AS above, max(steps) AS steps FROM walk GROUP BY id)
SELECT id, parent_id, CASE WHEN steps = 20 THEN 'cycle' WHEN above LIKE 't3_%' THEN 'unknown post'
                           WHEN above LIKE 't1_%' THEN 'missing comment' ELSE 'unreadable parent' END AS reason
FROM ends WHERE NOT (above LIKE 't3_%' AND substr(above, 4) IN (SELECT conv_id || '_0' FROM conversations WHERE turn = 0 AND role <> 'system'))""",
    "D9_duplicates_kept_once": f"WITH RECURSIVE {THREADS}, {TREE}, {LINES}, {CONVERSATIONS} SELECT post_id, 0::BIGINT AS part, full_conversation FROM conv",
    "D9_duplicates_repeated": f"""WITH RECURSIVE {THREADS.replace('tc AS', 'tc0 AS')},
tc AS (SELECT id, ord, body, author, parent_id FROM tc0 UNION ALL SELECT id, ord + 100, body, author, parent_id FROM tc0 WHERE ord < 3),
{TREE}, {LINES}, {CONVERSATIONS} SELECT post_id, 0::BIGINT AS part, full_conversation FROM conv""",
    "E1_E9_toxicity_scores": f"""WITH {sent()}
SELECT sha256('conversations:' || post_id) AS perspective_id, 'conversations' AS sheet_name, d.source AS subreddit, post_id,
       CASE WHEN n % 2 = 0 THEN 'en' ELSE 'fr de' END AS languages, 'en' AS detected_languages, {answer_columns()}
FROM sent JOIN documents d ON CAST(d.doc_id AS VARCHAR) = post_id WHERE {ANSWERED}""",
    "E2_E11_verdicts": f"""WITH {VERDICTS}
SELECT user_id, post_id, comment_id, is_flagged, reasoning, suggested_prompt_modifications, gemini_id, sheet_name, conversation_length, tokens_used FROM verdicts""",
    "E6_retry_once": f"""WITH {sent()}
SELECT post_id, CASE WHEN n % 10 IN (1, 3) THEN 2 ELSE 1 END AS attempts,
       CASE n % 10 WHEN 1 THEN 2 WHEN 3 THEN 1 WHEN 7 THEN 1 WHEN 9 THEN 1 ELSE 0 END AS n_errors, n % 10 NOT IN (1, 7, 9) AS answered FROM sent""",
    "E7_E15_error_rows": f"""WITH {sent()}
SELECT post_id, n AS text_length, 429 AS error_code, 'call 1 refused' AS message, 'slow down' AS details FROM sent WHERE n % 10 IN (1, 3)
UNION ALL SELECT post_id, n, 429, 'call 2 refused', 'slow down' FROM sent WHERE n % 10 = 1
UNION ALL SELECT post_id, n, 400, 'call 1 refused', 'bad request' FROM sent WHERE n % 10 = 7
UNION ALL SELECT post_id, n, NULL, 'no answer', 'the model returned nothing' FROM sent WHERE n % 10 = 9""",
    "E8_batch_slices": """SELECT doc_id, position, (position - 120) // 50 AS batch
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) WHERE position >= 120""",
    "E8_resume": "SELECT CAST(doc_id AS VARCHAR) AS post_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "E8_continued_calls": f"""WITH {VERDICTS}, l AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS post_id FROM labels),
n AS (SELECT post_id, count(*) AS n FROM verdicts GROUP BY post_id)
SELECT d.post_id, CASE WHEN l.post_id IS NULL THEN 1 ELSE 2 END::BIGINT AS n_calls, CASE WHEN l.post_id IS NULL THEN 0 ELSE 1 END::BIGINT AS last_copy,
       coalesce(n.n, 0) * CASE WHEN l.post_id IS NULL THEN 1 ELSE 2 END AS n_verdicts
FROM (SELECT CAST(doc_id AS VARCHAR) AS post_id FROM documents) d LEFT JOIN l USING (post_id) LEFT JOIN n USING (post_id)""",
    "E1_composed_scores": f"""WITH {POSTS}, conv AS (
  SELECT id AS post_id, subreddit, {HEADER} || CASE WHEN l.doc_id IS NULL THEN 'No comments' || {LF} ELSE 'Comment ID: c' || l.doc_id || {LF} ||
         'Comment Author: rater' || {LF} || 'Comment Body: quality ' || l.quality || {LF} || '{COMMENT_RULE}' || {LF} END AS full_conversation
  FROM dp LEFT JOIN labels l ON l.doc_id = dp.doc_id), {sent("SELECT * FROM conv")}
SELECT sha256('conversations:' || post_id) AS perspective_id, subreddit, post_id, ((n * 7) % 1000)::DOUBLE / 1000.0::DOUBLE AS toxicity_score,
       CASE WHEN n % 3 = 0 THEN NULL ELSE ((n * 23) % 1000)::DOUBLE / 1000.0::DOUBLE END AS threat_score
FROM sent JOIN conv USING (post_id) WHERE {ANSWERED}""",
    "E10_best_span": """WITH spans AS (SELECT doc_id, i - 1 AS span_begin, i - 1 + length(w) AS span_end, (length(w) % 5)::DOUBLE AS score
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents))
SELECT doc_id, score, CAST(span_begin AS INTEGER) AS span_begin, CAST(span_end AS INTEGER) AS span_end
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, span_begin) AS rn FROM spans) WHERE rn = 1""",
    "E12_ranked_attributes": f"""WITH {sent()}, each AS ({" UNION ALL ".join(
        f"SELECT post_id, {i} AS listed, '{a.upper()}' AS attribute, ((n * {m}) % 1000)::DOUBLE / 1000.0::DOUBLE AS summary_score, "
        f"CASE WHEN (n + {i}) % 4 = 0 THEN '' ELSE substr(text, 1, n // 2) || '|' || substr(text, n // 2 + 1) END AS span_texts "
        f"FROM sent WHERE {ANSWERED}" + (" AND n % 3 <> 0" if a == "threat" else "")
        for i, (a, m) in enumerate(zip(ATTRIBUTES, MULTIPLIERS)))}),
placed AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY summary_score DESC, listed) - 1 AS position FROM each)
SELECT p.post_id, t.summary_score AS max_score, t.attribute AS max_score_attribute, CAST(p.position AS INTEGER) AS position, p.attribute, p.summary_score, p.span_texts
FROM placed p JOIN placed t ON t.post_id = p.post_id AND t.position = 0""",
    "E13_languages": f"""WITH {sent()} SELECT CASE WHEN n % 2 = 0 THEN 'en' ELSE 'fr de' END AS languages, 'en' AS detected_languages, count(*) AS n
FROM sent WHERE {ANSWERED} GROUP BY 1, 2""",
    "E14_unparseable_responses": f"""WITH {PROMPTS}, {sent()}
SELECT post_id, n AS text_length, CAST(NULL AS INTEGER) AS error_code, 'JSONDecodeError' AS message, '{{bad' AS details FROM sent WHERE n % 20 = 5
UNION ALL SELECT post_id, n, NULL, 'no scores', '{{}}' FROM sent WHERE n % 20 = 15
UNION ALL SELECT post_id, n, NULL, 'no verdict', '5' FROM prompts WHERE pn % 14 = 6
UNION ALL SELECT post_id, n, NULL, 'JSONDecodeError', CASE pn % 7 WHEN 1 THEN '{{"comment_id": "alone"}}' ELSE '[broken' END FROM prompts WHERE pn % 7 IN (1, 2)""",
    "E16_run_totals": f"""WITH {VERDICTS},
answers AS (SELECT p.pn, CASE pn % 7 WHEN 0 THEN 2 WHEN 1 THEN length('{{"comment_id": "alone"}}') WHEN 2 THEN 7 ELSE r.rn END AS rn
            FROM prompts p LEFT JOIN response r USING (post_id))
SELECT count(*) AS conversations_analyzed, CAST(sum(pn // 4 + rn // 4) AS BIGINT) AS total_tokens, count(*) AS total_requests FROM answers""",
    "E17_missing_data_rules": f"""WITH {VERDICTS}, {COMMENT_TABLE}
SELECT v.gemini_id, v.post_id, CASE WHEN ct.author = '[deleted]' OR v.user_id = '[deleted]' THEN 'N/A' ELSE v.user_id END AS user_id,
       coalesce(ct.id, 'N/A') AS comment_id, CASE WHEN ct.body = '[removed]' THEN false ELSE v.is_flagged END AS is_flagged
FROM verdicts v LEFT JOIN ct ON ct.id = v.comment_id""",
    "E18_fabricated_verdicts": f"""WITH {VERDICTS}, {COMMENT_TABLE}
SELECT gemini_id, post_id, comment_id FROM verdicts v WHERE NOT EXISTS (SELECT 1 FROM ct WHERE ct.post_id = v.post_id AND ct.id = v.comment_id)""",
    "F1_F2_row_maximum": f"""WITH {SCORES}
SELECT post_id, greatest({", ".join(f"{a}_score" for a in ATTRIBUTES if a not in ("insult", "threat"))}) AS highest FROM scores""",
    "F3_F4_worst_attribute": f"WITH {SCORES}, {MAXIMA} SELECT post_id, max_attribute, max_score, max_span_begin, max_span_end FROM maxima",
    "F5_F6_attached_text": f"WITH {SCORES} SELECT post_id, toxicity_score, CASE WHEN post_id <> '5' THEN text END AS full_text FROM scores",
    "F7_highest_scores": f"""WITH {SCORES}, {MAXIMA}
SELECT post_id, {SCORE_COLUMNS}, max_attribute, max_score, max_span_begin, max_span_end, text AS full_text FROM maxima ORDER BY max_score DESC, post_id""",
    "F8_rank_conversations": f"""WITH {SCORES}, {MAXIMA}
SELECT post_id, text AS full_conversation, max_score, max_attribute FROM maxima ORDER BY max_score DESC, post_id""",
    "F8_ranked_threads": f"""WITH RECURSIVE {THREADS.replace("tp AS", "tp1 AS").replace("tc AS", "tc1 AS")}, {EVENT_THREAD.replace("tp AS", "tp2 AS").replace("tc AS", "tc2 AS")},
tp AS (SELECT id, title, selftext, author FROM tp1 UNION ALL SELECT id, title, selftext, author FROM tp2),
tc AS (SELECT id, ord, body, author, parent_id FROM tc1 UNION ALL SELECT id, ord, body, author, parent_id FROM tc2),
{TREE}, {LINES}, {CONVERSATIONS}, {sent("SELECT post_id, full_conversation FROM conv")},
scores AS (SELECT post_id, {answer_columns()} FROM sent WHERE {ANSWERED}),
tops AS (SELECT *, greatest({", ".join(f"{a}_score" for a in ATTRIBUTES)}) AS max_score FROM scores),
maxima AS (SELECT post_id, max_score, {pick("'{a}'")} AS max_attribute FROM tops)
SELECT post_id, text AS full_conversation, max_score, max_attribute FROM sent JOIN maxima USING (post_id) ORDER BY max_score DESC, post_id""",
    "F9_attribute_filter": f"""WITH {SCORES}, {MAXIMA}
SELECT post_id, text AS full_conversation, max_score, max_attribute FROM maxima WHERE max_attribute IN ('toxicity', 'threat') ORDER BY max_score DESC, post_id""",
    "F9_attribute_filter_without_match": f"""WITH {SCORES}, {MAXIMA}
SELECT post_id, text AS full_conversation, max_score, max_attribute FROM maxima WHERE max_attribute = 'no_such'""",
    "F10_rank_positions": f"""WITH {SCORES}, {MAXIMA}
SELECT post_id, max_score, row_number() OVER (ORDER BY max_score DESC, post_id) - 1 AS rank FROM maxima""",
    "F11_score_range": f"WITH {SCORES}, {MAXIMA} SELECT min(max_score) AS min_score, max(max_score) AS max_score, count(*) AS conversations FROM maxima",
    "F12_shortlist": f"WITH {SCORES}, {MAXIMA} SELECT post_id, max_score, max_attribute FROM maxima ORDER BY max_score DESC, post_id LIMIT 50",
    "F12_token_budget": f"""WITH {SCORES}, {MAXIMA}, est AS (SELECT post_id, max_score, CAST(length(text) // 4 AS BIGINT) AS tokens FROM maxima),
spent AS (SELECT *, CAST(coalesce(sum(tokens) OVER (ORDER BY max_score DESC, post_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent_before FROM est)
SELECT post_id, max_score, tokens, spent_before FROM spent WHERE spent_before + tokens <= 100000""",
    "G1_account_rollup": f"""WITH {POSTS}, {SCORES}, {MAXIMA}
SELECT subreddit AS username, count(*) AS posts, count(toxic) AS judged_posts, count(*) FILTER (toxic = 1) AS flagged_posts,
       CASE WHEN count(toxic) > 0 THEN (count(*) FILTER (toxic = 1))::DOUBLE / count(toxic)::DOUBLE END AS flagged_share,
       max(max_score) AS max_score, max(created) AS last_updated
FROM dp LEFT JOIN labels l USING (doc_id) LEFT JOIN maxima m ON m.post_id = dp.id GROUP BY subreddit""",
    "G2_suggestion_rollup": f"""WITH {VERDICTS}
SELECT suggested_prompt_modifications, count(*) AS n FROM verdicts WHERE suggested_prompt_modifications <> '' GROUP BY 1""",
    "G3_glossary_matches": f"""WITH texts AS (SELECT CAST(doc_id AS VARCHAR) AS id, text AS body FROM documents), {TERM_MATCHES}
SELECT id, count(*) AS n_terms, string_agg(term, '|' ORDER BY term) AS terms, count(*) >= 2 AS several_terms FROM matches GROUP BY id""",
    "G4_verdicts_with_source": f"""WITH {VERDICTS}, {COMMENT_TABLE}, {POSTS}
SELECT v.gemini_id, v.post_id, v.comment_id, v.is_flagged, ct.author AS comment_author, ct.body AS comment_body, dp.title AS post_title, dp.author AS post_author
FROM verdicts v LEFT JOIN ct ON ct.id = v.comment_id LEFT JOIN dp ON dp.id = v.post_id""",
    "running_total": """SELECT doc_id, source, n_chars, CAST(coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chars_before FROM documents""",
}
