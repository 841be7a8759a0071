"""Expected results as SQL over the test tables, one statement per query.

The SQL never sees a dump line: it computes from the tables what the rendered
dump (`fixtures/render.py`) must yield.
"""

from __future__ import annotations

USERS = """
SELECT CASE WHEN c_custkey % 500 <> 499 THEN c_custkey + CASE WHEN c_custkey % 10 = 3 THEN 3000000000 ELSE 0 END ELSE 0 END AS id,
  CAST(floor(c_acctbal) AS BIGINT) AS reputation,
  CAST(1217540572 + c_custkey AS BIGINT) AS signup_date,
  CASE WHEN c_custkey % 10 <> 9
    THEN CAST(1217540572 + c_custkey + 86400 * (c_nationkey + CASE WHEN c_custkey % 20 = 4 THEN 12000 ELSE 0 END) AS BIGINT) ELSE 0 END AS last_access_date,
  CAST(c_nationkey % 3 = 0 AS INTEGER) AS has_website,
  CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS has_location,
  CAST(c_custkey % 2 = 0 AS INTEGER) AS has_about_me,
  CAST(c_custkey * 3 AS BIGINT) AS profile_views,
  CAST(c_custkey % 50 AS BIGINT) AS up_votes,
  CASE c_custkey % 50 WHEN 8 THEN 9999999999 WHEN 9 THEN NULL ELSE c_custkey % 7 END AS down_votes,
  CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL
    ELSE CAST(18 + c_custkey % 60 AS BIGINT) END AS age
FROM customer
"""

# every post as it is read: absent numbers are 0, empty ones null
POSTS = """
SELECT o_orderkey * 4 + CASE WHEN o_orderkey % 10 = 7 THEN 3000000000 ELSE 0 END AS id,
  CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '4' END AS post_type,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0
    THEN CAST(o_orderkey * 4 + 4 AS BIGINT) ELSE 0 END AS accepted_answer_id,
  CAST(floor(o_totalprice / 1000) - 100 AS BIGINT) AS score,
  CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS "views",
  CASE o_orderkey % 20 WHEN 0 THEN 0 WHEN 1 THEN NULL 
    ELSE o_custkey + CASE WHEN o_custkey % 10 = 3 THEN 3000000000 ELSE 0 END END AS user_id,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 5 AS BIGINT) ELSE 0 END AS answer_count,
  CAST(o_orderkey % 4 AS BIGINT) AS comment_count,
  CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_orderkey % 11 AS BIGINT) ELSE 0 END AS favourite_count,
  CAST(length(o_orderpriority) + 8 AS BIGINT) AS body_length,
  '<p>' || o_orderpriority || '</p>' || chr(10) AS body
FROM orders
UNION ALL
SELECT CAST(doc_id * 4 + 1 AS BIGINT), CASE WHEN lang = 'en' THEN '1' ELSE '2' END, 0,
  CAST(n_chars % 100 - 50 AS BIGINT), 0, CAST(doc_id // 7 AS BIGINT), 0,
  CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id % 13 AS BIGINT) ELSE 0 END, 0,
  CAST(length(text) AS BIGINT), text
FROM documents
UNION ALL
SELECT CAST(page_id * 4 + 2 AS BIGINT), CASE WHEN page_id % 2 = 0 THEN '1' ELSE '2' END, 0,
  CAST(page_id % 17 AS BIGINT), CAST(length(html) AS BIGINT), 0,
  CAST(page_id % 2 = 0 AS BIGINT), 0, 0, CAST(length(html) AS BIGINT), html
FROM pages
UNION ALL
SELECT CAST((conv_id * 100 + turn) * 4 + 3 AS BIGINT),
  CASE "role" WHEN 'user' THEN '1' WHEN 'assistant' THEN '2' ELSE '5' END,
  CASE WHEN "role" = 'user' THEN CAST((conv_id * 100 + turn + 1) * 4 + 3 AS BIGINT) ELSE 0 END,
  CAST(turn AS BIGINT), 0, CAST(conv_id AS BIGINT), CAST("role" = 'user' AS BIGINT), 0, 0,
  CAST(length(text) AS BIGINT), text
FROM conversations
"""

QUESTIONS = f"""
SELECT id, accepted_answer_id, score, "views", user_id, answer_count, comment_count,
  favourite_count, body_length
FROM ({POSTS}) WHERE post_type = '1'
"""
ANSWERS = f"""
SELECT id, score, "views", user_id, comment_count, favourite_count, body_length
FROM ({POSTS}) WHERE post_type <> '1'
"""

_EVENT_USER = """CASE event_id % 25 WHEN 0 THEN NULL WHEN 1 THEN NULL
  ELSE user_id + CASE WHEN user_id % 10 = 3 THEN 3000000000 ELSE 0 END END"""

BADGE_COUNTS = f"""
SELECT {_EVENT_USER} AS user_id, count(*) AS number_of_badges
FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1
"""
COMMENT_COUNTS = f"""
SELECT {_EVENT_USER} AS user_id, count(*) AS number_of_comments
FROM events WHERE event_type IN ('click', 'view') GROUP BY 1
"""
LINK_COUNTS = """
SELECT l_orderkey + CASE WHEN l_orderkey % 10 = 7 THEN 3000000000 ELSE 0 END AS post_id, count(*) AS number_of_links
FROM lineitem GROUP BY 1
"""
HISTORY_COUNTS = """
SELECT CASE WHEN l_partkey % 30 <> 0 
    THEN l_suppkey + CASE WHEN l_suppkey % 10 = 3 THEN 3000000000 ELSE 0 END END AS user_id,
  l_orderkey + CASE WHEN l_orderkey % 10 = 7 THEN 3000000000 ELSE 0 END AS post_id, count(*) AS number_of_edits
FROM lineitem GROUP BY 1, 2
"""

ANSWER_SUMMARY = f"""
SELECT user_id, CAST(sum(score) AS BIGINT) AS total_answer_score,
  CAST(sum("views") AS BIGINT) AS total_answer_views,
  CAST(sum(comment_count) AS BIGINT) AS total_answer_comments,
  CAST(sum(favourite_count) AS BIGINT) AS total_answer_favourites,
  CAST(sum(body_length) AS BIGINT) AS total_answer_body_length,
  count(id) AS total_answers,
  CAST(sum(score) AS DOUBLE) / count(id) AS average_answer_score,
  CAST(sum(body_length) AS DOUBLE) / count(id) AS average_answer_body_length,
  CAST(sum(comment_count) AS DOUBLE) / count(id) AS average_answer_comments
FROM ({ANSWERS}) GROUP BY 1
"""
QUESTION_SUMMARY = f"""
SELECT user_id, CAST(sum(score) AS BIGINT) AS total_question_score,
  CAST(sum("views") AS BIGINT) AS total_question_views,
  CAST(sum(answer_count) AS BIGINT) AS total_question_answers,
  CAST(sum(CAST(accepted_answer_id <> 0 AS BIGINT)) AS BIGINT) AS total_question_accepted_answers,
  CAST(sum(comment_count) AS BIGINT) AS total_question_comments,
  CAST(sum(favourite_count) AS BIGINT) AS total_question_favourites,
  CAST(sum(body_length) AS BIGINT) AS total_question_body_length,
  count(id) AS total_questions,
  CAST(sum(score) AS DOUBLE) / count(id) AS average_question_score,
  CAST(sum(body_length) AS DOUBLE) / count(id) AS average_question_body_length,
  CAST(sum(answer_count) AS DOUBLE) / count(id) AS average_answers_per_question,
  CAST(sum(CAST(accepted_answer_id <> 0 AS BIGINT)) AS DOUBLE) / count(id)
    AS average_accepted_answers_per_question,
  CAST(sum(comment_count) AS DOUBLE) / count(id) AS average_question_comments
FROM ({QUESTIONS}) GROUP BY 1
"""

USER_MASTER = f"""
SELECT u.*, b.number_of_badges, c.number_of_comments,
  a.* EXCLUDE (user_id, total_answer_body_length),
  q.* EXCLUDE (user_id, total_question_body_length)
FROM ({USERS}) u
LEFT JOIN ({BADGE_COUNTS}) b ON u.id = b.user_id
LEFT JOIN ({COMMENT_COUNTS}) c ON u.id = c.user_id
LEFT JOIN ({ANSWER_SUMMARY}) a ON u.id = a.user_id
LEFT JOIN ({QUESTION_SUMMARY}) q ON u.id = q.user_id
"""

DUMP_SCAN = f"SELECT id, post_type, user_id, body FROM ({POSTS})"

DUMP_REJECTS = """
SELECT 'posts' AS entity,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'no_post_type' WHEN '2-HIGH' THEN 'malformed'
    WHEN '3-MEDIUM'
      THEN CASE o_orderstatus WHEN 'O' THEN 'bad_number' ELSE 'not_a_row' END WHEN '4-NOT SPECIFIED' THEN 'malformed'
    ELSE 'malformed' END AS reject_reason,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN '  <row Id="' || o_orderkey || '" Body="no type" />'
    WHEN '2-HIGH' THEN '  <row Id="' || o_orderkey || '" Score=3 />'
    WHEN '3-MEDIUM' THEN
      CASE o_orderstatus WHEN 'P' THEN ''
        WHEN 'O' THEN '  <row Id="' || o_orderkey || '99999999999999999999" PostTypeId="1" />'
        ELSE '  <tag Id="' || o_orderkey || '" />' END
    WHEN '4-NOT SPECIFIED' THEN
      '  <row Id="' || o_orderkey || '" PostTypeId="1" /><row Id="5" PostTypeId="2" />'
    ELSE CASE o_orderstatus
      WHEN 'F' THEN '  <row Id="' || o_orderkey || '" x:y="5" PostTypeId="1" />'
      WHEN 'O' THEN '  <row Id="' || o_orderkey || '" PostTypeId="1" Body="a&nbsp;b" />'
      ELSE '  <row Id="' || o_orderkey || '" Id="5" PostTypeId="1" />' END
    END AS line
FROM orders
UNION ALL
SELECT 'users', 'bad_date',
  CASE c_mktsegment
    WHEN 'BUILDING' THEN '  <row Id="' || c_custkey || '" CreationDate="31 July 2008" />'
    WHEN 'MACHINERY' THEN '  <row Id="' || c_custkey || '" LastAccessDate="" />'
    ELSE '  <row Id="' || c_custkey || '" CreationDate="2008-02-30T00:00:00.000" />' END
FROM customer
"""

INGEST_COUNTERS = """
SELECT 'users' AS entity, count(*) AS "rows", count(*) AS rejects FROM customer
UNION ALL
SELECT 'posts', (SELECT count(*) FROM orders) + (SELECT count(*) FROM documents)
    + (SELECT count(*) FROM pages) + (SELECT count(*) FROM conversations),
  (SELECT count(*) FROM orders)
UNION ALL
SELECT 'badges', count(*), 0 FROM events WHERE event_type NOT IN ('click', 'view')
UNION ALL
SELECT 'comments', count(*), 0 FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT 'postlinks', count(*), 0 FROM lineitem
UNION ALL
SELECT 'posthistory', count(*), 0 FROM lineitem
"""

ORACLE = {
    "dump_scan": DUMP_SCAN,
    "dump_rejects": DUMP_REJECTS,
    "ingest_counters": INGEST_COUNTERS,
    "observed_counters": INGEST_COUNTERS,
    "users_profile": USERS,
    "questions": QUESTIONS,
    "answers": ANSWERS,
    "badge_counts": BADGE_COUNTS,
    "comment_counts": COMMENT_COUNTS,
    "link_counts": LINK_COUNTS,
    "history_counts": HISTORY_COUNTS,
    "answer_summary": ANSWER_SUMMARY,
    "question_summary": QUESTION_SUMMARY,
    "user_master": USER_MASTER,
    "csv_roundtrip": USER_MASTER,
    "questions_roundtrip": QUESTIONS,
    "answers_roundtrip": ANSWERS,
    "links_roundtrip": LINK_COUNTS,
    "history_roundtrip": HISTORY_COUNTS,
    "job_counters": INGEST_COUNTERS,
}
