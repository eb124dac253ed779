"""Queries against SQL over the whole given tables."""

from carecast.llm import registry
from carecast.llm.common import read
from tests.conftest import SMALL_SF
from tools.compare import compare, duck

# A run of sentences is its words joined by blanks; from and up to each sentence, the shortest run of 3 sentences and 24 words.
SPANS = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+|\n') AS words FROM documents
), token AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM tokens
), followed AS (
  SELECT *, coalesce(lead(word) OVER (PARTITION BY doc_id ORDER BY place), chr(10)) = chr(10) AS breaks FROM token
), ended AS (
  SELECT *, breaks OR regexp_matches(word, '[.,;:!?]["'')\]}*_]{0,3}$') AS closes, hex(encode(word))[1:16] AS key FROM followed WHERE word <> chr(10)
), parted AS (
  SELECT *, coalesce(sum(closes::INT) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM ended
), ranked AS (  -- how many words before are no greater, how many behind are smaller, in the same sentence, five at most
  SELECT *, count(*) OVER (PARTITION BY doc_id, part) AS words,
         CASE WHEN coalesce(lag(key, 1) OVER part > key, true) THEN 0 WHEN coalesce(lag(key, 2) OVER part > key, true) THEN 1 WHEN coalesce(lag(key, 3) OVER part > key, true) THEN 2 WHEN coalesce(lag(key, 4) OVER part > key, true) THEN 3 WHEN coalesce(lag(key, 5) OVER part > key, true) THEN 4 ELSE 5 END AS before,
         CASE WHEN coalesce(lead(key, 1) OVER part >= key, true) THEN 0 WHEN coalesce(lead(key, 2) OVER part >= key, true) THEN 1 WHEN coalesce(lead(key, 3) OVER part >= key, true) THEN 2 WHEN coalesce(lead(key, 4) OVER part >= key, true) THEN 3 WHEN coalesce(lead(key, 5) OVER part >= key, true) THEN 4 ELSE 5 END AS behind
  FROM parted WINDOW part AS (PARTITION BY doc_id, part ORDER BY place)
), chosen AS (
  SELECT *, closes OR (words > 24 AND before + behind >= 5) AS ends FROM ranked
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS i,
         coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS k FROM chosen
), sentence AS (
  SELECT doc_id, k, min(i) AS begins, max(i) + 1 AS stops, string_agg(word, ' ' ORDER BY place) AS body FROM counted GROUP BY doc_id, k
), fits AS (
  SELECT a.doc_id, a.k AS k, b.k AS last, a.begins, b.stops FROM sentence a JOIN sentence b
  ON b.doc_id = a.doc_id AND b.k >= a.k + 2 AND b.k < a.k + 26 AND b.stops - a.begins >= 24
), run AS (
  SELECT doc_id, k, min(last) AS last FROM fits GROUP BY doc_id, k UNION SELECT doc_id, max(k), last FROM fits GROUP BY doc_id, last
), worded AS (
  SELECT r.doc_id, r.k, r.last, string_agg(s.body, ' ' ORDER BY s.k) AS body
  FROM run r JOIN sentence s ON s.doc_id = r.doc_id AND s.k BETWEEN r.k AND r.last GROUP BY ALL
), placed AS (
  SELECT *, min(doc_id) OVER (PARTITION BY body) AS origin,
         first_value(k) OVER own AS own_first, first_value(last) OVER own AS own_last
  FROM worded WINDOW own AS (PARTITION BY body, doc_id ORDER BY k)
), lost AS (
  SELECT doc_id, origin, unnest(range(CASE WHEN origin < doc_id THEN k ELSE greatest(k, own_last + 1) END, last + 1)) AS gone
  FROM placed WHERE origin < doc_id OR k > own_first
)
SELECT doc_id, list_sort(list(DISTINCT gone::INT)) AS removed, list_sort(list(DISTINCT origin)) AS first_docs FROM lost GROUP BY doc_id
"""


def test_queries_equal_sql(spark):
    con = duck(SMALL_SF)
    for name, sql in registry.oracle_sql().items():
        problems, found, *_ = compare(spark, con, SMALL_SF, name, sql, registry.queries()[name])
        assert not problems and found > 2, problems


def test_span_dedup_equals_sql(spark):
    got = {r["doc_id"]: (list(r["removed"]), list(r["first_docs"])) for r in registry.queries()["op7_substring_dedup"](spark, SMALL_SF).collect()}
    want = {d: (removed, first) for d, removed, first in duck(SMALL_SF).execute(SPANS).fetchall()}
    assert got == want and read(spark, SMALL_SF, "documents").count() > len(got) > 0
