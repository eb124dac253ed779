"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# What follows the first character of a control string is consumed here, where the operator looks ahead:
# no control string begins inside another one's tail, so both count the same.
_CONTROL = r"[<\[](\||/?s>|</?SYS>>|/?INST\]|/?[a-z_]{1,20}\|>)"


def _escaped_length(column: str) -> str:
    doubled = f"(length({column}) - length(replace({column}, chr(92), '')))"
    marked = rf"(length(regexp_replace({column}, '{_CONTROL}', '\0+', 'g')) - length({column}))"
    return f"(length({column}) + {doubled} + {marked})"


OP6_CHAT_FORMATTING = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), conversation AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
         sum({_escaped_length("role")} + {_escaped_length("text")}
             + length('<|im_start|>') + length('<|im_sep|>') + length('<|im_end|>')) AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars,
       sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM conversation
"""

OP11_SPELLING_VARIANTS = r"""
WITH RECURSIVE run AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) GROUP BY ALL
), summed AS (  -- crc32, byte by byte, each by eight shifts
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(bytes)), lambda i: ('0x' || hex(bytes)[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes FROM run)
), word AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, times FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM word)
), near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM shorter a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM shorter a JOIN word b ON a.rest = b.word
), ranked AS (
  SELECT near.word, other, w.n, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS nth
  FROM near JOIN word w ON w.word = near.word JOIN word o ON o.word = other
), form AS (
  SELECT word.word, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * word.n THEN other END AS form,
         CASE WHEN other_n >= 2 * word.n THEN other_n END AS form_n
  FROM word LEFT JOIN ranked ON ranked.word = word.word AND nth = 1
), chain AS (
  SELECT word, word AS last FROM form UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON form.word = chain.last WHERE form.form IS NOT NULL
), root AS (
  SELECT chain.word, chain.last FROM chain JOIN form ON form.word = chain.last WHERE form.form IS NULL
)
SELECT form.word, form, last AS root, n, n_near, form_n FROM form JOIN root ON root.word = form.word
"""

OP12_PHRASE_COLLOCATIONS = r"""
WITH piece AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
    FROM documents WHERE text IS NOT NULL)
), word AS (
  SELECT p, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM piece
), total AS (
  SELECT lang, count(*) AS n FROM word GROUP BY lang
), run AS (
  SELECT lang, w AS w1, lead(w, 1) OVER places AS w2, lead(w, 2) OVER places AS w3, lead(w, 3) OVER places AS w4
  FROM word WINDOW places AS (PARTITION BY p ORDER BY i)
), frequent AS (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS f FROM run GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 2, concat_ws(' ', w1, w2), count(*) FROM run WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3), count(*) FROM run WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4), count(*) FROM run WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
), candidate AS (
  SELECT *, string_split(phrase, ' ') AS words FROM frequent WHERE size > 1
), covering AS (
  SELECT c.lang, array_to_string(c.words[i:i + m - 1], ' ') AS phrase, max(c.f) AS longer
  FROM candidate c, (VALUES (2), (3)) sizes(m), (VALUES (1), (2), (3)) places(i) WHERE m < c.size AND i + m - 1 <= c.size GROUP BY ALL
), cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, h.f AS l, t.f AS r, ((2000000::HUGEINT * c.f) // (h.f + t.f))::BIGINT AS score
  FROM candidate c LEFT JOIN covering v ON v.lang = c.lang AND v.phrase = c.phrase
  JOIN (VALUES (1), (2), (3)) cuts(k) ON k < c.size
  JOIN frequent h ON h.lang = c.lang AND h.phrase = array_to_string(c.words[1:k], ' ')
  JOIN frequent t ON t.lang = c.lang AND t.phrase = array_to_string(c.words[k + 1:], ' ')
  WHERE coalesce(100::HUGEINT * v.longer < 80::HUGEINT * c.f, true)
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cut
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE nth = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

SQL = {"op6_chat_formatting": OP6_CHAT_FORMATTING, "op11_spelling_variants": OP11_SPELLING_VARIANTS,
       "op12_phrase_collocations": OP12_PHRASE_COLLOCATIONS}
