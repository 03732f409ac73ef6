"""DuckDB statements of the registered queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({_LOWER.format(t=t)}, '{_GAP}'), lambda x: x <> '')"


_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_words('text')} AS w FROM benchmark)
      WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM i)),
lens AS (SELECT DISTINCT n FROM g),
dg AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens)),
hits AS (SELECT doc_id, s, n, item_id FROM dg JOIN g USING (n, gram)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
            (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM
          (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _escaped(t: str, role: bool = False) -> str:
    s = f"replace(replace(replace({t}, '\\', '\\b'), '<', '\\l'), '#', '\\h')"
    return f"replace({s}, ':', '\\c')" if role else s


_CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
o AS (SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_escaped('text')}) + CASE WHEN before IS NOT NULL AND before = role THEN 7
           ELSE 4 + length({_escaped('role', True)}) + 2 + 8 END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""


_PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array({_LOWER.format(t='text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
grams AS (SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
          FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s
                FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM pieces))),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 30),
cuts AS (SELECT *, array_to_string(w[1:k], ' ') AS fst, array_to_string(w[k + 1:m], ' ') AS rest
         FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
                  ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.fst JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(w[s:s + j - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT *, unnest(range(1, m - j + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS j FROM cand))
           GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best b LEFT JOIN inner_ i USING (lang, phrase) JOIN total t ON t.lang = b.lang
WHERE coalesce(longer, 0)::HUGEINT * 100 < a::HUGEINT * 80
QUALIFY rank <= 2000
"""


def _share(count: str, total: str) -> str:
    return f"(1 + (1000000000::HUGEINT * ({count} + 2)) // ({total} + 2 * v))"


def _apart(p: str, q: str) -> str:
    return f"((({p} - {q}) * ({p} - {q})) // ({p} + {q}))"


_DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER.format(t='text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
m AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, v FROM g JOIN kept ON kept.lang = g.lang
      JOIN vs ON vs.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT *, {_share('n', 'sum(n) OVER (PARTITION BY lang, source)')} AS p,
             {_share('sum(n) OVER (PARTITION BY lang, term)', 'sum(n) OVER (PARTITION BY lang)')} AS q FROM m),
pairs AS (SELECT x.lang, x.source, y.source AS item,
                 coalesce((SELECT sum({_apart('a.p', 'b.p')}) FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term
                           WHERE a.lang = x.lang AND a.source = x.source AND b.source = y.source), 0)::BIGINT AS value
          FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source),
terms AS (SELECT lang, source, term AS item, {_apart('p', 'q')}::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
WHERE rank <= 10
"""


def statements() -> dict[str, str]:
    return {
        "op9_decontamination": _DECONTAMINATION,
        "op10_chat_formatting": _CHAT,
        "op11_phrase_collocations": _PHRASES,
        "op12_source_divergence": _DIVERGENCE,
    }
