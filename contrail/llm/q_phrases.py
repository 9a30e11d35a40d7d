"""Query of the phrase collocations."""

from contrail.llm.phrase_mining import mine_phrases
from contrail.llm.queries import register, table

SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM w, (VALUES (1), (2), (3)) AS t(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, CAST(count(*) AS BIGINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, m, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m > 1)),
s AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, h.a AS l, t.a AS r,
  CAST((1000000::HUGEINT * c.a * c.a) // (h.a::HUGEINT * t.a) AS BIGINT) AS score
  FROM c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, inner_phrase, max(a) AS around FROM (
  SELECT lang, a, array_to_string(string_split(phrase, ' ')[1:2], ' ') AS inner_phrase FROM f WHERE m = 3
  UNION ALL SELECT lang, a, array_to_string(string_split(phrase, ' ')[2:3], ' ') FROM f WHERE m = 3) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.inner_phrase = b.phrase WHERE around IS NULL OR 100 * around < 50 * a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM k JOIN n ON n.lang = k.lang QUALIFY rank <= 2000
"""


@register("op12_phrase_mining", SQL)
def op12(spark, sf_dir):
    """The best phrases of two and three words of every language."""
    return mine_phrases(table(spark, sf_dir, "documents")).drop("n_words")
