"""Query of the conversation prefix trie."""

from contrail.llm.prefix_trie import prefix_trie, share_first_turns, turn_sequences
from contrail.llm.queries import register, table

# DuckDB has no crc32: eight shifts a byte over the digits of the id.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1)))), 4294967295::BIGINT)"""

SQL = f"""
WITH o AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations GROUP BY conv_id),
h AS (SELECT conv_id, s, {_CRC} % 4 AS h FROM o),
c AS (SELECT h.conv_id, list_concat(coalesce(b.s[1:h.h], []), h.s[h.h + 1:]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, s, d, s[1:d] AS p FROM (SELECT *, unnest(generate_series(0, len(s))) AS d FROM c)),
n AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends,
  CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) END AS words FROM p GROUP BY d, p),
k AS (SELECT n.*, q.conv_id AS parent_conv_id FROM n LEFT JOIN n q ON n.d = q.d + 1 AND q.p = n.p[1:n.d - 1]),
f AS (SELECT d, p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT k.*, coalesce(f.n_children, 0) AS n_children FROM k LEFT JOIN f ON f.d = k.d + 1 AND f.p = k.p),
u AS (SELECT g, p[1:g] AS p, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(generate_series(0, d)) AS g FROM a) GROUP BY ALL)
SELECT CAST(a.conv_id AS BIGINT) AS conv_id, CAST(a.d AS BIGINT) AS depth, CAST(parent_conv_id AS BIGINT) AS parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs,
  CAST(n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM a JOIN u ON u.g = a.d AND u.p = a.p
"""


@register("op11_prefix_trie", SQL)
def op11(spark, sf_dir):
    """Every node of the trie of the conversations that share first turns."""
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie(share_first_turns(turn_sequences(turns)))
