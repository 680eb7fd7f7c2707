"""Word counts over the documents table."""

from __future__ import annotations

from tessera.plans.text import word_count_space, word_count_whitespace
from tessera.queries import register
from tessera.sources.tables import fan_out, table as T


@register("word_count_ws", """SELECT lower(w) AS word, COUNT(*) AS "count" FROM
  (SELECT unnest(string_split_regex(text, '[\\t-\\r\\x1c-\\x20\\x{85}\\p{Z}]+')) AS w FROM documents) WHERE w <> '' GROUP BY 1""",
          headline=True)
def word_count_ws(spark, sf):
    return word_count_whitespace(fan_out(T(spark, sf, "documents").select("text")), "text")


@register("word_count_space", """SELECT lower(w) AS word, COUNT(*) AS "count" FROM
  (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1""")
def word_count_space_q(spark, sf):
    return word_count_space(fan_out(T(spark, sf, "documents").select("text")), "text")
