"""Quotes normaliser queries on the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import quotes as Q
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A

CLEAN_CTES = [S.R_QUOTES, """t AS (SELECT trim(quote_text, ' ') AS quote_text, trim(author, ' ') AS author,
  COALESCE(tags, CAST([] AS VARCHAR[])) AS tags, page_number, scraped_at FROM r_quotes)""",
              """d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quote_text, author
  ORDER BY page_number NULLS FIRST, scraped_at NULLS FIRST, tags NULLS FIRST) AS _rn FROM t
  WHERE quote_text IS NOT NULL AND author IS NOT NULL) WHERE _rn = 1)""",
              """clean AS (SELECT quote_text, author, page_number, scraped_at, tags,
  CAST(length(quote_text) AS INTEGER) AS quote_length,
  CAST(len(string_split_regex(quote_text, '\\s+')) AS INTEGER) AS word_count FROM d)"""]


def _clean(spark, sf):
    return Q.clean_quotes(A.quotes(spark, sf))


@register("quotes_clean", S.with_ctes(
    "SELECT quote_text, author, page_number, scraped_at, array_to_string(tags, ',') AS tags, "
    "quote_length, word_count FROM clean", *CLEAN_CTES))
def quotes_clean(spark, sf):
    c = _clean(spark, sf)
    return c.select("quote_text", "author", "page_number", "scraped_at",
                    F.array_join("tags", ",").alias("tags"), "quote_length", "word_count")


@register("quotes_authors", S.with_ctes("SELECT DISTINCT author AS name FROM clean", *CLEAN_CTES))
def quotes_authors(spark, sf):
    return Q.authors(_clean(spark, sf))


@register("quotes_tags", S.with_ctes(
    "SELECT DISTINCT name FROM (SELECT unnest(tags) AS name FROM clean) WHERE name IS NOT NULL",
    *CLEAN_CTES))
def quotes_tags(spark, sf):
    return Q.tags(_clean(spark, sf))


@register("quotes_facts", S.with_ctes(
    "SELECT quote_text, author, page_number, scraped_at, quote_length, word_count FROM clean",
    *CLEAN_CTES))
def quotes_facts(spark, sf):
    return Q.quotes_table(_clean(spark, sf))


@register("quotes_quote_tags", S.with_ctes(
    "SELECT * FROM (SELECT quote_text, author, unnest(tags) AS tag FROM clean) WHERE tag IS NOT NULL",
    *CLEAN_CTES))
def quotes_quote_tags(spark, sf):
    return Q.quote_tags(_clean(spark, sf))
