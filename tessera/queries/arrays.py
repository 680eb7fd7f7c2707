"""ARR: arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T


@register("arr_pick", """SELECT c_custkey, ['north', 'south', 'east'][CAST(c_custkey % 4 AS INTEGER) + 1]
  AS zone FROM customer""")
def arr_pick(spark, sf):
    # get() is null out of range; getItem raises under ANSI.
    zones = F.array(F.lit("north"), F.lit("south"), F.lit("east"))
    return T(spark, sf, "customer").select(
        "c_custkey", F.get(zones, (F.col("c_custkey") % 4).cast("int")).alias("zone"))


@register("arr_explode", """SELECT doc_id, unnest(string_split(lang || ' ' || source, ' ')) AS token
  FROM documents""")
def arr_explode(spark, sf):
    return T(spark, sf, "documents").select(
        "doc_id", F.explode(F.split(F.concat_ws(" ", "lang", "source"), " ")).alias("token"))


@register("arr_explode_outer", S.with_ctes(
    "SELECT * FROM (SELECT page_number, unnest(tags) AS tag FROM r_quotes) WHERE tag IS NOT NULL",
    S.R_QUOTES))
def arr_explode_outer(spark, sf):
    q = A.quotes(spark, sf)
    return (q.select("page_number", F.explode_outer("tags").alias("tag"))
            .where(F.col("tag").isNotNull()))


@register("arr_size", """SELECT doc_id, CAST(len(string_split_regex(text, '\\s+')) AS INTEGER) AS n_words
  FROM documents""")
def arr_size(spark, sf):
    return T(spark, sf, "documents").select("doc_id", F.size(F.split("text", r"\s+")).alias("n_words"))
