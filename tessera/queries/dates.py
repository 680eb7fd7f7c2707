"""DAT: date and time functions (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.dates import days_since
from tessera.queries import register
from tessera.sources.tables import table as T

AS_OF = "1999-01-01"


def _orders(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey",
                                         F.col("o_orderdate").cast("date").alias("d"))


_O = "WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)\n"


@register("dat_parse", _O + """SELECT o_orderkey,
  TRY_CAST(TRY_STRPTIME(CASE WHEN o_orderkey % 7 = 0 THEN strftime(d, '%Y-%m-%d') || 'x'
                             ELSE strftime(d, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS parsed FROM o""")
def dat_parse(spark, sf):
    text = F.date_format("d", "yyyy-MM-dd")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.concat(text, F.lit("x"))).otherwise(text)
    return _orders(spark, sf).select(
        "o_orderkey", F.try_to_date(text, "yyyy-MM-dd").alias("parsed"))


@register("dat_parse_ts", """SELECT event_id,
  TRY_STRPTIME(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM events""")
def dat_parse_ts(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return T(spark, sf, "events").select(
        "event_id",
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed"))


@register("dat_parts", _O + """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS y,
  CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dom FROM o""")
def dat_parts(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.year("d").alias("y"),
                                     F.month("d").alias("m"), F.dayofmonth("d").alias("dom"))


@register("dat_dow", _O + "SELECT o_orderkey, CAST(dayofweek(d) + 1 AS INTEGER) AS dow FROM o")
def dat_dow(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.dayofweek("d").alias("dow"))


@register("dat_quarter", _O + "SELECT o_orderkey, CAST(quarter(d) AS INTEGER) AS q FROM o")
def dat_quarter(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.quarter("d").alias("q"))


@register("dat_time_parts", """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hh,
  CAST(minute(ts) AS INTEGER) AS mi FROM events""")
def dat_time_parts(spark, sf):
    return T(spark, sf, "events").select("event_id", F.hour("ts").alias("hh"),
                                         F.minute("ts").alias("mi"))


@register("dat_shift", _O + """SELECT o_orderkey, CAST(d + 7 AS DATE) AS plus7,
  CAST(d - 7 AS DATE) AS minus7 FROM o""")
def dat_shift(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.date_add("d", 7).alias("plus7"),
                                     F.date_sub("d", 7).alias("minus7"))


@register("dat_diff", _O + f"SELECT o_orderkey, CAST(DATE '{AS_OF}' - d AS INTEGER) AS age_days FROM o")
def dat_diff(spark, sf):
    return _orders(spark, sf).select("o_orderkey", days_since("d", AS_OF).alias("age_days"))


@register("dat_months_between", _O + """SELECT o_orderkey,
  CASE WHEN d = last_day(d) THEN CAST((year(d) - 1992) * 12 + month(d) - 1 AS DOUBLE)
       ELSE round((year(d) - 1992) * 12 + month(d) - 1 + (day(d) - 31) / 31.0, 8) END AS months
  FROM o""")
def dat_months_between(spark, sf):
    # Whole months between month ends, else a fraction of 31 days.
    return _orders(spark, sf).select(
        "o_orderkey", F.months_between("d", F.lit("1992-01-31").cast("date")).alias("months"))


@register("dat_format", _O + "SELECT o_orderkey, strftime(d, '%b %d, %Y') AS pretty FROM o")
def dat_format(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.date_format("d", "MMM dd, yyyy").alias("pretty"))


@register("dat_epoch", """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
  strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS back
  FROM events""")
def dat_epoch(spark, sf):
    secs = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return T(spark, sf, "events").select("event_id", secs.alias("epoch_s"),
                                         F.from_unixtime(secs).alias("back"))
